"""Numeric expressions: casts, guarded division, rounding, keyed jitter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourcast.functions._util import col


def to_double(text, lenient: bool = False) -> Column:
    """Text to DOUBLE.  Strict raises on bad input (ANSI); lenient gives NULL."""
    c = col(text)
    return c.try_cast("double") if lenient else c.cast("double")


def safe_divide(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return col(num) / F.nullif(col(den), F.lit(0))


def relative_change(old, new) -> Column:
    """``(new - old) / NULLIF(old, 0)``."""
    return safe_divide(col(new) - col(old), old)


def round_numeric(x, scale: int = 6, precision: int = 38, frac: int = 12) -> Column:
    """``ROUND(x::numeric, scale)``: round half away from zero on a DECIMAL."""
    return F.round(col(x).cast(f"decimal({precision},{frac})"), scale)


def round_double(x, scale: int = 6) -> Column:
    """Double-typed rounding used where results are compared across engines."""
    return F.round(col(x), scale)


def keyed_jitter(*keys, seed: int = 42, buckets: int = 1_000_000) -> Column:
    """Deterministic pseudo-random value in [0, 1) derived from the row's key.

    Replaces a seeded ``random()`` stream: the value depends only on the key
    columns and the seed, so it is identical after re-partitioning, task retry
    or executor loss (``F.rand`` is not).
    """
    h = F.xxhash64(*[col(k) for k in keys], F.lit(seed))
    return F.pmod(h, F.lit(buckets)).cast("double") / F.lit(float(buckets))
