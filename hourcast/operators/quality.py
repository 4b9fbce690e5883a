"""Data-quality operators.

Two kinds:

* **reports** return a DataFrame (usually one row of counts) and never fail;
* **gates** run one action, inspect the single result row and raise
  :class:`GateFailed` when any value in it is false, NULL or zero -- the check
  operator's contract.  A gate must run before the write it protects.

All scalar checks of one table can be fused into a single aggregate pass
(:func:`table_profile`); distinct counts stay exact (``count(DISTINCT struct)``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions._util import col
from hourcast.operators.windows import CALENDAR, lag_delta


class GateFailed(AssertionError):
    """A fail-fast data-quality gate did not pass."""


# ---------------------------------------------------------------- predicates
def any_null(cols: Sequence) -> Column:
    """``a IS NULL OR b IS NULL OR ...``"""
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in cols])


def out_of_range(c, lo: float, hi: float) -> Column:
    """``c < lo OR c > hi``; NULL is not counted, NaN is (it sorts above all)."""
    return (col(c) < F.lit(lo)) | (col(c) > F.lit(hi))


def count_where(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def distinct_rows(cols: Sequence) -> Column:
    """``COUNT(DISTINCT (a, b))``: row values, including ones holding NULLs.

    ``count(DISTINCT a, b)`` would skip any row with a NULL part; a struct is
    never NULL itself, so every distinct combination counts.
    """
    return F.count_distinct(F.struct(*[col(c) for c in cols]))


# ---------------------------------------------------------------- reports
def grain_report(df: DataFrame, keys: Sequence[str], total: str = "total_rows",
                 distinct: str = "distinct_grain", duplicates: str | None = "duplicate_rows"
                 ) -> DataFrame:
    """Total rows, distinct key combinations and their difference."""
    aggs = [F.count(F.lit(1)).alias(total), distinct_rows(keys).alias(distinct)]
    out = df.agg(*aggs)
    if duplicates:
        out = out.withColumn(duplicates, F.col(total) - F.col(distinct))
    return out


def null_report(df: DataFrame, cols: Sequence[str], name: str = "null_violations") -> DataFrame:
    return df.agg(count_where(any_null(cols)).alias(name))


def range_report(df: DataFrame, c: str, lo: float, hi: float, name: str) -> DataFrame:
    return df.agg(count_where(out_of_range(c, lo, hi)).alias(name))


def expected_hourly_rows(n_days: int, n_series: int, per_day: int = 24) -> int:
    """Rows a complete hourly table should hold: days x 24 x series."""
    return n_days * per_day * n_series


def rowcount_drift(df: DataFrame, expected: int | None = None, day: str = "day",
                   series: Sequence[str] = ("region",), per_day: int = 24) -> DataFrame:
    """Actual rows, the expected count and their difference.  Without ``expected`` a
    complete table is expected: its days x ``per_day`` x its series."""
    n = F.count(F.lit(1))
    want = F.lit(expected).cast("bigint") if expected is not None else \
        F.count_distinct(F.col(day)) * F.lit(per_day) * distinct_rows(series)
    return (df.agg(n.alias("actual_rows"), want.alias("expected_rows"))
            .withColumn("diff", F.col("actual_rows") - F.col("expected_rows")))


def spike_report(df: DataFrame, value: str = "load_mw", threshold: float = 400.0,
                 top: int = 20, keys=("region",), order: str = "ts",
                 delta_name: str = "delta_mw", chunk=CALENDAR) -> DataFrame:
    """Largest |row-to-row change| >= threshold, top ``top`` by |delta|.

    Ties on |delta| are broken by (order, keys) so the report is deterministic.
    ``orderBy + limit`` plans as a bounded top-k: each task keeps ``top`` rows.
    """
    k = [keys] if isinstance(keys, str) else list(keys)
    d = lag_delta(df.select(order, *k, value), value, keys=k, order=order,
                  prev_name=False, delta_name=delta_name, chunk=chunk)
    hits = d.filter(F.col(delta_name).isNotNull()
                    & (F.abs(delta_name) >= F.lit(threshold)))
    return hits.orderBy(F.abs(delta_name).desc(), F.col(order).asc(),
                        *[F.col(x).asc() for x in k]).limit(top)


def value_order_report(df: DataFrame, lo: str = "min_load_mw", mid: str = "avg_load_mw",
                       hi: str = "max_load_mw", name: str = "bad_rows") -> DataFrame:
    """Rows violating ``min <= avg <= max`` (or ``min > max``)."""
    bad = ~((col(lo) <= col(mid)) & (col(mid) <= col(hi))) | (col(lo) > col(hi))
    return df.agg(count_where(bad).alias(name))


def reconcile_counts(fact: DataFrame, hourly: DataFrame, keys: Sequence[str] = ("day", "region"),
                     fact_count: str = "n_hours", hourly_name: str = "hourly_rows",
                     mismatches_only: bool = False) -> DataFrame:
    """Fact count column next to the recount from the hourly table."""
    h = hourly.groupBy(*keys).agg(F.count(F.lit(1)).alias(hourly_name))
    out = fact.select(*keys, fact_count).join(h, list(keys))
    if mismatches_only:
        out = out.filter(F.col(fact_count).cast("bigint") != F.col(hourly_name))
    return out


def missing_dim_report(fact: DataFrame, dims: dict[str, DataFrame],
                       name: str = "missing_dim_keys") -> DataFrame:
    from hourcast.operators.joins import missing_references
    return missing_references(fact, dims).agg(F.count(F.lit(1)).alias(name))


# -------------------------------------------------- column/model tests (failures)
def model_test_failures(df: DataFrame, tests: Sequence[tuple]) -> DataFrame:
    """Evaluate declarative model tests; one row per test with its failure count.

    Test tuples: ("not_null", col), ("unique", col),
    ("unique_combination", [cols]), ("expression_is_true", sql_expr).
    All row-level tests and the first uniqueness test share one pass: rows are
    grouped by the unique key with the failures of each row-level test summed per
    group, and one final aggregate adds these up and counts the repeated keys.  A
    uniqueness test on another key is a group-by of its own.  NULL values are
    ignored by ``unique``; an expression evaluating to NULL passes.
    """
    row_level, keys = {}, {}
    for i, t in enumerate(tests):
        kind, arg = t[0], t[1]
        if kind == "not_null":
            row_level[i] = count_where(col(arg).isNull())
        elif kind == "expression_is_true":
            row_level[i] = count_where(~F.expr(arg))
        elif kind in ("unique", "unique_combination"):
            keys[i] = [arg] if kind == "unique" else list(arg)
        else:
            raise ValueError(f"unknown test kind {kind!r}")
    name = [t[2] if len(t) > 2 else f"{t[0]}:{t[1] if isinstance(t[1], str) else ','.join(t[1])}"
            for t in tests]

    def repeated(i: int) -> Column:
        more = F.col("__n") > 1
        return F.count_if(more & F.col(keys[i][0]).isNotNull() if tests[i][0] == "unique" else more)

    def rows(wide: DataFrame, which: Sequence[int]) -> DataFrame:
        return wide.select(F.inline(F.array(*[
            F.struct(F.lit(name[i]).alias("test"),
                     F.coalesce(F.col(f"__t{i}"), F.lit(0)).cast("bigint").alias("failures"))
            for i in which])))

    frames, rest = [], list(keys)
    sums = [e.alias(f"__t{i}") for i, e in row_level.items()]
    if rest:
        first = rest.pop(0)
        per_key = df.groupBy(*keys[first]).agg(F.count(F.lit(1)).alias("__n"), *sums)
        wide = per_key.agg(repeated(first).alias(f"__t{first}"),
                           *[F.sum(f"__t{i}").alias(f"__t{i}") for i in row_level])
        frames.append(rows(wide, sorted([first, *row_level])))
    elif sums:
        frames.append(rows(df.agg(*sums), list(row_level)))
    for i in rest:
        per_key = df.groupBy(*keys[i]).agg(F.count(F.lit(1)).alias("__n"))
        frames.append(rows(per_key.agg(repeated(i).alias(f"__t{i}")), [i]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_profile(df: DataFrame, keys: Sequence[str], required: Sequence[str],
                  ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """All scalar checks of one table in a single aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("total_rows"), distinct_rows(keys).alias("distinct_grain"),
            count_where(any_null(required)).alias("null_violations")]
    for c, (lo, hi) in ranges.items():
        aggs.append(count_where(out_of_range(c, lo, hi)).alias(f"bad_{c}_rows"))
    return df.agg(*aggs).withColumn("duplicate_rows",
                                    F.col("total_rows") - F.col("distinct_grain"))


# ---------------------------------------------------------------- gates
def check(row_df: DataFrame, what: str) -> None:
    """Run ``row_df`` and raise unless its first row has only truthy values."""
    rows = row_df.limit(1).collect()
    if not rows:
        raise GateFailed(f"{what}: check returned no rows")
    bad = [k for k, v in rows[0].asDict().items() if not v]
    if bad:
        raise GateFailed(f"{what}: failed ({', '.join(bad)}) -> {rows[0].asDict()}")


def range_check(df: DataFrame, c: str = "temperature_2m", lo: float = -40, hi: float = 45
                ) -> DataFrame:
    """One row: does every value of ``c`` lie within [lo, hi]."""
    return df.agg((count_where(out_of_range(c, lo, hi)) == 0).alias("in_range"))


def unique_check(df: DataFrame, keys: Sequence[str] = ("ts", "region")) -> DataFrame:
    """One row: is every key there once."""
    return df.agg((F.count(F.lit(1)) == distinct_rows(keys)).alias("unique"))


def rowcount_check(df: DataFrame, expected: int) -> DataFrame:
    """One row: are there exactly ``expected`` rows."""
    return df.agg((F.count(F.lit(1)) == F.lit(expected)).alias("rowcount_ok"))


def gate_range(df: DataFrame, c: str = "temperature_2m", lo: float = -40, hi: float = 45) -> None:
    check(range_check(df, c, lo, hi), f"{c} within [{lo}, {hi}]")


def gate_unique(df: DataFrame, keys: Sequence[str] = ("ts", "region")) -> None:
    check(unique_check(df, keys), f"unique {tuple(keys)}")


def gate_rowcount(df: DataFrame, expected: int) -> None:
    check(rowcount_check(df, expected), f"row count == {expected}")


def gate_references(fact: DataFrame, dims: dict[str, DataFrame], what: str = "fact") -> None:
    """Foreign keys: every key of ``fact`` is in its dimension."""
    missing = missing_dim_report(fact, dims).first()[0]
    if missing:
        raise GateFailed(f"{what}: {missing} rows without a dimension row")


def gate_tests(df: DataFrame, tests: Sequence[tuple], what: str = "model tests") -> None:
    """Fail when any declarative test has failures (one small collect)."""
    failing = model_test_failures(df, tests).filter(F.col("failures") > 0).collect()
    if failing:
        raise GateFailed(f"{what}: " + ", ".join(f"{r['test']}={r['failures']}"
                                                 for r in failing))


INGEST_LO, INGEST_HI, INGEST_MIN_ROWS = -50.0, 60.0, 200


def ingest_metrics(lo: float = INGEST_LO, hi: float = INGEST_HI, time_col: str = "time",
                   value_col: str = "temperature_2m") -> dict[str, Column]:
    """The counts of :func:`ingest_profile` as aggregates by name."""
    v = col(value_col)
    # "missing" is NULL or the empty string
    blank_time = col(time_col).isNull() | (col(time_col) == "")
    blank_val = v.isNull() | (v.cast("string") == "")
    num = v.cast("string").try_cast("double")
    return {"n_rows": F.count(F.lit(1)), "no_time": count_where(blank_time), "no_value": count_where(blank_val),
            "not_numeric": count_where(~blank_val & num.isNull()),
            "outside": count_where(out_of_range(num, lo, hi))}


def ingest_profile(df: DataFrame, lo: float = INGEST_LO, hi: float = INGEST_HI,
                   time_col: str = "time", value_col: str = "temperature_2m") -> DataFrame:
    """One row of counts over processed text rows: ``n_rows``, ``no_time``,
    ``no_value``, ``not_numeric`` and ``outside`` [lo, hi] (NaN is outside)."""
    return df.agg(*[e.alias(n) for n, e in ingest_metrics(lo, hi, time_col, value_col).items()])


def raise_ingest(r, min_rows: int = INGEST_MIN_ROWS, lo: float = INGEST_LO,
                 hi: float = INGEST_HI) -> None:
    """Raise for the first fault in a row of :func:`ingest_profile`'s counts."""
    n = r["n_rows"] or 0
    faults = [
        (n < min_rows, f"only {n} weather rows, at least {min_rows} are required"),
        (r["no_time"], f"{r['no_time']} weather rows have no time"),
        (r["no_value"], f"{r['no_value']} weather rows have no temperature"),
        (r["not_numeric"], f"{r['not_numeric']} temperatures are not numbers"),
        (r["outside"], f"{r['outside']} temperatures are outside [{lo:g}, {hi:g}]")]
    for bad, text in faults:
        if bad:
            raise GateFailed(text)


def gate_ingest(df: DataFrame, min_rows: int = INGEST_MIN_ROWS, lo: float = INGEST_LO,
                hi: float = INGEST_HI, time_col: str = "time",
                value_col: str = "temperature_2m") -> None:
    """Pre-load gate on processed text rows: enough rows, time and value present,
    numeric value within [lo, hi].  One aggregate pass.
    """
    raise_ingest(ingest_profile(df, lo, hi, time_col, value_col).first(), min_rows, lo, hi)
