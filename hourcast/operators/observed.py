"""Gates judged by metrics that Spark collects while it writes.

A gate that reads its table again costs a second scan, and comes too late: the table is
written already.  Here the checks are aggregates observed on the rows on their way to the
files (``DataFrame.observe``), so they cost no pass of their own, and they are judged when
the files are there but before anyone reads them (:mod:`hourcast.sinks.tables` switches a
table to its new files only then).

Only aggregates without DISTINCT can be observed: ranges, row counts, missing values and
the ingest profile.  Uniqueness needs a shuffle and stays a query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hourcast.operators import quality as Q


@dataclass(frozen=True)
class WriteGate:
    """Metrics by name, and what their values must say: None, or the fault."""
    metrics: dict[str, Column]
    fault: Callable[[dict], str | None]


def range_gate(c: str, lo: float, hi: float) -> WriteGate:
    """Every value of ``c`` lies within [lo, hi]; NaN does not, NULL is not judged."""
    name = f"outside_{c}"
    return WriteGate({name: Q.count_where(Q.out_of_range(c, lo, hi))},
                     lambda m: f"{c} within [{lo}, {hi}]: failed for {m[name]} rows" if m[name] else None)


def rowcount_gate(expected: int) -> WriteGate:
    """Exactly ``expected`` rows are written."""
    return WriteGate({}, lambda m: None if m["n_rows"] == expected
                     else f"row count == {expected}: failed, {m['n_rows']} rows")


def not_null_gate(columns: Sequence[str]) -> WriteGate:
    """No row lacks one of ``columns``."""
    return WriteGate({"with_null": Q.count_where(Q.any_null(columns))},
                     lambda m: f"not NULL {tuple(columns)}: failed for {m['with_null']} rows" if m["with_null"] else None)


def ingest_gate(min_rows: int = Q.INGEST_MIN_ROWS, lo: float = Q.INGEST_LO, hi: float = Q.INGEST_HI,
                time_col: str = "time", value_col: str = "temperature_2m") -> WriteGate:
    """The pre-load checks on processed text rows (``quality.gate_ingest``)."""
    def fault(m):
        try:
            Q.raise_ingest(m, min_rows, lo, hi)
        except Q.GateFailed as e:
            return str(e)
    return WriteGate(Q.ingest_metrics(lo, hi, time_col, value_col), fault)


class Watch:
    """The metrics of one write: rows written, and those of its gates."""

    def __init__(self, df: DataFrame, gates: Sequence[WriteGate] = ()):
        self.gates = list(gates)
        self._seen = Observation(f"write-{uuid.uuid4().hex}")
        metrics = {"n_rows": F.count(F.lit(1))}
        for gate in self.gates:
            metrics |= gate.metrics
        self.df = df.observe(self._seen, *[e.alias(n) for n, e in metrics.items()])
        """The rows to write; they must be written once, and nothing else."""

    @property
    def metrics(self) -> dict:
        """The metrics; waits for the write, so ask only when it is done."""
        return dict(self._seen.get)

    def check(self) -> dict:
        """The metrics, if no gate finds a fault in them; else they are those of the error."""
        found = self.metrics
        faults = [f for f in (gate.fault(found) for gate in self.gates) if f]
        if faults:
            error = Q.GateFailed("; ".join(faults))
            error.metrics = found
            raise error
        return found
