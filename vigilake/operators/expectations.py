"""Data-quality expectations: rows that fail are dropped, or kept and counted, or stop the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP, WARN, FAIL = "drop", "warn", "fail"


@dataclass(frozen=True)
class Expectation:
    """name, a predicate in SQL, and what happens to rows for which it is false or null."""

    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (DROP, WARN, FAIL):
            raise ValueError(f"{self.name}: action must be {DROP}, {WARN} or {FAIL}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    @property
    def violations(self) -> Column:
        return F.count(F.when(~self.holds, 1)).alias(self.name)


def apply(df: DataFrame, expectations: list[Expectation], observe: str | Observation | None = None) -> DataFrame:
    """df without the rows that an expectation drops. All drops are one conjunction, which pushes down.

    observe: name or Observation under which violations of each expectation are counted in the same pass, over all
    rows that came in; in a stream they stand in the query's progress."""
    if observe is not None and expectations:
        df = df.observe(observe, F.count(F.lit(1)).alias("rows"), *[e.violations for e in expectations])
    keep = None
    for e in expectations:
        if e.action == DROP:
            keep = e.holds if keep is None else keep & e.holds
        elif e.action == FAIL:
            failed = F.when(~e.holds, F.raise_error(F.lit(f"expectation {e.name} failed")).cast("boolean")).otherwise(F.lit(True))
            keep = failed if keep is None else keep & failed
    return df if keep is None else df.filter(keep)


def violation_counts(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """expectation, violations: a row for each."""
    counts = df.agg(*[e.violations for e in expectations])
    return counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(e.name) for e in expectations]), F.array(*[F.col(e.name) for e in expectations]))).alias("expectation", "violations"))
