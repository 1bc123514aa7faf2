"""Loads that count what they read and write while they write it.

The guards of a load (no fewer rows than before, no unreadable times) need counts.
``replace_guarded`` takes them as observed metrics of the one job that writes the
new table beside the old one, and decides before the two are swapped, so no plan is run
a second time for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .sinks import replace_table


class GuardError(ValueError):
    """A load that a guard refused; ``stats`` are its counts."""

    def __init__(self, message: str, stats: dict):
        super().__init__(message)
        self.stats = stats


def replace_guarded(spark: SparkSession, existing: DataFrame, merge: Callable[[DataFrame], DataFrame], path: str,
                    never: dict[str, Column] | None = None, may_shrink: bool = False, **kw) -> dict:
    """Replace the table at ``path`` by ``merge(existing)``; returns rows_before, rows_after, rows_added, changed.

    Raises GuardError, and leaves the table as it is, if the new table has fewer
    rows than ``existing``, unless it ``may_shrink``, or if any existing row meets
    a condition of ``never`` (name -> condition).

    The rows after are counted in the tasks that write them, where Spark adds up
    each task once. Those before are counted below the shuffle of ``merge``; a map task that is run
    again after a lost executor adds to them again, so counts that would refuse
    the load are taken once more, exactly, before it is refused. ``merge`` should therefore shuffle, as
    any merge by key does: a sorted write of rows that no shuffle made reads them twice.
    """
    never = never or {}
    before, after = Observation(), Observation()
    hits = {f"_dl_never{i}": condition for i, condition in enumerate(never.values())}
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in hits.items()]]
    stats: dict = {}

    def check() -> None:
        seen, rows_after = dict(before.get), after.get["rows"]
        if rows_after < seen["rows"] and not may_shrink or any(seen[n] for n in hits):
            seen = existing.agg(*counts).first().asDict()
        stats.update(rows_before=seen["rows"], rows_after=rows_after, rows_added=rows_after - seen["rows"],
                     changed=rows_after != seen["rows"])
        for name, n in zip(never, hits):
            if seen[n]:
                raise GuardError(f"{seen[n]} rows of the table: {name}; not writing", stats)
        if rows_after < seen["rows"] and not may_shrink:
            raise GuardError(f"merge would shrink the table: {rows_after} rows after, {seen['rows']} before; not writing", stats)

    combined = merge(existing.observe(before, *counts))
    replace_table(spark, combined, path, scratch_dir(spark, "staging"), check=check,
                  observe=(after, [F.count(F.lit(1)).alias("rows")]), **kw)
    return stats
