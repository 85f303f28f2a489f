"""What a cleaning job loses, by cause, counted while the job runs.

Each :meth:`Losses.watch` adds named counts to the job that reads the frame; they are added up by Spark as its tasks
end, so the report costs no pass of its own.  It is there once the job has run, for example once the table has been
written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Counts of the report: rows read and written, values that are there but cannot be read (the value becomes NULL), rows
#: dropped as a required value is missing, rows dropped for a later one with their key, values still NULL after a fill.
CAUSES = ("rows_in", "rows_out", "unreadable", "missing", "duplicate", "unfilled")


class Losses:
    """Counts of one cleaning job."""

    def __init__(self, table: str):
        self.table = table
        self._watched: list[tuple[Observation, list[tuple[str, str]]]] = []

    def watch(self, df: DataFrame, rows: str | None = None, **causes: Mapping[str, Column]) -> DataFrame:
        """The frame, its rows counted as ``rows`` and, by cause and column, the rows where a condition holds."""
        counts = [(rows, "", F.count(F.lit(1)))] if rows else []
        counts += [(cause, column, F.count_if(hit)) for cause, hits in causes.items() for column, hit in hits.items()]
        if not counts:
            return df
        seen = Observation(f"{self.table} {len(self._watched)}")
        self._watched.append((seen, [(cause, column) for cause, column, _ in counts]))
        return df.observe(seen, *[count.alias(f"n{i}") for i, (_, _, count) in enumerate(counts)])

    def counts(self) -> dict[tuple[str, str], int]:
        """{(cause, column): rows}; waits for the job."""
        found = {}
        for seen, names in self._watched:
            got = seen.get
            found.update({name: int(got.get(f"n{i}") or 0) for i, name in enumerate(names)})
        dropped = sum(n for (cause, _), n in found.items() if cause == "missing")
        found["duplicate", ""] = found["rows_in", ""] - dropped - found["rows_out", ""]
        return found


def loss_report(spark: SparkSession, losses: list[Losses]) -> DataFrame:
    """(table, cause, column, rows, share) of jobs that have run, one row per count; ``share`` is of the rows read."""
    data = []
    for job in losses:
        counts = job.counts()
        total = counts["rows_in", ""]
        data += [(job.table, cause, column, n, n / total if total else 0.0) for (cause, column), n in sorted(counts.items())]
    return spark.createDataFrame(data, "table string, cause string, column string, rows long, share double")
