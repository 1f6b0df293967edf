"""AGG15: row counts of every pipeline stage as one table, one job.

The reference calls ``count()`` after each stage, one job per count (and
recomputes the whole plan for each). Here the stage counts are single-row
aggregates combined with ``unionByName``, so Spark plans and runs them
together; each count is a partial aggregate over its own stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, row_count) for each named stage."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
             for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)


def locks_stage_counts(props: DataFrame, players: DataFrame, props_with_id: DataFrame, stats: DataFrame,
                       history: DataFrame, min_deviation: float) -> DataFrame:
    """Stage counts of the locks job with one pass over the history: the
    per-line aggregation yields the averages, and its row counts sum to the
    history count, so history, averages and locks need no separate passes."""
    from linecast.functions.recommend import deviation_percentage
    from linecast.functions.stats import stat_value
    from linecast.schemas import LINE_KEY

    per_line = history.groupBy(*LINE_KEY).agg(
        F.avg(stat_value("stat")).alias("_pv"), F.count(F.lit(1)).alias("_rows"))
    tail = per_line.agg(
        F.sum("_rows").alias("history"),
        F.count(F.lit(1)).alias("averages"),
        F.count(F.when(deviation_percentage("_pv", "line") >= F.lit(min_deviation), 1)).alias("locks"),
    ).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stage"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("row_count"))
        for n in ["history", "averages", "locks"]
    ])).alias("_s")).select("_s.*")
    head = stage_counts({"props": props, "players": players, "props_with_id": props_with_id, "stats": stats})
    return head.unionByName(tail)


class StageCounts:
    """AGG15 inside a job: rows are counted where they pass, while the job's own
    action runs, so the counts cost no job of their own.

    ``watch(name, rows)`` returns the rows with an observation; after the action
    ``read()`` gives the counts. A stage that the action never computed is left
    out (its observation has not ended)."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str, rows: DataFrame) -> DataFrame:
        if name in self._seen:
            raise ValueError(f"stage {name} is watched already")
        self._seen[name] = Observation(name)
        return rows.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def read(self) -> dict[str, int]:
        return {name: o.get["rows"] for name, o in self._seen.items()}


def unwatched(name: str, rows: DataFrame) -> DataFrame:
    """The stand-in for :meth:`StageCounts.watch` of a job that counts nothing."""
    return rows
