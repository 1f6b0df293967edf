"""Mean-based predictions: the batch job (mean points) and the locks job
(mean of the line's own stat, deviation filter)."""

from __future__ import annotations

import datetime as _dt
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.functions.recommend import LOCK_MIN_DEVIATION, binary_outcome, deviation_percentage
from linecast.functions.stats import DEFAULT_STAT_COLUMN, STAT_COLUMN, stat_value
from linecast.schemas import LINE_KEY


def line_history(stats: DataFrame, props_with_id: DataFrame) -> DataFrame:
    """JN2: every box-score row of a resolved player, once per offered line."""
    return stats.join(props_with_id, on="personid", how="inner")


def with_stat_value(history: DataFrame) -> DataFrame:
    """EXP5: ``x`` = the value of the line's stat on each row."""
    return history.withColumn("x", stat_value("stat"))


def named_stats(history: DataFrame) -> DataFrame:
    """FLT2: rows whose line names a statistic. The per-stat jobs drop lines
    without one (their stat filter never matches null); the batch job keeps them."""
    return history.filter(F.col("stat").isNotNull())


def stat_averages(history: DataFrame) -> DataFrame:
    """AGG2: mean of the line's own stat per line, in one pass over the
    history (a single conditional expression instead of one filtered branch
    per stat type). Partial aggregation runs map-side."""
    return with_stat_value(named_stats(history)).groupBy(*LINE_KEY).agg(F.avg("x").alias("predicted_value"))


def stat_averages_union(history: DataFrame, stat_names: list[str] | None = None) -> DataFrame:
    """SET1: the per-stat-branch form (one branch per known stat name and one
    for every other name, which falls back to points).

    Kept as the equivalence check of :func:`stat_averages`. All measures are
    averaged per line in one scan; the branches stand above the aggregate.
    """
    names = stat_names or list(STAT_COLUMN)
    measures = sorted({STAT_COLUMN[n] for n in names} | {DEFAULT_STAT_COLUMN})
    means = named_stats(history).groupBy(*LINE_KEY).agg(*[F.avg(F.col(m).cast("double")).alias(f"_{m}") for m in measures])
    branches = [F.struct((F.col("stat") == n).alias("taken"), F.col(f"_{STAT_COLUMN[n]}").alias("mean")) for n in names]
    branches.append(F.struct((~F.col("stat").isin(names)).alias("taken"), F.col(f"_{DEFAULT_STAT_COLUMN}").alias("mean")))
    return (
        means.withColumn("_b", F.explode(F.array(*branches))).filter("_b.taken")
        .select(*LINE_KEY, F.col("_b.mean").alias("predicted_value"))
    )


def with_mean_recommendation(avgs: DataFrame) -> DataFrame:
    """EXP6 + EXP8: over/under and the deviation from the line."""
    return avgs.withColumn("bet_outcome", binary_outcome("predicted_value", "line")).withColumn(
        "deviation_percentage", deviation_percentage("predicted_value", "line")
    )


def locks(recommended: DataFrame, min_deviation: float = LOCK_MIN_DEVIATION) -> DataFrame:
    """FLT1: keep lines whose deviation is at least ``min_deviation`` percent."""
    return recommended.filter(F.col("deviation_percentage") >= F.lit(min_deviation))


def _run_stamps(run_ts: str | _dt.datetime | None):
    if run_ts is None:
        return F.current_date(), F.current_timestamp()
    ts = F.lit(str(run_ts)).cast("timestamp")
    return F.to_date(ts), ts


def shape_locks(locked: DataFrame, run_ts: str | None = None) -> DataFrame:
    """PRJ4 + PRJ6 + PRJ9: rows in the predictions-table layout. ``game_date``
    is the run date (as the reference stores it); ``run_ts`` pins the run
    time so reruns and oracles are stable (default: now)."""
    run_date, created = _run_stamps(run_ts)
    return locked.withColumnRenamed("stat", "stat_type").select(
        "personid", "player_name", "stat_type", "line",
        run_date.alias("game_date"), "team", "predicted_value", "bet_outcome",
        "deviation_percentage", created.alias("created_at"),
    )


def batch_points_predictions(history: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Q1: mean *points* for every line whatever its stat (the batch job's
    defined behaviour), over/under, typed null team, 7 output columns."""
    run_date, _ = _run_stamps(run_ts)
    avgs = history.groupBy("personid", "player_name", "stat", "line").agg(
        F.avg(F.col("points").cast("double")).alias("predicted_value")
    )
    return (
        avgs.withColumn("bet_outcome", binary_outcome("predicted_value", "line"))
        .withColumnRenamed("stat", "stat_type")
        .select(
            "personid", "stat_type", "line", run_date.alias("game_date"),
            F.lit(None).cast("string").alias("team"), "predicted_value", "bet_outcome",
        )
    )


def locks_final(stats: DataFrame, props_with_id: DataFrame, run_ts: str | None = None,
                min_deviation: float = LOCK_MIN_DEVIATION) -> DataFrame:
    """Q2 without the sink: averages -> recommendation -> lock filter -> layout."""
    return locks_of(stat_averages(line_history(stats, props_with_id)), run_ts, min_deviation)


def locks_of(avgs: DataFrame, run_ts: str | None = None, min_deviation: float = LOCK_MIN_DEVIATION) -> DataFrame:
    """The rows of Q2 from the lines' means."""
    return shape_locks(locks(with_mean_recommendation(avgs), min_deviation), run_ts)
