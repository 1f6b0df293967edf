"""Report queries over the predictions table (the web page's four reads)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.functions.fmt import TIME_FORMAT, TS_FORMAT
from linecast.functions.names import display_name
from linecast.functions.recommend import DRAWS_PER_PREDICTION, confidence_badge, display_outcome

REPORT_COLUMNS = [
    "firstname", "lastname", "stat_type", "line", "predicted_value", "bet_outcome", "created_at",
    "deviation_percentage", "team", "probability_over", "confidence_low", "confidence_high",
    "confidence_score", "risk_assessment",
]
RECENT_LIMIT = 20
RUN_WINDOW = _dt.timedelta(minutes=5)


def _round_half_up(c, digits: int):
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def _present(df: DataFrame) -> DataFrame:
    """Row mapping of the page: display name, recomputed OVER/UNDER (B16: the
    stored outcome is kept too), text time, deviation to one decimal (null as
    0.0), missing team as N/A, HIGH/MEDIUM badge."""
    dev = F.col("deviation_percentage")
    return df.select(
        display_name("firstname", "lastname").alias("player_name"),
        "stat_type", "line", "predicted_value", "bet_outcome",
        display_outcome("predicted_value", "line").alias("display_outcome"),
        F.date_format("created_at", TS_FORMAT).alias("created_at"),
        F.coalesce(_round_half_up(dev, 1), F.lit(0.0)).alias("deviation_percentage"),
        F.when(F.col("team").isNull() | (F.col("team") == ""), F.lit("N/A")).otherwise(F.col("team")).alias("team"),
        confidence_badge(dev).alias("confidence"),
        "probability_over", "confidence_low", "confidence_high", "confidence_score", "risk_assessment",
        dev.alias("_dev_raw"), F.col("created_at").alias("_created_raw"),
    )


def _joined(predictions: DataFrame, players: DataFrame) -> DataFrame:
    return predictions.join(players.select("personid", "firstname", "lastname"), "personid").select(*REPORT_COLUMNS)


def report_locks(predictions: DataFrame, players: DataFrame, min_deviation: float | None = None,
                 game_date: str | None = None) -> DataFrame:
    """Q4: distinct stored predictions with player names, highest deviation
    first (nulls last). ``created_at`` is part of the distinct row, so reruns
    stay separate rows. ``min_deviation`` and ``game_date`` (B17) restrict the
    report to deviations of at least that many percent and to one day's rows;
    the reference shows everything."""
    if min_deviation is not None:
        predictions = predictions.filter(F.col("deviation_percentage") >= F.lit(min_deviation))
    if game_date is not None:
        predictions = predictions.filter(F.col("game_date") == F.lit(game_date).cast("date"))
    rows = _present(_joined(predictions, players).distinct())
    return rows.orderBy(F.col("_dev_raw").desc_nulls_last(), "player_name", "stat_type", "line").drop(
        "_dev_raw", "_created_raw")


def report_recent(predictions: DataFrame, players: DataFrame, limit: int = RECENT_LIMIT) -> DataFrame:
    """Q6: top ``limit`` rows by deviation desc (nulls last), then newest first
    (nulls first, as the source database sorts them); a top-k, planned as
    TakeOrderedAndProject (each task keeps only its own top k)."""
    rows = _present(_joined(predictions, players))
    ordered = rows.orderBy(
        F.col("_dev_raw").desc_nulls_last(), F.col("_created_raw").desc_nulls_first(),
        "player_name", "stat_type", "line",
    )
    return ordered.limit(limit).drop("_dev_raw", "_created_raw")


def run_metrics_from_index(runs: DataFrame, draws_per_prediction: int = DRAWS_PER_PREDICTION) -> DataFrame:
    """Q5 from the run index (one row per run, written with its rows): the page
    polls it, so its cost follows the runs, not the predictions. A run's rows
    share their creation time or lie within one run's duration."""
    latest = runs.select(F.max("last_created") - F.expr("INTERVAL 5 MINUTES")).scalar()
    m = runs.where(F.col("last_created") >= latest).agg(
        F.sum("rows").alias("total_predictions"), F.min("first_created").alias("_start"), F.max("last_created").alias("_end"),
        F.max("monte_carlo").alias("_mc"), F.max("total_time").alias("_total"),
    ).where(F.col("total_predictions") > 0)
    return _present_metrics(m, draws_per_prediction)


def prediction_count_from_index(runs: DataFrame) -> DataFrame:
    """Q7 from the run index."""
    return runs.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_predictions"))


def run_metrics(predictions: DataFrame, draws_per_prediction: int = DRAWS_PER_PREDICTION) -> DataFrame:
    """Q5: metrics of the latest run: rows created within five minutes of the
    newest row (uncorrelated scalar subquery), no row when the table is empty."""
    latest = predictions.select(F.max("created_at") - F.expr("INTERVAL 5 MINUTES")).scalar()
    recent = predictions.filter(F.col("created_at") >= latest)
    m = recent.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.min("created_at").alias("_start"),
        F.max("created_at").alias("_end"),
        F.max("processing_time_seconds").alias("_mc"),
        F.max("total_processing_time_seconds").alias("_total"),
    ).filter(F.col("total_predictions") > 0)
    return _present_metrics(m, draws_per_prediction)


def _present_metrics(m: DataFrame, draws_per_prediction: int) -> DataFrame:
    total = F.coalesce(F.col("_total"), F.lit(0.0))
    sims = F.col("total_predictions") * F.lit(draws_per_prediction)
    return m.select(
        "total_predictions",
        F.date_format("_start", TIME_FORMAT).alias("run_start"),
        F.date_format("_end", TIME_FORMAT).alias("run_end"),
        _round_half_up(F.coalesce(F.col("_mc"), F.lit(0.0)), 2).alias("monte_carlo_seconds"),
        _round_half_up(total, 2).alias("total_processing_seconds"),
        F.date_format("_end", TS_FORMAT).alias("last_run_time"),
        sims.alias("monte_carlo_simulations"),
        F.when(total > 0, _round_half_up(sims / F.greatest(total, F.lit(1.0)), 0)).otherwise(F.lit(0.0)).alias(
            "throughput"),
    )


def prediction_count(predictions: DataFrame) -> DataFrame:
    """Q7."""
    return predictions.agg(F.count(F.lit(1)).alias("total_predictions"))
