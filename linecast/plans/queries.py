"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables through :mod:`linecast.sources.fixtures`
and applies the library operators. ``finalize`` only presents the result in
an engine-neutral form (doubles rounded to 6 decimals, dates and timestamps
as text) so the DuckDB oracle of :mod:`linecast.plans.oracle` can compare
values exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecast.functions.fmt import round_doubles
from linecast.session import configure, ensure_checkpoint_dir, size_shuffles
from linecast.functions.names import with_name_parts
from linecast.operators import averages, counts, history, history_state, reports, resolve, scenario, segments, skew
from linecast.schemas import PREDICTION_KEY
from linecast.sinks import append
from linecast.sinks.ledger import run_index
from linecast.sources import triggers as trg
from linecast.sources import fixtures as fx
from linecast.sources.props import parse_props, props_as_ndjson, split_props

# Run time used by the registered queries (reruns give identical rows).
RUN_TS = "2024-01-02 00:00:00"
# Seed and draw count of the registered scenario queries (draws as in the reference).
SEED = 42
N_DRAWS = scenario.DRAWS_PER_PREDICTION


def finalize(df: DataFrame) -> DataFrame:
    """Round doubles; render dates as yyyy-MM-dd and timestamps as
    yyyy-MM-dd HH:mm:ss text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return round_doubles(df.select(*cols))


def _props_with_id(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_players(fx.props(spark, d), fx.players(spark, d))


def _history(spark: SparkSession, d: str) -> DataFrame:
    return averages.line_history(fx.stats(spark, d), _props_with_id(spark, d))


# --- sources and projections -------------------------------------------------

def q_scan_props(spark, d):
    return parse_props(props_as_ndjson(fx.props(spark, d)))


def q_props_quarantine(spark, d):
    """Every offered line as NDJSON in files of the shared folder, and once more
    cut in the middle: the scan takes the first and sets the second aside."""
    text = props_as_ndjson(fx.props(spark, d))
    cut = text.select(F.expr("left(value, length(value) - 12)").alias("value"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/props-{uuid.uuid4().hex}"
    text.unionByName(cut).write.text(path)
    lines, broken = split_props(spark, path)
    cols = ["player_name", "stat", "line", "game_date", "team"]
    aside = broken.select(*[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in cols], F.regexp_extract("text", '"player_name":"([^"]*)"', 1).alias("broken_name"))
    return lines.select(*cols, F.lit(None).cast("string").alias("broken_name")).unionByName(aside)


def q_split_names(spark, d):
    return with_name_parts(fx.props(spark, d))


# --- resolution ----------------------------------------------------------------

def q_dedup_players(spark, d):
    return resolve.dedup_players(fx.players(spark, d))


def q_resolve_players(spark, d):
    return _props_with_id(spark, d)


def q_resolve_namesakes(spark, d):
    # Lines offered on names that several ids share: the join fans out.
    nm = fx.players_namesakes(spark, d)
    offered = resolve.dedup_players(nm).select(
        F.concat_ws(" ", "firstname", "lastname").alias("player_name"),
        F.lit("points").alias("stat"),
        F.lit(10.5).alias("line"),
        F.lit("N").alias("team"),
    ).distinct()
    return resolve.resolve_players(offered, nm)


def q_stat_types(spark, d):
    return resolve.stat_types(_props_with_id(spark, d))


# --- mean-based predictions --------------------------------------------------------

def q_stat_value(spark, d):
    h = averages.with_stat_value(_history(spark, d))
    return h.select("personid", "gameid", "row_a", "row_b", "stat", "line", "x")


def q_stat_averages(spark, d):
    return averages.stat_averages(_history(spark, d))


def q_stat_averages_split(spark, d):
    return averages.stat_averages(skew.split_join(fx.stats(spark, d), _props_with_id(spark, d), "personid", ["gameid", "row_a", "row_b"]))


def q_stat_averages_union(spark, d):
    return averages.stat_averages_union(_history(spark, d))


def q_deviation(spark, d):
    return averages.with_mean_recommendation(averages.stat_averages(_history(spark, d)))


def q_locks_final(spark, d):
    return averages.locks_final(fx.stats(spark, d), _props_with_id(spark, d), run_ts=RUN_TS)


def q_batch_points_predictions(spark, d):
    return averages.batch_points_predictions(_history(spark, d), run_ts=RUN_TS)


# --- history -----------------------------------------------------------------------

def _sized(spark, stats):
    """``stats``, its rows counted (from the file footers) for the shuffles to come."""
    size_shuffles(spark, stats.count())
    return stats


def _unified(spark, d):
    return history.unified_history(_sized(spark, fx.stats(spark, d)), _props_with_id(spark, d), fx.games(spark, d))


def _summary(spark, d):
    return history.with_model_inputs(history.summarize_lines(_unified(spark, d)))


def q_unified_history(spark, d):
    return _unified(spark, d)


def q_recency_rank(spark, d):
    r = history.with_recency(_unified(spark, d))
    return r.select(*history.LINE_KEY, "gameid", "row_a", "row_b", "rk", "w")


def q_decay_summary(spark, d):
    return _summary(spark, d).select(
        *history.LINE_KEY, "base_avg", "std_dev", "min_val", "max_val", "game_count")


def q_season_trend(spark, d):
    return _summary(spark, d).select(*history.LINE_KEY, "base_avg", "recent_avg", "trend")


def q_streak_state(spark, d):
    return _summary(spark, d).select(*history.LINE_KEY, "base_avg", "last3_avg", "streak")


def q_elite_flag(spark, d):
    return _summary(spark, d).select(*history.LINE_KEY, "base_avg", "game_count", "is_elite")


def q_history_segments(spark, d):
    return segments.concatenated(segments.history_segments(_unified(spark, d)))


def q_segment_rules(spark, d):
    return segments.rules_from_segments(segments.history_segments(_unified(spark, d)))


# The day between the stored state and the games read after it.
STATE_UNTIL = "1995-06-17"


def q_decay_from_state(spark, d):
    stats = _sized(spark, fx.stats(spark, d))
    part = lambda **days: history_state.fold(history.unified_history(
        stats, _props_with_id(spark, d), history_state.in_range(fx.games(spark, d), **days)))
    return history_state.summary(history_state.merge(part(until=STATE_UNTIL), part(since=STATE_UNTIL)))


# --- scenario simulation -----------------------------------------------------------

def _inputs(spark, d):
    return scenario.scenario_inputs(_summary(spark, d), SEED)


def _simulated(spark, d):
    return scenario.simulate(_summary(spark, d), N_DRAWS, SEED)


def q_daily_factors(spark, d):
    return _inputs(spark, d).select(*history.LINE_KEY, *scenario.DAILY_FACTORS)


def q_scenario_draws(spark, d):
    return scenario.draw_statistics(scenario._checkpoint(_inputs(spark, d)), N_DRAWS)


def q_scenario_summary(spark, d):
    inputs = scenario._checkpoint(_inputs(spark, d))
    return scenario.scenario_summary(inputs, N_DRAWS)


def q_scenario_short_history(spark, d):
    # Customers and their orders: players with few games (SCN11, FLT3).
    box, lines, games = fx.customer_lines(spark, d)
    return scenario.short_history(history.decay_summary(_sized(spark, box), lines, games))


def q_recommend_scenario(spark, d):
    return scenario.with_scenario_recommendation(_simulated(spark, d))


def q_scenario_predictions(spark, d):
    return scenario.scenario_predictions(
        scenario.with_scenario_recommendation(_simulated(spark, d)), run_ts=RUN_TS)


# --- sink logic, counts ----------------------------------------------------------

# The locks batch of a run on the lines' game day, appended to a table that
# already holds the rows stored before 00:05 of the next day.
LOCKS_RUN_TS = "2024-01-01 18:00:00"
STORED_BEFORE = "2024-01-02 00:05:00"


def q_locks_new_only(spark, d):
    batch = averages.locks_final(fx.stats(spark, d), _props_with_id(spark, d), run_ts=LOCKS_RUN_TS)
    stored = fx.predictions(spark, d).filter(F.col("created_at") < F.lit(STORED_BEFORE).cast("timestamp"))
    return append.new_rows(batch, stored)


def q_stage_counts(spark, d):
    props = fx.props(spark, d)
    players = fx.players(spark, d)
    with_id = resolve.resolve_players(props, players)
    stats = fx.stats(spark, d)
    return counts.locks_stage_counts(props, resolve.dedup_players(players), with_id, stats,
                                     averages.line_history(stats, with_id), averages.LOCK_MIN_DEVIATION)


# --- reports ---------------------------------------------------------------------

def q_report_locks(spark, d):
    return reports.report_locks(fx.predictions(spark, d), fx.players(spark, d))


def q_report_recent(spark, d):
    return reports.report_recent(fx.predictions(spark, d), fx.players(spark, d))


def q_run_metrics(spark, d):
    return reports.run_metrics(fx.predictions(spark, d))


def q_run_metrics_index(spark, d):
    return reports.run_metrics_from_index(run_index(fx.predictions(spark, d)))


def q_prediction_count_index(spark, d):
    return reports.prediction_count_from_index(run_index(fx.predictions(spark, d)))


def q_locks_null_safe(spark, d):
    # The whole table appended to what was stored of it before a time, with null
    # key parts on both sides (lines of points players count as unknown).
    rows = fx.predictions(spark, d).withColumn("line", F.when(F.col("stat_type") != "points", F.col("line")))
    stored = rows.where(F.col("created_at") < F.lit(STORED_BEFORE).cast("timestamp"))
    return append.new_rows(rows, stored, null_safe=True).select(*PREDICTION_KEY)


def q_prediction_count(spark, d):
    return reports.prediction_count(fx.predictions(spark, d))


# --- triggers --------------------------------------------------------------------

def q_parse_triggers(spark, d):
    return trg.parse_triggers(fx.triggers(spark, d))


def q_route_triggers(spark, d):
    return trg.route_triggers(trg.parse_triggers(fx.triggers(spark, d)))


def q_trigger_records(spark, d):
    e = fx.table(spark, d, "events")
    job = F.when(F.col("event_type") == "purchase", F.lit(trg.ANALYSIS_JOB)).otherwise(F.col("event_type"))
    return e.select(trg.trigger_record(job, F.col("ts")).alias("value"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_props": q_scan_props,
    "props_quarantine": q_props_quarantine,
    "split_names": q_split_names,
    "dedup_players": q_dedup_players,
    "resolve_players": q_resolve_players,
    "resolve_namesakes": q_resolve_namesakes,
    "stat_types": q_stat_types,
    "stat_value": q_stat_value,
    "stat_averages": q_stat_averages,
    "stat_averages_split": q_stat_averages_split,
    "stat_averages_union": q_stat_averages_union,
    "deviation": q_deviation,
    "locks_final": q_locks_final,
    "batch_points_predictions": q_batch_points_predictions,
    "unified_history": q_unified_history,
    "recency_rank": q_recency_rank,
    "decay_summary": q_decay_summary,
    "season_trend": q_season_trend,
    "streak_state": q_streak_state,
    "elite_flag": q_elite_flag,
    "history_segments": q_history_segments,
    "segment_rules": q_segment_rules,
    "decay_from_state": q_decay_from_state,
    "daily_factors": q_daily_factors,
    "scenario_draws": q_scenario_draws,
    "scenario_summary": q_scenario_summary,
    "scenario_short_history": q_scenario_short_history,
    "recommend_scenario": q_recommend_scenario,
    "scenario_predictions": q_scenario_predictions,
    "locks_new_only": q_locks_new_only,
    "stage_counts": q_stage_counts,
    "report_locks": q_report_locks,
    "report_recent": q_report_recent,
    "run_metrics": q_run_metrics,
    "prediction_count": q_prediction_count,
    "run_metrics_index": q_run_metrics_index,
    "prediction_count_index": q_prediction_count_index,
    "locks_null_safe": q_locks_null_safe,
    "parse_triggers": q_parse_triggers,
    "route_triggers": q_route_triggers,
    "trigger_records": q_trigger_records,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries wrapped with :func:`finalize`; the session gets the runtime
    settings of :func:`linecast.session.configure` first."""
    def wrap(fn):
        def run(spark: SparkSession, d: str) -> DataFrame:
            configure(spark)
            return finalize(fn(spark, d))
        return run
    return {name: wrap(fn) for name, fn in QUERIES.items()}
