"""End-to-end jobs: inputs -> predictions in the target-table layout.

``Inputs`` bundles the four source relations. ``fixture_inputs`` reads them
from the driver's parquet tables; ``production_inputs`` reads the offered
lines from NDJSON and the three tables over JDBC with partitioned reads.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecast.functions.recommend import DRAWS_PER_PREDICTION
from linecast.operators import averages, history, resolve, scenario
from linecast.operators.counts import StageCounts, unwatched
from linecast.sources import fixtures as fx
from linecast.sources import jdbc
from linecast.sources.props import split_props


@dataclass
class Inputs:
    props: DataFrame
    players: DataFrame
    stats: DataFrame
    games: DataFrame
    broken: DataFrame | None = None   # lines that did not parse: file, text


def fixture_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(fx.props(spark, sf_dir), fx.players(spark, sf_dir), fx.stats(spark, sf_dir),
                  fx.games(spark, sf_dir))


def production_inputs(spark: SparkSession, props_path: str, url: str, properties: dict[str, str],
                      partitions: int = 4) -> Inputs:
    """Lines from NDJSON; players, box scores and games over JDBC, each split
    into ``partitions`` hash parts (plus a part for null ids). Lines that do not
    parse are set aside in ``broken``."""
    players = jdbc.read_table(spark, url, "Players", properties, jdbc.hash_predicates("personid", partitions),
                              ["personid", "firstname", "lastname"])
    stats = jdbc.read_table(spark, url, "PlayerStatistics", properties, jdbc.hash_predicates("id", partitions))
    stats = stats.select(
        "personid", "gameid", F.col("id").alias("row_a"), F.lit(0).cast("long").alias("row_b"),
        *[F.col(c).cast("double").alias(c) for c in
          ["points", "assists", "reboundstotal", "steals", "blocks", "threepointersmade"]],
    )
    games = jdbc.read_table(spark, url, "Games", properties, jdbc.hash_predicates("gameid", partitions),
                            ["gameid", "gamedate"])
    lines, broken = split_props(spark, props_path)
    return Inputs(lines, players, stats, games, broken)


def resolved(inputs: Inputs) -> DataFrame:
    return resolve.resolve_players(inputs.props, inputs.players)


def batch_points_job(inputs: Inputs, run_ts: str | None = None) -> DataFrame:
    """Q1 (batch job)."""
    hist = averages.line_history(inputs.stats, resolve.resolve_players(inputs.props, inputs.players, keep_team=False))
    return averages.batch_points_predictions(hist, run_ts)


def locks_job(inputs: Inputs, run_ts: str | None = None, stages: StageCounts | None = None) -> DataFrame:
    """Q2 (locks job) without the sink. ``stages`` counts the rows of its seven
    stages while it runs (AGG15)."""
    watch = stages.watch if stages else unwatched
    players = watch("players", resolve.dedup_players(inputs.players))
    with_id = watch("props_with_id", resolve.resolve_players(watch("props", inputs.props), players))
    history = watch("history", averages.line_history(watch("stats", inputs.stats), with_id))
    means = watch("averages", averages.stat_averages(history))
    return watch("locks", averages.locks_of(means, run_ts))


def scenario_job(inputs: Inputs, run_ts: str | None = None, seed: int | str | None = None,
                 n_draws: int = DRAWS_PER_PREDICTION) -> DataFrame:
    """Q3 (scenario job) without the sink: predictions with probability,
    interval, confidence and risk labels. ``seed``: give the run's id, so that
    runs differ and a replayed run repeats its draws (default: the run time)."""
    if seed is None:
        seed = run_ts if run_ts is not None else str(time.time())
    summary = history.decay_summary(inputs.stats, resolved(inputs), inputs.games)
    sim = scenario.simulate(summary, n_draws, seed)
    return scenario.scenario_predictions(scenario.with_scenario_recommendation(sim), run_ts)


def with_timings(predictions: DataFrame, run) -> tuple[DataFrame, DataFrame, float, float]:
    """Materialise ``predictions`` (the action that runs the simulation) and
    stamp the measured times (B8: measured around the action, not before it).
    ``run`` is the wall-clock start of the whole run. Returns the stamped rows,
    the cached frame for the caller to unpersist, and the two times."""
    t0 = time.time()
    ready = predictions.persist()
    ready.count()
    sim_s = time.time() - t0
    total_s = time.time() - run
    out = ready.withColumn("processing_time_seconds", F.lit(float(sim_s))).withColumn(
        "total_processing_time_seconds", F.lit(float(total_s)))
    return out, ready, sim_s, total_s
