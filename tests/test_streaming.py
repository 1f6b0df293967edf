"""Trigger stream end to end: file source, availableNow, parquet target."""

import os
import time

from pyspark.sql import functions as F

from linecast.operators import reports
from linecast.plans import jobs
from linecast.schemas import PREDICTIONS
from linecast.sinks.append import read_parquet_target
from linecast.sources.triggers import count_triggers, parse_triggers, publish_triggers, read_trigger_files, trigger_record
from linecast.streaming.runner import Target, batch_handler, run_batch, run_once, start
from tests.conftest import SF_SMALL


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_runs_once_per_batch_and_replays_add_nothing(spark, tmp_dir):
    src, target, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/predictions", f"{tmp_dir}/ckpt"
    inputs = jobs.fixture_inputs(spark, SF_SMALL)
    analysis = lambda ts, run_id: jobs.locks_job(inputs, run_ts=ts)
    log = []
    _write(src, "a.json", ['{"job_type": "prop_bet_analysis", "timestamp": "2024-01-02T00:00:00Z"}',
                           '{"job_type": "prop_bet_analysis", "timestamp": "2024-01-02T00:00:01Z"}',
                           '{"job_type": "something_else"}'])
    q = start(spark, read_trigger_files(spark, src), analysis, target, ckpt, available_now=True, log=log)
    q.awaitTermination()
    stored = read_parquet_target(spark, target, PREDICTIONS)
    n1 = stored.count()
    assert n1 > 0 and log[0]["triggers"] == 2 and log[0]["rejected"] == 1 and log[0]["run_ts"] == "2024-01-02 00:00:01" and log[0]["written"] == n1
    assert stored.filter("processing_time_seconds IS NULL").count() == 0

    _write(src, "b.json", ['{"job_type": "prop_bet_analysis", "timestamp": "2024-01-02T23:59:00Z"}'])
    _write(src, "c.json", ['{"job_type": "ignored"}'])
    q = start(spark, read_trigger_files(spark, src), analysis, target, ckpt, available_now=True, log=log)
    q.awaitTermination()
    assert read_parquet_target(spark, target, PREDICTIONS).count() == n1     # same day: nothing new
    assert log[-1]["triggers"] in (0, 1)


def test_replay_on_another_day_adds_nothing_and_no_cache_is_left(spark, tmp_dir, monkeypatch):
    """The run's time comes from the batch: a retry after midnight repeats it."""
    target = f"{tmp_dir}/predictions"
    inputs = jobs.fixture_inputs(spark, SF_SMALL)
    handle = batch_handler(spark, lambda ts, run_id: jobs.locks_job(inputs, run_ts=ts), target, log := [])
    batch = spark.createDataFrame([('{"job_type": "prop_bet_analysis", "timestamp": "2024-01-02T23:59:59Z"}',), ("{broken",)], "v string").select(
        F.current_timestamp().alias("timestamp"), F.col("v").cast("binary").alias("value"))
    handle(batch, 7)
    monkeypatch.setattr(time, "time", lambda now=time.time: now() + 86_400)
    handle(batch, 7)
    assert log[0]["written"] > 0 and log[1]["written"] == 0 and log[0]["rejected"] == 1
    assert log[0]["run_id"] == log[1]["run_id"] == "batch-7-2024-01-02 23:59:59"
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_batch_job_stamps_its_rows_and_other_targets_work(spark, tmp_dir):
    inputs = jobs.fixture_inputs(spark, SF_SMALL)
    stored = []
    target = Target(lambda: spark.createDataFrame([], PREDICTIONS), lambda df: stored.extend(df.collect()))
    messages = spark.createDataFrame([('{"job_type": "prop_bet_analysis", "timestamp": "2024-01-02T10:00:00Z"}',)], "v string").select(
        F.current_timestamp().alias("timestamp"), F.col("v").cast("binary").alias("value"))
    done = run_batch(spark, messages, lambda ts, run_id: jobs.batch_points_job(inputs, run_ts=ts), target)
    assert done["written"] == len(stored) > 0
    assert {str(r.created_at) for r in stored} == {"2024-01-02 10:00:00"}
    path = f"{tmp_dir}/predictions"
    run_batch(spark, messages, lambda ts, run_id: jobs.batch_points_job(inputs, run_ts=ts), path)
    assert reports.run_metrics(read_parquet_target(spark, path, PREDICTIONS)).count() > 0
    assert run_batch(spark, messages.limit(0), lambda ts, run_id: None, path) is None


def test_scenario_run_is_seeded_by_its_run_id(spark, tmp_dir):
    inputs = jobs.fixture_inputs(spark, SF_SMALL)
    analysis = lambda ts, run_id: jobs.scenario_job(inputs, run_ts=ts, seed=run_id, n_draws=300)
    rows = []
    for run_id in ("a", "a", "b"):
        kept = []
        run_once(spark, analysis, Target(lambda: spark.createDataFrame([], PREDICTIONS), lambda df, kept=kept: kept.extend(df.collect())), "2024-01-02 00:00:00", run_id)
        rows.append(sorted((r.personid, r.stat_type, r.line, r.predicted_value) for r in kept))
    assert rows[0] == rows[1] != rows[2] and rows[0]


def test_published_triggers_are_read_back(spark, tmp_dir):
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    publish_triggers(spark.range(2).select(trigger_record(F.lit("prop_bet_analysis"), at).alias("value")), path=f"{tmp_dir}/topic")
    got = count_triggers(parse_triggers(read_trigger_files(spark, f"{tmp_dir}/topic", streaming=False)))
    assert got == {"accepted": 2, "rejected": 0, "newest": "2024-01-02 00:00:00"}
