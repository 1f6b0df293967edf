"""Run the analysis when trigger messages arrive (STR1-STR7, SNK5).

The stream carries only small trigger records; ``foreachBatch`` turns each
micro-batch into at most one analysis run (the reference runs the whole
analysis once per message, sequentially). The run's time and id come from the
batch, not from the clock, and the run appends its predictions idempotently:
a micro-batch replayed after a failure, even on another day, adds no duplicate
rows. Errors propagate: the micro-batch is not committed and is retried
instead of being silently lost (B13).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linecast.operators.counts import StageCounts
from linecast.plans.jobs import with_timings
from linecast.schemas import PREDICTIONS
from linecast.sinks.append import append_new, parquet_writer, read_parquet_target
from linecast.sinks.ledger import Ledger
from linecast.sources.jdbc import append_table, read_table
from linecast.sources.triggers import after_mark, count_triggers, newest_mark, parse_triggers
from linecast.streaming.lifecycle import Lifecycle, observed

Analysis = Callable[[str, str], DataFrame]   # run timestamp, run id -> predictions (table layout)


@dataclass
class Target:
    """Where predictions are stored: how to read the table and append to it."""

    read: Callable[[], DataFrame]
    write: Callable[[DataFrame], None]


def parquet_target(spark: SparkSession, path: str) -> Target:
    """Parquet, one game_date partition per daily run; date-filtered reads prune."""
    return Target(lambda: read_parquet_target(spark, path, PREDICTIONS), parquet_writer(path, partition_by=["game_date"]))


def jdbc_target(spark: SparkSession, url: str, table: str, properties: dict[str, str], max_connections: int = 4) -> Target:
    """The predictions table of a database (not run here: no database may be started)."""
    return Target(lambda: read_table(spark, url, table, properties), lambda df: append_table(df, url, table, properties, max_connections=max_connections))


def conform(predictions: DataFrame, run_ts: str) -> DataFrame:
    """Add missing target columns as typed nulls and cast to the table schema;
    rows without a creation time get the run's (the table's column default)."""
    cols = []
    for f in PREDICTIONS.fields:
        src = F.col(f.name) if f.name in predictions.columns else F.lit(None)
        if f.name == "created_at":
            src = F.coalesce(src.cast(f.dataType), F.lit(run_ts).cast(f.dataType))
        cols.append(src.cast(f.dataType).alias(f.name))
    return predictions.select(*cols)


def run_once(spark: SparkSession, analysis: Analysis, target: Target | Ledger | str, run_ts: str | None = None, run_id: str | None = None, reaches: str | None = None, stages: StageCounts | None = None) -> dict:
    """One analysis run appended idempotently to the target (a path: parquet).

    With a :class:`Ledger` the run is committed once: a replay of a committed run
    does not start the analysis. ``reaches``: how far into the messages it is
    committed with. ``stages``: row counts observed inside the run (AGG15)."""
    start = time.time()
    target = parquet_target(spark, target) if isinstance(target, str) else target
    ts = run_ts or time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(start))
    run_id = run_id or f"run-{ts}"
    counts = stages.read if stages else dict
    if isinstance(target, Ledger):
        timed = {"simulation_s": None, "total_s": None}
        caches = []

        def make() -> DataFrame:
            preds, cached, timed["simulation_s"], timed["total_s"] = with_timings(analysis(ts, run_id), start)
            caches.append(cached)
            return conform(preds, ts)

        try:
            row = target.append(run_id, ts, make, reaches, counts)
        finally:
            for cached in caches:
                cached.unpersist()
        written = 0 if row["replayed"] else row["rows"]
        return {"run_ts": ts, "run_id": run_id, "written": written, "replayed": row["replayed"], "counts": row["counts"] or {}, **timed}
    preds, cached, sim_s, total_s = with_timings(analysis(ts, run_id), start)
    try:
        written = append_new(conform(preds, ts), target.read(), target.write)
    finally:
        cached.unpersist()
    return {"run_ts": ts, "run_id": run_id, "written": written, "simulation_s": sim_s, "total_s": total_s, "counts": counts()}


def _run_of(counted: dict, run_id: str) -> dict:
    """Run time and id of a batch of triggers, the same on every replay."""
    return {"run_ts": counted["newest"], "run_id": f"{run_id}-{counted['newest']}"}


def batch_handler(spark: SparkSession, analysis: Analysis, target: Target | Ledger | str, log: list | None = None, lifecycle: Lifecycle | None = None):
    """``foreachBatch`` function: route the batch's triggers and run once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if lifecycle is not None:
            lifecycle.begin(batch_id)
        counted = count_triggers(parse_triggers(batch))
        entry = {"batch_id": batch_id, "triggers": counted["accepted"], "rejected": counted["rejected"]}
        if counted["accepted"]:
            entry.update(run_once(spark, analysis, target, **_run_of(counted, f"batch-{batch_id}")))
        if log is not None:
            log.append(entry)

    return handle


def start(spark: SparkSession, messages: DataFrame, analysis: Analysis, target: Target | Ledger | str,
          checkpoint_location: str, processing_time: str | None = "60 seconds",
          available_now: bool = False, log: list | None = None, lifecycle: Lifecycle | None = None) -> StreamingQuery:
    """Start the trigger stream; the caller owns the returned query handle
    (``awaitTermination`` / ``stop``). ``lifecycle``: an attached listener that
    records progress, trigger counts and the error that ends the stream."""
    if lifecycle is not None:
        messages = observed(messages)
    writer = (
        messages.writeStream.foreachBatch(batch_handler(spark, analysis, target, log, lifecycle))
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.queryName(lifecycle.name) if lifecycle is not None else writer
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def run_batch(spark: SparkSession, messages: DataFrame, analysis: Analysis, target: Target | Ledger | str) -> dict | None:
    """Batch job: if the message table holds any analysis trigger, run once.

    With a :class:`Ledger` only messages after the mark committed with the last
    run count (the time of the newest trigger it took), so a second call without
    new messages does nothing."""
    parsed = parse_triggers(messages)
    reaches = None
    if isinstance(target, Ledger):
        mark = target.reaches()
        parsed = after_mark(parsed, mark) if mark is not None else parsed
        reaches = newest_mark(parsed)
    counted = count_triggers(parsed)
    if not counted["accepted"]:
        return None
    run = _run_of(counted, "batch")
    if reaches is not None:
        # Triggers may share a second: a later one is a run of its own.
        run["run_id"] = f"batch-{reaches}"
    return run_once(spark, analysis, target, **run, reaches=reaches)
