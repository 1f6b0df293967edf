"""Commit ledger of the predictions table (SNK2, SNK3, SNK5).

A parquet target is a folder with two parts::

    rows/run=<token>/game_date=.../part-*.parquet    staged rows of a run
    runs/<version>.json                              one manifest row per committed run

A run first writes its rows under a token of its own, then commits by creating
the next version's manifest file, which must not exist: the rows appear at once
or not at all, and of two runs that read the same version one has to read again
before it commits. Rows whose token has no manifest row, of a run that failed
between the two steps, are never read.

The manifest is also the run index of the reports: a row per run with its
counts, times and timings, so the page's polls read no prediction file.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecast.schemas import PREDICTIONS
from linecast.sinks.append import new_rows

RUNS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("token", T.StringType()),
    T.StructField("run_ts", T.StringType()),
    T.StructField("reaches", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("first_created", T.TimestampType()),
    T.StructField("last_created", T.TimestampType()),
    T.StructField("monte_carlo", T.DoubleType()),
    T.StructField("total_time", T.DoubleType()),
    T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
])


class CommitConflict(RuntimeError):
    """Another run committed since this one read the table."""


_locks: dict[str, threading.Lock] = {}
_guard = threading.Lock()


class Ledger:
    """The predictions table in ``path``, with its manifest."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = PREDICTIONS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    # --- the manifest -----------------------------------------------------------

    def _fs(self, path: str):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(conf), at

    def version(self) -> int:
        """The number of committed runs."""
        fs, at = self._fs(f"{self.path}/runs")
        if not fs.exists(at):
            return 0
        # Versions have no gaps: each was created after all before it.
        return sum(s.getPath().getName().endswith(".json") for s in fs.listStatus(at))

    def runs(self, version: int | None = None) -> DataFrame:
        """The manifest: one row per committed run (up to ``version``)."""
        last = self.version() if version is None else version
        if last == 0:
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).json(f"{self.path}/runs").where(F.col("version") <= last)

    def committed(self, run_id: str) -> dict | None:
        """The manifest row of a run, if it is committed."""
        row = self.runs().where(F.col("run_id") == run_id).first()
        return row.asDict() if row else None

    def reaches(self) -> str | None:
        """The newest mark that a committed run has consumed up to."""
        return self.runs().agg(F.max("reaches")).first()[0]

    # --- rows ---------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The committed rows; the join with the manifest prunes the folders of other tokens."""
        runs = self.runs(version).where("rows > 0").select(F.col("token").alias("run"))
        fs, at = self._fs(f"{self.path}/rows")
        if not fs.exists(at):
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("run", T.StringType())])).parquet(f"{self.path}/rows")
        return stored.join(runs, "run", "left_semi").select(*self.schema.names)

    def stage(self, rows: DataFrame, token: str) -> None:
        """Write rows that nobody reads until the run is committed."""
        rows.write.mode("error").partitionBy("game_date").parquet(f"{self.path}/rows/run={token}")

    def commit(self, version: int, entry: dict) -> None:
        """Append the manifest row of a run that read ``version``.

        Creating the file is the commit: it fails if the version exists. A run
        that dies before the row is in it leaves a version without a run."""
        fs, at = self._fs(f"{self.path}/runs/{version + 1:012d}.json")
        try:
            out = fs.create(at, False)
        except Py4JJavaError:
            if fs.exists(at):
                raise CommitConflict(f"version {version + 1} of {self.path} was committed by another run") from None
            raise
        try:
            out.write((json.dumps(entry | {"version": version + 1}) + "\n").encode("utf-8"))
        finally:
            out.close()

    def append(self, run_id: str, run_ts: str, make: Callable[[], DataFrame], reaches: str | None = None,
               counts: Callable[[], dict] = dict, attempts: int = 5) -> dict:
        """Append the new rows of a run once; returns its manifest row.

        ``make`` gives the run's rows (kept by the caller, a conflict reads them
        again). A committed run is not made again. Rows
        whose key is stored are left out, null parts of a key being equal, so
        that a replay of rows without a statistic adds nothing either.
        """
        with _guard:
            lock = _locks.setdefault(self.path, threading.Lock())
        with lock:
            done = self.committed(run_id)
            if done is not None:
                return done | {"replayed": True}
            rows = make()
            for attempt in range(1, attempts + 1):
                version, token = self.version(), f"r{uuid.uuid4().hex}"
                self.stage(new_rows(rows, self.read(version), null_safe=True), token)
                entry = {"run_id": run_id, "token": token, "run_ts": run_ts, "reaches": reaches, **self._index(token), "counts": counts()}
                try:
                    self.commit(version, entry)
                    break
                except CommitConflict:
                    # The other run's rows count now; it may have been this very run.
                    done = self.committed(run_id)
                    if done is not None:
                        return done | {"replayed": True}
                    if attempt == attempts:
                        raise
            return self.committed(run_id) | {"replayed": False}

    def _index(self, token: str) -> dict:
        """What the reports need of a staged run."""
        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows/run={token}")
        text = lambda c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
        row = run_index(stored, F.lit(token)).select("rows", text("first_created"), text("last_created"), "monte_carlo", "total_time").first()
        return row.asDict() if row else {"rows": 0}


def run_index(predictions: DataFrame, run: F.Column | None = None) -> DataFrame:
    """One row per run (default: per creation time, which rows of a run share):
    row count, first and last creation time, largest timings."""
    return predictions.groupBy((F.col("created_at") if run is None else run).alias("run")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("created_at").alias("first_created"), F.max("created_at").alias("last_created"),
        F.max("processing_time_seconds").alias("monte_carlo"), F.max("total_processing_time_seconds").alias("total_time"))
