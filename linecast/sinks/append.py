"""Idempotent append (SNK2): write only rows whose key is not stored yet.

One code path for every case the reference branches on (empty target, rows
already present, read failure): anti-join against the target's distinct keys,
de-duplicate the batch by key with a deterministic survivor, append. A failed
read of the target raises instead of inserting blind (B14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecast.schemas import PREDICTION_KEY


def dedup_by_key(df: DataFrame, key: list[str] = PREDICTION_KEY) -> DataFrame:
    """DD2: one row per key; the survivor is the smallest remaining row, so a
    rerun keeps the same row. An aggregate, so a hot key collapses map-side."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    return df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(
        *key, *[F.col(f"_r.{c}").alias(c) for c in rest]
    ).select(*df.columns)


def new_rows(batch: DataFrame, existing: DataFrame, key: list[str] = PREDICTION_KEY, null_safe: bool = False) -> DataFrame:
    """JN5 + DD3 + DD2: rows of ``batch`` whose key is absent from ``existing``.
    A null key part never matches (it is kept, as in the reference), unless
    ``null_safe``: then null parts are equal, and a replay adds no row at all."""
    if null_safe:
        known = existing.select(*[F.col(k).alias(f"_{k}") for k in key])
        if "game_date" in key:
            days = batch.select(F.col("game_date").alias("_d")).distinct()
            known = known.join(days, F.col("_game_date").eqNullSafe(F.col("_d")), "left_semi")
        match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
        return dedup_by_key(batch.join(known.distinct(), match, "left_anti"), key)
    if "game_date" in key:
        # Only stored rows of the batch's dates can match: with a table
        # partitioned by game_date this semi-join lets dynamic partition
        # pruning read just those partitions instead of the whole history.
        existing = existing.join(batch.select("game_date").distinct(), "game_date", "left_semi")
    existing_keys = existing.select(*key).distinct()
    return dedup_by_key(batch.join(existing_keys, on=key, how="left_anti"), key)


def read_parquet_target(spark: SparkSession, path: str, schema) -> DataFrame:
    """The target table stored as parquet; a missing folder is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as exc:  # only "path does not exist" means empty
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def append_new(batch: DataFrame, existing: DataFrame, write, key: list[str] = PREDICTION_KEY) -> int:
    """Compute the new rows once (persisted), append them with ``write`` and
    return how many were written (B12: counted before, not after the write)."""
    fresh = new_rows(batch, existing, key).persist()
    try:
        n = fresh.count()
        if n:
            write(fresh)
        return n
    finally:
        fresh.unpersist()


def parquet_writer(path: str, partition_by: list[str] | None = None):
    def write(df: DataFrame) -> None:
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return write
