"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required. A local session without it (tests)
    gets a folder of its own, remembered as the checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master or ""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="linecast-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


#: Removes a write's shuffle files at its end instead of when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str, clean: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, so a lost executor costs a reread instead of a
    recomputation, and later steps see fixed rows and known sizes. The files
    go when the driver's JVM ends, or with :func:`release`. ``clean``: the
    write's shuffle files go at once, for steps that leave large ones.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/linecast-llm/{tag}-{uuid.uuid4().hex}"
    was = spark.conf.get(_CLEANUP, "false")
    try:
        if clean:
            spark.conf.set(_CLEANUP, "true")
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.set(_CLEANUP, was)
    hpath, fs = _hadoop(spark, path)
    fs.deleteOnExit(hpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def release(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` returned; what was
    computed from it must be written by now."""
    hpath, fs = _hadoop(df.sparkSession, df._scratch_path)
    fs.delete(hpath, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Memory that an operator's word table may take in a Python worker; beyond it the table starts anew.
TABLE_BYTES = 48 << 20
#: What an entry takes besides its word: two objects' heads and the table's slot.
ENTRY_BYTES = 240


def table_bytes(words, each: int = ENTRY_BYTES) -> int:
    """Memory of table entries for these words."""
    return sum(map(len, words)) + each * len(words)


def _trim() -> None:
    """Give freed memory back to the system (glibc keeps it otherwise)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_cache_owner: tuple[object, Callable[[], None]] | None = None


def own_cache(name: object, forget: Callable[[], None]) -> None:
    """Make ``name`` the only operator whose word table a Python worker keeps.

    Workers are reused over operators; the previous owner's table is dropped,
    so a worker's memory is bounded by one table.
    """
    global _cache_owner
    if _cache_owner is not None and _cache_owner[0] != name:
        _cache_owner[1]()
        _trim()
    _cache_owner = (name, forget)


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
