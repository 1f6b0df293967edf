"""Offered lines as NDJSON: file scan and in-memory parse with one schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecast.schemas import PROPS
from linecast.session import ensure_checkpoint_dir


def read_props(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """SRC1: one JSON object per line. The explicit schema keeps ``line``
    double even in a file of whole numbers; PERMISSIVE mode turns a broken
    line into nulls instead of failing the job."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if not infer_schema:
        reader = reader.schema(PROPS)
    return reader.json(path)


def split_props(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC1 with quarantine: (lines, broken) of NDJSON files, read once.

    ``lines`` has the props schema and holds only lines that parse (an all-null
    object is one); ``broken`` has ``file`` and ``text`` of every other
    non-blank line. The parsed rows are checkpointed in the shared folder, with
    a broken line's text only, and both results read that copy."""
    ensure_checkpoint_dir(spark)
    marked = T.StructType([*PROPS.fields, T.StructField("_broken", T.StringType())])
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")).where(F.trim("text") != "")
    parsed = text.withColumn("p", F.from_json("text", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    broken = F.col("p").isNull() | F.col("p._broken").isNotNull()
    kept = parsed.select("p", broken.alias("bad"), F.when(broken, F.col("file")).alias("file"), F.when(broken, F.col("text")).alias("text")).checkpoint()
    return kept.where(~F.col("bad")).select(*[F.col(f"p.{f.name}").alias(f.name) for f in PROPS.fields]), kept.where("bad").select("file", "text")


def broken_lines(spark: SparkSession, path: str) -> int:
    """How many non-blank lines of the files do not parse (a PERMISSIVE scan
    returns them as all-null rows)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    marked = T.StructType([*PROPS.fields, T.StructField("_broken", T.StringType())])
    parsed = lines.select(F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("p"))
    return parsed.where(F.col("p._broken").isNotNull()).count()


def props_as_ndjson(props: DataFrame) -> DataFrame:
    """Serialise lines to NDJSON text (column ``value``)."""
    return props.select(F.to_json(F.struct(*[F.col(f.name) for f in PROPS.fields])).alias("value"))


def parse_props(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse NDJSON text lines with the props schema (same parser and
    PERMISSIVE semantics as the file scan)."""
    return lines.select(F.from_json(F.col(value_col), PROPS).alias("_p")).select("_p.*")
