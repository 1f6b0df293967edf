"""Output formatting helpers (text timestamps, engine-stable rounding)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT = "HH:mm:ss"
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def round6(c: Column | str) -> Column:
    """``floor(x * 1e6 + 0.5) / 1e6``: rounding that gives identical bits in
    Spark and DuckDB (plain ``round`` differs on exact binary ties)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column of a result with :func:`round6`."""
    return df.select(
        *[
            round6(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def ts_text(c: Column | str, fmt: str = TS_FORMAT) -> Column:
    """EXP15: timestamp as text; null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, fmt)
