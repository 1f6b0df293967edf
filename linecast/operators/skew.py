"""JN2/JN3 with heavy hitters: a join that deals the rows of hot keys by salt.

A key that holds more than one ``spread``-th of the large side's rows is heavy.
Its rows get a salt from a hash of their own columns (a retried task deals the
same rows the same way), and the small side's rows of that key are repeated once
per salt. All other rows have salt 0 and are not repeated. The join key is (key,
salt), so a hot key's rows spread over the join's tasks in proportion to their
number, whether or not AQE or a broadcast steps in.

The heavy keys come from a sketch aggregate (``approx_top_k``) with one bounded
state per task. Its counts are estimates; they only set how many salts a key
gets, never which rows join: the result is that of the plain join.

Bounds: at most ``spread`` heavy keys reach the driver; the salts of all heavy
keys together are at most about twice ``spread``, so the small side grows by at most
that many times the lines of one key. A null key joins with nothing and is
dropped before it is dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of the rows that the salts are cut into, per shuffle partition.
SHARES = 32
#: Heavy keys asked of the sketch, and the items that it keeps per share.
MAX_HEAVY = 1024
_SALT = "_salt"


def heavy_keys(rows: DataFrame, key: str, spread: int, top: int = MAX_HEAVY) -> dict:
    """{key: salts} of the keys that hold more than one ``spread``-th of the
    rows. One scan of the key column."""
    tracked = max(10_000, 4 * top)
    row = rows.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {top}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    share = max(1, row["n"] // spread)
    return {item["item"]: -(-item["count"] // share) for item in row["top"] or [] if item["count"] > share}


def salts(key: str, heavy: dict) -> Column:
    """How many salts a row's key has: 1 unless the key is heavy."""
    if not heavy:
        return F.lit(1)
    pairs = [F.lit(x) for item in heavy.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(key)).cast("int"), F.lit(1))


def split_join(large: DataFrame, small: DataFrame, key: str, spread_by: list[str], spread: int | None = None) -> DataFrame:
    """Inner join on ``key``: the same rows and columns as ``large.join(small,
    key)``. ``spread_by``: columns that tell the large side's rows apart."""
    if _SALT in large.columns or _SALT in small.columns:
        raise ValueError(f"{_SALT} is a reserved column name")
    spark = large.sparkSession
    spread = spread or SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(large, key, spread)
    if not heavy:
        return large.join(small, on=key, how="inner")
    n = salts(key, heavy)
    dealt = large.where(F.col(key).isNotNull()).withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), n).cast("int"))
    repeated = small.where(F.col(key).isNotNull()).withColumn(_SALT, F.explode(F.sequence(F.lit(0), n - 1)))
    return dealt.join(repeated, on=[key, _SALT], how="inner").drop(_SALT)
