"""Heavy-hitter split join: equal to the plain join, hot keys spread."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from linecast.operators import averages, skew
from linecast.plans import queries
from linecast.sources import fixtures as fx
from tests.conftest import SF_SMALL

IDS = ["gameid", "row_a", "row_b"]


@pytest.fixture()
def plain_joins(spark):
    """No broadcast and no AQE: the plan alone must spread the rows."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _hot(spark):
    """The box scores with a third of all rows dealt to one player."""
    stats = fx.stats(spark, SF_SMALL)
    return stats.withColumn("personid", F.when(F.pmod(F.xxhash64(*IDS), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("personid")))


def _rows_per_task(joined):
    return [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.countDistinct(*IDS).alias("n")).collect()]


def test_a_third_in_one_key_is_spread_and_the_result_is_equal(spark, plain_joins):
    stats, lines = _hot(spark), queries._props_with_id(spark, SF_SMALL)
    heavy = skew.heavy_keys(stats, "personid", 256)
    assert heavy[7] > 80 and sum(heavy.values()) <= 512
    split = skew.split_join(stats, lines, "personid", IDS)
    plain = stats.join(lines, on="personid")
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    assert max(_rows_per_task(plain)) > 2 * median(_rows_per_task(plain))
    assert max(_rows_per_task(split)) <= 2 * median(_rows_per_task(split))
    a, b = (sorted(map(tuple, averages.stat_averages(x).withColumn("predicted_value", F.round("predicted_value", 9)).collect())) for x in (split, plain))
    assert a == b


def test_null_keys_ties_repeats_and_empty_sides(spark):
    large = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 5)] * 40 + [(2, i) for i in range(3)], "k long, v long")
    small = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (3, "d")], "k long, w string")
    got = skew.split_join(large, small, "k", ["v"], spread=8)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, large.join(small, "k").collect())) and got.count() == 120
    assert skew.split_join(large.limit(0), small, "k", ["v"]).isEmpty()
    assert skew.split_join(large, small.limit(0), "k", ["v"], spread=8).isEmpty()
    with pytest.raises(ValueError):
        skew.split_join(large.withColumn("_salt", F.lit(1)), small, "k", ["v"])
