"""Idempotent append: a second run writes nothing; survivors are stable."""

from linecast.schemas import PREDICTIONS
from linecast.sinks.append import append_new, dedup_by_key, new_rows, parquet_writer, read_parquet_target
from linecast.streaming.runner import conform


def _batch(spark, rows):
    return conform(spark.createDataFrame(
        rows, "personid long, stat_type string, line double, game_date date, predicted_value double"), "2024-01-02 00:00:00")


def test_append_twice_adds_nothing(spark, tmp_dir):
    import datetime as dt
    d = dt.date(2024, 1, 1)
    rows = [(1, "points", 24.5, d, 30.0), (1, "points", 24.5, d, 31.0), (2, "steals", 1.5, d, 1.0)]
    target = f"{tmp_dir}/predictions"
    empty = read_parquet_target(spark, target, PREDICTIONS)
    assert empty.count() == 0
    assert append_new(_batch(spark, rows), empty, parquet_writer(target)) == 2
    stored = read_parquet_target(spark, target, PREDICTIONS)
    assert stored.count() == 2
    assert append_new(_batch(spark, rows), stored, parquet_writer(target)) == 0
    assert read_parquet_target(spark, target, PREDICTIONS).count() == 2
    kept = read_parquet_target(spark, target, PREDICTIONS).filter("personid = 1").first()
    assert kept.predicted_value == 30.0         # deterministic survivor


def test_null_key_never_matches(spark):
    import datetime as dt
    d = dt.date(2024, 1, 1)
    batch = _batch(spark, [(None, "points", 1.0, d, 1.0), (3, "points", 1.0, d, 1.0)])
    existing = _batch(spark, [(None, "points", 1.0, d, 1.0), (3, "points", 1.0, d, 2.0)])
    got = new_rows(batch, existing).collect()
    assert len(got) == 1 and got[0].personid is None


def test_dedup_by_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, v string")
    assert sorted(tuple(r) for r in dedup_by_key(df, ["k"]).collect()) == [(1, "a"), (2, "c")]
