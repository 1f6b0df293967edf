"""The history's second stage works on months, whatever the number of dates."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from linecast.operators import history, history_state, segments
from tests.test_history_state import made


def test_second_stage_has_a_row_per_line_and_month(spark):
    unified = history.unified_history(*made(spark, 3))
    months = history.month_rows(unified, history.scope_columns("player_stat"))
    dates = unified.select(*history.LINE_KEY, "gamedate").distinct().count()
    by_month = unified.select(*history.LINE_KEY, F.date_format("gamedate", "yyyyMM")).distinct().count()
    assert months.count() == by_month < dates / 10


def test_ranks_run_on_over_months_and_missing_dates(spark):
    unified = history.unified_history(*made(spark, 4, days=100))
    order = [F.col(c).desc_nulls_last() for c in ("gamedate", "gameid", "row_a", "row_b")]
    plain = F.row_number().over(Window.partitionBy("personid", "stat").orderBy(*order, "line", "team", "player_name"))
    key = [*history.LINE_KEY, "gameid"]
    want = {tuple(r) for r in unified.select(*key, "gamedate", plain.alias("rk")).collect()}
    got = history.with_recency(unified)
    assert {tuple(r) for r in got.select(*key, "gamedate", "rk").collect()} == want
    assert got.where("gamedate is null").count() > 0


def test_arrays_are_sorted_without_a_comparator_function(spark):
    unified = history.unified_history(*made(spark, 5, days=20))
    for df in (segments.history_segments(unified), history_state.fold(unified)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "sort_array(" in plan and "array_sort(" not in plan


def test_tasks_are_not_joined_beyond_a_bounded_size(spark):
    from linecast.session import ADVISORY_SIZE, TASK_BYTES, configure

    was = spark.conf.get(ADVISORY_SIZE)
    try:
        for given, want in (("64MB", str(TASK_BYTES)), ("1MB", "1MB")):
            spark.conf.set(ADVISORY_SIZE, given)
            configure(spark)
            assert spark.conf.get(ADVISORY_SIZE) == want
    finally:
        spark.conf.set(ADVISORY_SIZE, was)


def test_shuffles_are_dealt_in_proportion_to_the_table(spark, monkeypatch):
    """Before, their number was the caller's however large the table."""
    from linecast import session
    from linecast.plans import queries
    from tests.conftest import SF_SMALL

    rows = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    for name in ("streak_state", "recency_rank", "decay_summary", "decay_from_state"):
        monkeypatch.setattr(session, "ROWS_PER_PARTITION", rows // 40)
        try:
            queries.QUERIES[name](spark, SF_SMALL)
            dealt = int(spark.conf.get(session.INITIAL_PARTITIONS))
            assert 40 <= dealt <= 41
            monkeypatch.setattr(session, "ROWS_PER_PARTITION", rows)
            queries.QUERIES[name](spark, SF_SMALL)
            assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == dealt
        finally:
            spark.conf.unset(session.INITIAL_PARTITIONS)
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", rows)
    queries.QUERIES["recency_rank"](spark, SF_SMALL)
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_tasks_read_a_bounded_part_of_a_file(spark):
    from linecast.session import READ_BYTES, READ_SIZE, configure

    was = spark.conf.get(READ_SIZE)
    try:
        for given, want in (("128MB", str(READ_BYTES)), ("1MB", "1MB")):
            spark.conf.set(READ_SIZE, given)
            configure(spark)
            assert spark.conf.get(READ_SIZE) == want
    finally:
        spark.conf.set(READ_SIZE, was)
