"""Options that depart from the reference's rules, on hand-made rows."""

import datetime as dt

import pytest

from linecast.functions.names import with_name_parts
from linecast.operators import averages, history, reports
from linecast.schemas import LINE_KEY, PREDICTIONS


def _history(spark, xs_by_line, stat="points"):
    """Newest-first values per line of one player, one game a day."""
    box, lines, days = [], [], []
    n = max(map(len, xs_by_line.values()))
    for g in range(n):
        days.append((g, dt.datetime(2024, 1, 31) - dt.timedelta(days=g)))
    unified = []
    for line, xs in xs_by_line.items():
        for g, x in enumerate(xs):
            unified.append((1, "A B", stat, line, "T", g, days[g][1], g, 0, x))
    schema = "personid long, player_name string, stat string, line double, team string, gameid long, gamedate timestamp, row_a long, row_b long, x double"
    return spark.createDataFrame(unified, schema)


def _mean(xs, ranks, keep_null=True):
    w = [0.95 ** (r - 1) for r in ranks]
    return sum(x * v for x, v in zip(xs, w) if x is not None) / sum(v for x, v in zip(xs, w) if keep_null or x is not None)


def test_rank_scope(spark):
    u = _history(spark, {1.5: [10.0, 20.0, 30.0, 40.0], 2.5: [10.0, 20.0, 30.0, 40.0]})
    both = {r.line: r.base_avg for r in history.summarize_lines(u).collect()}
    alone = {r.line: r.base_avg for r in history.summarize_lines(u, rank_scope="line").collect()}
    xs = [10.0, 20.0, 30.0, 40.0]
    assert both[1.5] == pytest.approx(_mean(xs, [1, 3, 5, 7])) and both[2.5] == pytest.approx(_mean(xs, [2, 4, 6, 8]))
    assert alone[1.5] == alone[2.5] == pytest.approx(_mean(xs, [1, 2, 3, 4]))


def test_null_weight(spark):
    xs = [10.0, None, 30.0, 40.0]
    u = _history(spark, {1.5: xs})
    (keep,) = history.summarize_lines(u).collect()
    (drop,) = history.summarize_lines(u, null_weight="drop").collect()
    assert keep.base_avg == pytest.approx(_mean(xs, [1, 2, 3, 4])) and drop.base_avg == pytest.approx(_mean(xs, [1, 2, 3, 4], False))


def test_streak_side(spark):
    u = _history(spark, {1.5: [30.0, 30.0, 30.0, 10.0, 10.0, 10.0, 10.0]})
    (old,) = history.summarize_lines(u).collect()
    (new,) = history.summarize_lines(u, streak_side="latest").collect()
    assert (old.last3_avg, new.last3_avg) == (10.0, 30.0)
    with pytest.raises(ValueError):
        history.summarize_lines(u, streak_side="both")


def test_name_rule(spark):
    df = spark.createDataFrame([("Ann Lee Example",), ("Ann  Example",), ("Ann",), (None,)], "player_name string")
    parts = lambda **k: [tuple(r)[1:] for r in with_name_parts(df, **k).collect()]
    assert parts() == [("Ann", "Lee"), ("Ann", ""), ("Ann", None), (None, None)]
    assert parts(name_rule="first_rest") == [("Ann", "Lee Example"), ("Ann", "Example"), ("Ann", None), (None, None)]


def _stored(spark):
    day, at = dt.date(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [
        (1, "A B", "points", 1.5, day, "", 2.0, "over", 9.0, at), (1, "A B", "points", 2.5, day, None, None, "under", None, at),
        (2, None, "points", 1.5, dt.date(2024, 1, 3), "T", 1.0, "under", 20.0, at), (1, "A B", "points", 3.5, day, "T", 3.0, "under", 4.0, None),
    ]
    names = ["personid", "player_name", "stat_type", "line", "game_date", "team", "predicted_value", "bet_outcome", "deviation_percentage", "created_at"]
    full = [tuple(dict(zip(names, r)).get(f.name) for f in PREDICTIONS.fields) for r in rows]
    players = spark.createDataFrame([(1, "A", "B"), (2, None, "C")], "personid long, firstname string, lastname string")
    return spark.createDataFrame(full, PREDICTIONS), players


def test_report_order_nulls_and_missing_team(spark):
    rows = reports.report_locks(*_stored(spark)).collect()
    assert [(r.player_name, r.line) for r in rows] == [("C", 1.5), ("A B", 1.5), ("A B", 3.5), ("A B", 2.5)]
    assert [r.team for r in rows] == ["T", "N/A", "T", "N/A"]
    assert rows[-1].predicted_value is None and rows[-1].deviation_percentage == 0.0 and rows[2].created_at is None


def test_report_filters(spark):
    assert [r.line for r in reports.report_locks(*_stored(spark), min_deviation=5.0).collect()] == [1.5, 1.5]
    assert [r.line for r in reports.report_locks(*_stored(spark), game_date="2024-01-03").collect()] == [1.5]


def test_lines_without_a_stat_are_dropped_everywhere(spark):
    stats = spark.createDataFrame([(1, g, g, 0, 10.0 + g, 1.0, 1.0, 1.0, 1.0, 1.0) for g in range(4)], "personid long, gameid long, row_a long, row_b long, points double, assists double, reboundstotal double, steals double, blocks double, threepointersmade double")
    games = spark.createDataFrame([(g, dt.datetime(2024, 1, 1 + g)) for g in range(4)], "gameid long, gamedate timestamp")
    lines = spark.createDataFrame([("A B", s, 1.5, "T", 1) for s in ("points", None, "other")], "player_name string, stat string, line double, team string, personid long")
    kept = {"points", "other"}
    hist = averages.line_history(stats, lines)
    assert {r.stat for r in averages.stat_averages(hist).collect()} == kept
    assert sorted(map(tuple, averages.stat_averages_union(hist).collect())) == sorted(map(tuple, averages.stat_averages(hist).collect()))
    unified = history.unified_history(stats, lines, games)
    assert {r.stat for r in unified.select("stat").distinct().collect()} == kept
    assert {r.stat for r in history.with_recency(unified).select("stat").distinct().collect()} == kept
    assert {r.stat for r in history.summarize_lines(unified).select(*LINE_KEY).collect()} == kept
    # The batch job has no stat filter: it keeps the line.
    assert None in {r.stat_type for r in averages.batch_points_predictions(hist).collect()}
    assert averages.stat_averages_union(hist)._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 2
