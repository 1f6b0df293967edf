"""AGG7 in segments, and mergeable history states against the one-pass summary."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from linecast.operators import history, history_state as S, segments
from linecast.plans import queries as Q
from linecast.schemas import LINE_KEY
from linecast.sources import fixtures as fx
from tests.conftest import SF_SMALL

COLUMNS = ["base_avg", "std_dev", "min_val", "max_val", "game_count", "recent_avg", "last3_avg"]


def made(spark, seed=0, days=300, per_day=2):
    """Two players, interleaved lines, null values, null dates, several games a day."""
    r = random.Random(seed)
    rows, games, g = [], [], 0
    for d in range(days):
        for _ in range(r.randrange(per_day + 1)):
            g += 1
            games.append((g, dt.date(2020, 1, 1) + dt.timedelta(days=d)))
            for person in (1, 2):
                if r.random() < 0.8:
                    rows.append((person, g, g, 0, r.choice([None, *map(float, range(40))]), *[1.0] * 5))
    games += [(g + 1, None), (g + 2, None)]
    rows += [(1, g + 1, g + 1, 0, 7.0, *[1.0] * 5), (2, g + 2, g + 2, 0, 9.0, *[1.0] * 5)]
    stats = spark.createDataFrame(rows, "personid long, gameid long, row_a long, row_b long, points double, assists double, reboundstotal double, steals double, blocks double, threepointersmade double")
    lines = spark.createDataFrame([(1, "A B", "points", 20.5, "t"), (1, "A B", "points", 22.5, None), (2, "C D", "points", 9.5, "t"), (2, "C D", "assists", 9.5, "t"), (3, "E F", "points", 1.5, "t")],
                                  "personid long, player_name string, stat string, line double, team string")
    return stats, lines, spark.createDataFrame(games, "gameid long, gamedate date")


def rows_of(df, columns=COLUMNS):
    key = lambda r: tuple(str(r[c]) for c in LINE_KEY)
    return {key(r): [r[c] for c in columns] for r in df.select(*LINE_KEY, *columns).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9, nan_ok=True), k


def test_segments_are_bounded_and_hold_the_array_in_order(spark):
    stats, lines, games = made(spark, 1)
    unified = history.unified_history(stats, lines, games)
    got = segments.history_segments(unified)
    assert got.where(F.size("values") > segments.SEGMENT).isEmpty() and got.agg(F.max("segment")).first()[0] >= 2
    arrays, firsts = {}, {}
    for r in sorted(got.collect(), key=lambda r: r["segment"]):
        k = tuple(str(r[c]) for c in LINE_KEY)
        assert r["first_pos"] == len(arrays.setdefault(k, [])) == 82 * r["segment"]
        arrays[k] += r["values"]
        firsts[k] = r["n_vals"]
    whole = {}
    for r in unified.where("x is not null").collect():
        whole.setdefault(tuple(str(r[c]) for c in LINE_KEY), []).append((r["gamedate"] or dt.date.min, r["gameid"], r["row_a"], r["x"]))
    assert {k: [x[-1] for x in sorted(v, reverse=True)] for k, v in whole.items()} == arrays
    assert firsts == {k: len(v) for k, v in arrays.items()}


@pytest.mark.parametrize("size", [1, 7, 82])
def test_rules_read_from_segments(spark, size):
    stats, lines, games = made(spark, 2, days=120)
    unified = history.unified_history(stats, lines, games)
    columns = ["game_count", "recent_avg", "last3_avg"]
    same(rows_of(segments.rules_from_segments(segments.history_segments(unified, size)), columns), rows_of(history.summarize_lines(unified), columns))


def test_no_array_per_line_in_the_plan(spark):
    """Rows meet per (line, segment): the collecting aggregate is keyed by both."""
    plan = segments.history_segments(Q._unified(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    collecting = [x for x in plan.splitlines() if "collect_list(struct(pos" in x]
    assert collecting and all("_groupingexpression" in x.split("]")[0] or "segment" in x.split("]")[0] for x in collecting)


@pytest.mark.parametrize("cuts", [["2020-05-01"], ["2019-01-01"], ["2030-01-01"], ["2020-03-01", "2020-03-02", "2020-08-15"]])
def test_merged_ranges_equal_the_whole(spark, cuts):
    stats, lines, games = made(spark, 3)
    part = lambda **days: S.fold(history.unified_history(stats, lines, S.in_range(games, **days)))
    state = part(until=cuts[0])
    for a, b in zip(cuts, cuts[1:] + [None]):
        state = S.merge(state, part(since=a, until=b))
    want = rows_of(history.summarize_lines(history.unified_history(stats, lines, games)))
    same(rows_of(S.summary(state)), want)
    assert len(want) == 4


def test_merge_is_associative(spark):
    stats, lines, games = made(spark, 4)
    part = lambda **days: S.fold(history.unified_history(stats, lines, S.in_range(games, **days)))
    a, b, c = part(until="2020-04-01"), part(since="2020-04-01", until="2020-06-01"), part(since="2020-06-01")
    columns = [c for c in S.PARTS if c not in ("head", "tail")]
    left, right = S.merge(S.merge(a, b), c), S.merge(a, S.merge(b, c))
    same(rows_of(left, columns), rows_of(right, columns))
    assert rows_of(left, ["head", "tail"]) == rows_of(right, ["head", "tail"])
    assert left.where((F.size("head") > 82) | (F.size("tail") > 3)).isEmpty()


def test_advance_reads_new_games_and_rebuilds_changed_lines(spark, tmp_dir):
    stats, lines, games = made(spark, 5)
    path = f"{tmp_dir}/state"
    assert S.stored(spark, path) is None
    S.advance(spark, stats, lines, games, path, "2020-04-01")
    S.advance(spark, stats, lines, games, path, "2020-06-01")
    # A third line for player 1 changes the ranks of the other two; player 2's assists line is gone.
    changed = lines.where("stat != 'assists'").unionByName(spark.createDataFrame([(1, "A B", "points", 30.5, "t")], lines.schema))
    state = S.advance(spark, stats, changed, games, path, "2020-09-01")
    assert S.stored(spark, path)[1] == "2020-09-01"
    want = rows_of(history.summarize_lines(history.unified_history(stats, changed, S.in_range(games, until="2020-09-01"))))
    same(rows_of(S.summary(state)), want)
    same(rows_of(S.summary(S.advance(spark, stats, changed, games, path, "2020-09-01"))), want)
    with pytest.raises(ValueError):
        S.advance(spark, stats, changed, games, path, "2020-08-01")


def test_only_the_delta_days_are_scanned(spark):
    """The dates reach the games' scan, and with history stored by date only its days are read."""
    games = S.in_range(fx.games(spark, SF_SMALL), since=Q.STATE_UNTIL)
    plan = history.unified_history(fx.stats(spark, SF_SMALL), Q._props_with_id(spark, SF_SMALL), games)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_nothing_new_and_empty_tables(spark):
    stats, lines, games = made(spark, 6, days=40)
    state = S.fold(history.unified_history(stats, lines, games))
    none = S.fold(history.unified_history(stats.limit(0), lines, games))
    assert none.count() == 0
    want = rows_of(S.summary(state))
    same(rows_of(S.summary(S.merge(state, none))), want)
    same(rows_of(S.summary(S.merge(none, state))), want)


def test_only_the_lines_value_reaches_the_games_join(spark):
    """JN4: below the join on ``gameid`` the six measures are one column."""
    from linecast.operators import history
    from linecast.plans import queries
    from linecast.sources import fixtures as fx

    h = history.unified_history(fx.stats(spark, SF_SMALL), queries._props_with_id(spark, SF_SMALL), fx.games(spark, SF_SMALL))
    plan = h._jdf.queryExecution().optimizedPlan()
    join = plan
    while "Join" not in join.nodeName():
        join = join.children().head()
    below = {join.left().output().apply(i).name() for i in range(join.left().output().size())}
    assert "x" in below and not below & {"points", "assists", "reboundstotal", "steals", "blocks", "threepointersmade"}
