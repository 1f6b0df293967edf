"""Hand-made cases for the behaviours of SURVEY §4.1 (B-numbers) and the
history rules, checked against brute-force Python."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecast.functions.names import with_name_parts
from linecast.functions.recommend import (confidence_score, deviation_percentage, risk_assessment,
                                          three_way_outcome, binary_outcome)
from linecast.functions.stats import stat_value
from linecast.operators import averages, history, resolve

UNIFIED = T.StructType([
    T.StructField("personid", T.LongType()), T.StructField("player_name", T.StringType()),
    T.StructField("stat", T.StringType()), T.StructField("line", T.DoubleType()),
    T.StructField("team", T.StringType()), T.StructField("gameid", T.LongType()),
    T.StructField("gamedate", T.TimestampNTZType()), T.StructField("row_a", T.LongType()),
    T.StructField("row_b", T.LongType()), T.StructField("x", T.DoubleType()),
])


def test_name_split_b2(spark):
    rows = [("Aron Jaspers",), ("Kurt Amory Tobin",), ("Kelvin  Dorn",), ("Nilo",), (None,)]
    df = with_name_parts(spark.createDataFrame(rows, "player_name string"))
    got = {r.player_name: (r.firstname, r.lastname) for r in df.collect()}
    assert got["Aron Jaspers"] == ("Aron", "Jaspers")
    assert got["Kurt Amory Tobin"] == ("Kurt", "Amory")
    assert got["Kelvin  Dorn"] == ("Kelvin", "")
    assert got["Nilo"] == ("Nilo", None)
    assert got[None] == (None, None)


def test_resolve_fan_out_and_drop(spark):
    props = spark.createDataFrame(
        [("A B", "points", 1.5, "2024-01-01", "T"), ("Solo", "points", 1.5, "2024-01-01", "T")],
        "player_name string, stat string, line double, game_date string, team string")
    players = spark.createDataFrame([(1, "A", "B"), (2, "A", "B"), (2, "A", "B")],
                                    "personid long, firstname string, lastname string")
    got = sorted(r.personid for r in resolve.resolve_players(props, players).collect())
    assert got == [1, 2]          # namesakes fan out, one-word name drops, duplicate id once


def test_stat_lookup(spark):
    cols = "stat string, points double, assists double, reboundstotal double, steals double, blocks double, threepointersmade double"
    rows = [(s, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0) for s in
            ["points", "assists", "rebounds", "steals", "blocks", "threes", "3pm", "turnovers", "reboundstotal"]]
    got = {r.stat: r.x for r in spark.createDataFrame(rows, cols).select("stat", stat_value("stat").alias("x")).collect()}
    assert got == {"points": 1.0, "assists": 2.0, "rebounds": 3.0, "steals": 4.0, "blocks": 5.0,
                   "threes": 6.0, "3pm": 6.0, "turnovers": 1.0, "reboundstotal": 1.0}


def test_outcome_and_deviation_edges(spark):
    rows = [(10.0, 10.0), (10.5, 10.0), (9.5, 10.0), (1.0, 0.0), (None, 10.0), (10.5, 10.0 / 1.05)]
    df = spark.createDataFrame(rows, "pv double, line double").select(
        "pv", "line", binary_outcome("pv", "line").alias("o"), deviation_percentage("pv", "line").alias("d"))
    got = [(r.o, r.d) for r in df.collect()]
    assert got[0] == ("under", 0.0)                     # equal -> under
    assert got[1][0] == "over" and abs(got[1][1] - 5.0) < 1e-12
    assert got[2][0] == "under" and abs(got[2][1] - 5.0) < 1e-12
    assert got[3] == ("over", None)                     # line 0 -> null, never a lock
    assert got[4] == ("under", None)                    # null prediction


def test_lock_threshold_inclusive(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 4.999999), (3, None)], "k int, deviation_percentage double")
    assert [r.k for r in averages.locks(df).collect()] == [1]


@pytest.mark.parametrize("p,outcome,conf", [
    (0.6, "neutral", "medium"), (0.6000001, "over", "medium"), (0.4, "neutral", "medium"),
    (0.3999999, "under", "medium"), (0.7, "over", "high"), (0.3, "under", "high"),
    (0.55, "neutral", "medium"), (0.45, "neutral", "medium"), (0.5, "neutral", "low"),
])
def test_probability_labels(spark, p, outcome, conf):
    r = spark.createDataFrame([(p,)], "p double").select(
        three_way_outcome("p").alias("o"), confidence_score("p").alias("c")).first()
    assert (r.o, r.c) == (outcome, conf)


def test_risk_labels(spark):
    df = spark.createDataFrame([(8.0, 12.0, 10.0), (9.0, 12.5, 10.0), (9.0, 11.0, 10.0), (1.0, 1.0, 0.0)],
                               "lo double, hi double, pv double")
    got = [r.r for r in df.select(risk_assessment("lo", "hi", "pv").alias("r")).collect()]
    assert got == ["medium_risk", "medium_risk", "low_risk", "low_risk"]


# --- history rules against brute force -------------------------------------------

def _brute_summary(rows):
    """Pure-Python rebuild of the per-line summary of SURVEY §2.14 steps 1, 2, 5, 8."""
    by_key = {}
    for r in rows:
        by_key.setdefault((r[0], r[2]), []).append(r)
    rank = {}
    for key, rs in by_key.items():
        rs = sorted(rs, key=lambda r: (-r[6].timestamp(), -r[5], -r[7], -r[8], r[3], r[4], r[1]))
        for i, r in enumerate(rs):
            rank[id(r)] = i + 1
    lines = {}
    for r in rows:
        lines.setdefault((r[0], r[1], r[2], r[3], r[4]), []).append(r)
    out = {}
    for key, rs in lines.items():
        rs = sorted(rs, key=lambda r: (-r[6].timestamp(), -r[5], -r[7], -r[8]))
        num = sum(r[9] * 0.95 ** (rank[id(r)] - 1) for r in rs if r[9] is not None)
        den = sum(0.95 ** (rank[id(r)] - 1) for r in rs)
        vals = [r[9] for r in rs if r[9] is not None]
        n = len(vals)
        if n < 3:
            continue
        base = num / den
        mean = sum(vals) / n
        sd = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1))
        w = [(0.7 * 1.5 if i < 10 else 0.7 if i < 82 else 0.3) for i in range(n)]
        recent = sum(v * wi for v, wi in zip(vals, w)) / sum(w)
        out[key] = dict(base_avg=base, std_dev=sd, min_val=min(vals), max_val=max(vals), game_count=n,
                        recent_avg=recent, last3_avg=sum(vals[-3:]) / 3)
    return out


def _history_rows(seed=7):
    rnd = random.Random(seed)
    rows = []
    day0 = dt.datetime(2020, 1, 1)
    specs = [  # (personid, stat, lines, games, null share)
        (1, "points", [24.5, 25.5, 23.5], 140, 0.0),   # three interleaved lines, elite-length history
        (2, "steals", [1.5], 83, 0.1),                  # season-tier edge, some null values
        (3, "assists", [5.5], 11, 0.0),                 # recency-boost edge
        (4, "blocks", [0.5], 4, 0.0),                   # short history
        (5, "threes", [1.5], 2, 0.0),                   # dropped (< 3 values)
        (6, "points", [10.5], 300, 0.0),                # a "hot" player with many rows per date
    ]
    for pid, stat, lines, games, nulls in specs:
        for g in range(games):
            date = day0 + dt.timedelta(days=g // (3 if pid == 6 else 1))
            for sub in range(2 if pid == 6 else 1):
                x = None if rnd.random() < nulls else float(rnd.randint(0, 40))
                for line in lines:
                    rows.append((pid, f"P {pid}", stat, line, "T", 1000 + g, date, 50 + sub, sub, x))
    return rows


@pytest.mark.parametrize("one_pass", [True, False])
def test_history_summary_matches_brute_force(spark, one_pass):
    rows = _history_rows()
    df = spark.createDataFrame(rows, UNIFIED).repartition(5)
    summary = history.summarize_lines(df) if one_pass else history.line_summary(history.with_recency(df))
    got = {(r.personid, r.player_name, r.stat, r.line, r.team): r.asDict() for r in summary.collect()}
    want = _brute_summary(rows)
    assert set(got) == set(want)
    for k, w in want.items():
        for col, v in w.items():
            assert got[k][col] == pytest.approx(v, rel=1e-9, abs=1e-12), (k, col)


def test_trend_guard_and_elite_and_streak(spark):
    schema = "personid long, player_name string, stat string, line double, team string, base_avg double, " \
             "std_dev double, min_val double, max_val double, game_count long, recent_avg double, last3_avg double"
    rows = [(1, "a", "blocks", 0.5, "T", 0.0, 0.0, 0.0, 0.0, 10, 0.0, 0.0),
            (2, "b", "points", 20.5, "T", 21.0, 5.0, 0.0, 40.0, 101, 22.0, 30.0),
            (3, "c", "points", 20.5, "T", 21.0, 5.0, 0.0, 40.0, 100, 22.0, 10.0),
            (4, "d", "turnovers", 2.5, "T", 30.0, 5.0, 0.0, 40.0, 200, 30.0, 30.0)]
    got = {r.personid: r for r in history.with_model_inputs(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].trend == 1.0 and got[1].streak == "none"       # base 0: trend 1, no division
    assert got[2].is_elite and got[2].streak == "hot"
    assert not got[3].is_elite and got[3].streak == "cold"       # exactly 100 games is not elite
    assert not got[4].is_elite                                    # unknown stat is never elite


def test_ranks_equal_plain_window(spark):
    """The day-bucketed ranks equal one window over (personid, stat)."""
    from pyspark.sql import Window

    df = spark.createDataFrame(_history_rows(3), UNIFIED)
    w = Window.partitionBy("personid", "stat").orderBy(
        F.col("gamedate").desc(), F.col("gameid").desc(), F.col("row_a").desc(), F.col("row_b").desc(),
        "line", "team", "player_name")
    plain = df.withColumn("rk0", F.row_number().over(w))
    ours = history.with_recency(df)
    keys = ["personid", "stat", "line", "gameid", "row_a", "row_b"]
    j = plain.join(ours.select(*keys, "rk"), keys)
    assert j.count() == df.count()
    assert j.filter(F.col("rk") != F.col("rk0")).count() == 0


def test_summary_shuffles_history_rows_once(spark):
    """Plan shape: one exchange of the history rows (by player, stat, date)
    and one of the per-date rows (by player, stat); no other exchange."""
    import re

    df = spark.createDataFrame(_history_rows(5), UNIFIED).repartition(4)
    plan = history.summarize_lines(df)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    keys = [tuple(k.split("#")[0].strip() for k in args.split(",") if "#" in k) for kind, args in exchanges
            if kind == "hashpartitioning"]
    assert ("personid", "stat", "_gd") in keys
    assert ("personid", "stat") in keys
    assert not any(k == ("personid",) for k in keys)     # never by player alone
