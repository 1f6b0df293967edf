"""Mergeable state of the lines' history (AGG3, AGG8, AGG9 over time).

A run needs the whole history of every line, although only the newest games
changed since the last one. A line's summary is kept as a state of bounded size
that two disjoint ranges of game dates can be merged from:

* decay sums: the older ones times 0.95 ** (rows of the player and stat in the
  newer range), since every newer row pushes an older one down by one rank;
* count, mean and squared deviations by the parallel-variance formula;
* the newest 82 values, the oldest three, the sum of all.

``fold`` makes states from history rows, ``merge`` joins an older and a newer
one, ``summary`` reads the per-line summary of
:func:`linecast.operators.history.summarize_lines` from a state. ``advance``
keeps states in a folder, by the day they reach to: it reads the latest one and
only the games since. A player and stat whose offered lines changed is rebuilt
from its own history, as ranks interleave the lines (B3).

Rows without a game date count as the oldest (as in the ranks), so they belong
to the first range. A game that arrives late, dated before a stored state, is
not seen by ``advance``; ``rebuild`` starts anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linecast.operators.history import (
    DECAY, MIN_GAMES, OLDER_WEIGHT, RECENCY_BOOST, RECENT_GAMES, SEASON_GAMES, SEASON_WEIGHT,
    month_rows, placed_months, scope_columns, unified_history,
)
from linecast.schemas import LINE_KEY

SCOPE = scope_columns("player_stat")
PARTS = ["scope_rows", "decay_sum", "decay_weight", "n", "mean", "m2", "total", "min_val", "max_val", "head", "tail"]


def in_range(games: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Games from ``since`` (inclusive) to ``until`` (exclusive); those without
    a date belong to the range that has no beginning."""
    day, kind = F.col("gamedate"), games.schema["gamedate"].dataType
    if since is not None:
        games = games.where(day >= F.lit(since).cast(kind))
    if until is not None:
        before = day < F.lit(until).cast(kind)
        games = games.where(before if since is not None else before | day.isNull())
    return games


def fold(unified: DataFrame) -> DataFrame:
    """One state per line of the history rows given."""
    months = placed_months(month_rows(unified, SCOPE), SCOPE).withColumn(
        "_scope_rows", F.sum("_rows").over(Window.partitionBy(*SCOPE)))
    at = lambda e: F.col("_pos_base") + e["p"] - 1
    place = lambda e: F.struct(at(e).alias("pos"), e["x"].alias("x"))
    # Null (and not looked at) in months that hold none of these values.
    head = F.when(F.col("_pos_base") < SEASON_GAMES, F.transform(F.filter("_head", lambda e: at(e) < SEASON_GAMES), place))
    tail = F.when(F.col("_pos_base") + F.col("_vals") > F.col("_n") - 3, F.transform(F.filter("_tail", lambda e: at(e) >= F.col("_n") - 3), place))
    some = lambda items: F.collect_list(F.when(F.size(items) > 0, items))
    values = lambda lists: F.transform(F.sort_array(F.flatten(lists)), lambda e: e["x"])
    scale = F.pow(F.lit(DECAY), F.col("_rk_base"))
    spread = F.sum("_m2_d") + F.sum(F.col("_vals") * (F.col("_mean_d") - F.col("_mean")) * (F.col("_mean_d") - F.col("_mean")))
    return months.groupBy(*LINE_KEY).agg(
        F.max("_scope_rows").alias("scope_rows"),
        F.coalesce(F.sum(scale * F.col("_a")), F.lit(0.0)).alias("decay_sum"),
        F.sum(scale * F.col("_b")).alias("decay_weight"),
        F.max("_n").alias("n"),
        F.coalesce(F.max("_mean"), F.lit(0.0)).alias("mean"),
        F.coalesce(spread, F.lit(0.0)).alias("m2"),
        F.coalesce(F.sum("_sum_d"), F.lit(0.0)).alias("total"),
        F.min("_min_d").alias("min_val"), F.max("_max_d").alias("max_val"),
        # bounded: 82 and 3 values per line, whatever its history
        values(some(head)).alias("head"), values(some(tail)).alias("tail"),
    )


def merge(older: DataFrame, newer: DataFrame) -> DataFrame:
    """The states of two ranges of dates, the second after the first, as one."""
    part = F.struct(*PARTS)
    both = older.select(*LINE_KEY, part.alias("o"), F.lit(None).cast(newer.select(part).schema[0].dataType).alias("s")).unionByName(
        newer.select(*LINE_KEY, F.lit(None).cast(older.select(part).schema[0].dataType).alias("o"), part.alias("s")))
    lines = both.groupBy(*LINE_KEY).agg(F.first("o", ignorenulls=True).alias("o"), F.first("s", ignorenulls=True).alias("s"))
    # A line without newer rows still ages by those of the player and stat's other lines.
    scope = Window.partitionBy(*SCOPE)
    lines = lines.withColumn("_newer", F.coalesce(F.max("s.scope_rows").over(scope), F.lit(0))).withColumn(
        "_older", F.coalesce(F.max("o.scope_rows").over(scope), F.lit(0)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    empty = lambda c: F.coalesce(F.col(c), F.array().cast("array<double>"))
    aged = lambda c: zero(f"s.{c}") + F.pow(F.lit(DECAY), F.col("_newer")) * zero(f"o.{c}")
    n = zero("o.n") + zero("s.n")
    gap = zero("s.mean") - zero("o.mean")
    share = F.coalesce(F.try_divide(zero("s.n").cast("double"), n.cast("double")), F.lit(0.0))
    ends = F.concat(empty("s.tail"), empty("o.tail"))
    return lines.select(
        *LINE_KEY, (F.col("_newer") + F.col("_older")).alias("scope_rows"),
        aged("decay_sum").alias("decay_sum"), aged("decay_weight").alias("decay_weight"),
        n.alias("n"), (zero("o.mean") + gap * share).alias("mean"),
        (zero("o.m2") + zero("s.m2") + gap * gap * zero("o.n") * share).alias("m2"),
        (zero("o.total") + zero("s.total")).alias("total"),
        F.least("o.min_val", "s.min_val").alias("min_val"), F.greatest("o.max_val", "s.max_val").alias("max_val"),
        F.slice(F.concat(empty("s.head"), empty("o.head")), 1, SEASON_GAMES).alias("head"),
        F.slice(ends, F.greatest(F.size(ends) - 2, F.lit(1)), F.lit(3)).alias("tail"),
    )


def _tier(place: Column) -> Column:
    return (F.when(place < RECENT_GAMES, F.lit(SEASON_WEIGHT * RECENCY_BOOST))
            .when(place < SEASON_GAMES, F.lit(SEASON_WEIGHT)).otherwise(F.lit(OLDER_WEIGHT)))


def summary(state: DataFrame) -> DataFrame:
    """The columns of :func:`linecast.operators.history.summarize_lines`."""
    weighted = F.transform("head", lambda x, i: F.struct((x * _tier(i)).alias("v"), _tier(i).alias("w")))
    add = lambda c: F.aggregate(weighted, F.lit(0.0), lambda acc, e: acc + e[c])
    plain = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    rest = (F.col("total") - plain("head")) * F.lit(OLDER_WEIGHT)
    rest_weight = (F.col("n") - F.size("head")).cast("double") * F.lit(OLDER_WEIGHT)
    return state.where(F.col("n") >= MIN_GAMES).select(
        *LINE_KEY, (F.col("decay_sum") / F.col("decay_weight")).alias("base_avg"),
        F.sqrt(F.try_divide(F.col("m2"), (F.col("n") - 1).cast("double"))).alias("std_dev"),
        "min_val", "max_val", F.col("n").alias("game_count"),
        ((add("v") + rest) / (add("w") + rest_weight)).alias("recent_avg"),
        (plain("tail") / F.lit(3.0)).alias("last3_avg"),
    )


# --- states kept in a folder -----------------------------------------------------


def stored(spark: SparkSession, path: str) -> tuple[DataFrame, str] | None:
    """The latest state in the folder and the day it reaches to (exclusive)."""
    try:
        rows = spark.read.option("recursiveFileLookup", "false").parquet(path)
    except Exception as exc:  # only "path does not exist" means empty
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return None
        raise
    until = rows.agg(F.max("until").cast("string")).first()[0]
    if until is None:
        return None
    return rows.where(F.col("until") == F.lit(until).cast(rows.schema["until"].dataType)).drop("until"), until


def store(state: DataFrame, path: str, until: str) -> None:
    """Write a state once; one that reaches to the same day must not exist."""
    state.write.mode("error").parquet(f"{path.rstrip('/')}/until={until}")


def rebuild(stats: DataFrame, props_with_id: DataFrame, games: DataFrame, path: str, until: str) -> None:
    """Store the state of all games before ``until``."""
    store(fold(unified_history(stats, props_with_id, in_range(games, until=until))), path, until)


def changed_scopes(state: DataFrame, props_with_id: DataFrame) -> DataFrame:
    """(personid, stat) whose offered lines are not those of the state."""
    lines = props_with_id.where(F.col("stat").isNotNull()).select(*LINE_KEY).distinct().withColumn("_now", F.lit(1))
    known = state.select(*LINE_KEY).withColumn("_now", F.lit(2))
    # Lines without any game have no state; their scope is rebuilt, from no rows.
    return lines.unionByName(known).groupBy(*LINE_KEY).agg(F.sum("_now").alias("_n")).where("_n != 3").select(*SCOPE).distinct()


def advance(spark: SparkSession, stats: DataFrame, props_with_id: DataFrame, games: DataFrame, path: str, until: str) -> DataFrame:
    """Bring the stored state up to ``until`` and return it. Only games since the
    last state are read, and the whole history of players and stats whose
    offered lines changed."""
    last = stored(spark, path)
    if last is None:
        rebuild(stats, props_with_id, games, path, until)
    elif last[1] < until:
        state, since = last
        changed = changed_scopes(state, props_with_id)
        same = props_with_id.join(changed, SCOPE, "left_anti")
        kept = state.join(changed, SCOPE, "left_anti")
        delta = fold(unified_history(stats, same, in_range(games, since, until)))
        again = fold(unified_history(stats, props_with_id.join(changed, SCOPE, "left_semi"), in_range(games, until=until)))
        store(merge(kept, delta).unionByName(again), path, until)
    elif last[1] > until:
        raise ValueError(f"the stored state reaches to {last[1]}, beyond {until}")
    return stored(spark, path)[0]
