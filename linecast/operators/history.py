"""Game-by-game history of every line: ranks, decay weights and summaries.

Skew: one player (or player/stat) may hold a large share of all history rows.
No window here is partitioned by player alone. Exact ranks are assembled as

    rank = (rows of the player/stat in newer months) + (rank within the month)

The within-month rank is a window over (personid, stat, month), whose partitions
hold a single month of one player. The per-month counts are a small aggregate
with one row per (line, month); their running sums run over one row per month,
which the calendar bounds. The offsets are joined back on exactly the window's
partition keys, so the big side is shuffled once (by the window) and never again.
Any cut of the calendar gives the same results; with a player's few games a week,
months leave far fewer rows to the second stage than dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linecast.functions.stats import is_elite, stat_value
from linecast.schemas import LINE_KEY

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
DECAY = 0.95                  # weight of rank r is DECAY ** (r - 1)
MIN_GAMES = 3                 # lines with fewer non-null values are dropped
SHORT_HISTORY = 5             # fewer values: no simulation
RECENT_GAMES = 10             # newest positions with the recency boost
SEASON_GAMES = 82             # newest positions weighted as the current season
SEASON_WEIGHT = 0.7
OLDER_WEIGHT = 0.3
RECENCY_BOOST = 1.5
HOT_RATIO = 1.2               # mean of the list's last three above 1.2 * base: hot
COLD_RATIO = 0.8              # below 0.8 * base: cold
# ---------------------------------------------------------------------------

_MONTH = "_gd"


def _newest_first() -> list:
    """Total order of one player's rows (a missing game date sorts last)."""
    return [F.col("gamedate").desc_nulls_last(), F.col("gameid").desc(), F.col("row_a").desc(), F.col("row_b").desc()]


def _line_tie_order() -> list:
    """Order of the interleaved lines of one player/stat on the same row."""
    return [F.col("line").asc(), F.col("team").asc(), F.col("player_name").asc()]


def _value_order() -> Column:
    """Last in both orders: rows repeated under one key differ only by value."""
    return F.col("x").desc_nulls_last()


def unified_history(stats: DataFrame, props_with_id: DataFrame, games: DataFrame) -> DataFrame:
    """JN3 + JN4 + EXP5: history rows of each resolved line with the game date
    and ``x``, the value of the line's stat. Rows without a game drop.

    Join strategies are left to the optimizer/AQE: the lines side is tiny and
    is broadcast on its measured size; games is broadcast when small and
    sort-merge joined otherwise (AQE splits skewed partitions).
    """
    props_with_id = props_with_id.filter(F.col("stat").isNotNull())   # FLT2: per-stat jobs drop them
    # Only the line's own value, not all six measures, goes on to the games join.
    h = stats.join(props_with_id, on="personid", how="inner").select(
        *LINE_KEY, "gameid", "row_a", "row_b", stat_value("stat").alias("x")
    )
    return h.join(games.select("gameid", "gamedate"), on="gameid", how="inner").select(
        *LINE_KEY, "gameid", "gamedate", "row_a", "row_b", "x"
    )


def _with_month(unified: DataFrame) -> DataFrame:
    # Months counted on from the year 0; a missing game date sorts last, as the smallest.
    month = F.year("gamedate") * 12 + F.month("gamedate")
    return unified.withColumn(_MONTH, F.coalesce(month, F.lit(0)))


def _month_offsets(ranked: DataFrame) -> DataFrame:
    """One row per (personid, stat, month): rows of the player/stat in newer
    months and, per line of that player/stat, values in newer months and the
    line's total number of values.

    The per-month counts are read off the ranked rows (the within-month
    positions), so this branch needs exactly the columns of the main branch
    and Spark reuses the one shuffle of the history rows for both.
    """
    line_months = ranked.groupBy(*LINE_KEY, _MONTH).agg(
        F.count(F.lit(1)).alias("_rows"), F.coalesce(F.max("_month_pos"), F.lit(0)).alias("_vals"))
    key_month = Window.partitionBy("personid", "stat", _MONTH)
    key_newer = Window.partitionBy("personid", "stat").orderBy(F.col(_MONTH).desc())
    line_newer = Window.partitionBy(*LINE_KEY).orderBy(F.col(_MONTH).desc())
    line_all = Window.partitionBy(*LINE_KEY)
    line_months = (
        # default RANGE frame: every line of this and all newer months
        line_months.withColumn("_rk_base", F.sum("_rows").over(key_newer) - F.sum("_rows").over(key_month))
        .withColumn("_pos_base", F.sum("_vals").over(line_newer) - F.col("_vals"))
        .withColumn("_n_vals", F.sum("_vals").over(line_all))
    )
    per_key_month = line_months.groupBy("personid", "stat", _MONTH).agg(
        # bounded by the lines offered for one player/stat
        F.max("_rk_base").alias("_rk_base"),
        F.collect_list(F.struct("player_name", "line", "team", "_pos_base", "_n_vals")).alias("_lines"),
    )
    return per_key_month


def with_recency(unified: DataFrame) -> DataFrame:
    """WIN1 + WIN2 + WIN3 on every history row.

    * ``rk``: 1-based rank within (personid, stat), newest first, ties broken
      by (gameid, row_a, row_b) desc, (line, team, player_name), x desc. Lines of
      the same player/stat interleave, as in the reference.
    * ``w`` = 0.95 ** (rk - 1).
    * ``pos``: 0-based position of a non-null ``x`` within its line, newest
      first (null for null ``x``); ``n_vals``: non-null values of the line.
    """
    u = _with_month(unified).repartition("personid", "stat", _MONTH)
    key_month = Window.partitionBy("personid", "stat", _MONTH).orderBy(*_newest_first(), *_line_tie_order(), _value_order())
    line_month = Window.partitionBy(
        "personid", "stat", _MONTH, "player_name", "line", "team", F.col("x").isNull()
    ).orderBy(*_newest_first(), _value_order())
    ranked = u.withColumn("_month_rk", F.row_number().over(key_month)).withColumn(
        "_month_pos", F.when(F.col("x").isNotNull(), F.row_number().over(line_month))
    )
    joined = ranked.join(_month_offsets(ranked), on=["personid", "stat", _MONTH], how="inner")
    me = F.get(
        F.filter(
            "_lines",
            lambda s: s["player_name"].eqNullSafe(F.col("player_name"))
            & s["line"].eqNullSafe(F.col("line"))
            & s["team"].eqNullSafe(F.col("team")),
        ),
        0,
    )
    out = joined.select(
        *unified.columns,
        (F.col("_rk_base") + F.col("_month_rk")).cast("long").alias("rk"),
        (me["_pos_base"] + F.col("_month_pos") - 1).cast("long").alias("pos"),
        me["_n_vals"].cast("long").alias("n_vals"),
    )
    return out.withColumn("w", F.pow(F.lit(DECAY), F.col("rk") - 1))


def trend_weight(pos: str = "pos") -> F.Column:
    """Position weight of the season-tier mean (AGG8)."""
    p = F.col(pos)
    return (
        F.when(p < RECENT_GAMES, F.lit(SEASON_WEIGHT * RECENCY_BOOST))
        .when(p < SEASON_GAMES, F.lit(SEASON_WEIGHT))
        .otherwise(F.lit(OLDER_WEIGHT))
    )


def line_summary(ranked: DataFrame) -> DataFrame:
    """AGG3-6, AGG8, AGG9, FLT3: one row per line with

    base_avg (decay-weighted mean; a null value keeps its weight in the
    denominator), std_dev, min_val, max_val, game_count (non-null values),
    recent_avg (season-tier mean), last3_avg (mean of the three *oldest*
    values: the tail of the newest-first list), filtered to game_count >= 3.
    One aggregation; partial aggregation runs before the shuffle.
    """
    tw = F.when(F.col("x").isNotNull(), trend_weight("pos"))
    return (
        ranked.groupBy(*LINE_KEY)
        .agg(
            (F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("base_avg"),
            F.stddev_samp("x").alias("std_dev"),
            F.min("x").alias("min_val"),
            F.max("x").alias("max_val"),
            F.count("x").alias("game_count"),
            (F.sum(F.col("x") * tw) / F.sum(tw)).alias("recent_avg"),
            (F.sum(F.when(F.col("pos") >= F.col("n_vals") - 3, F.col("x"))) / F.lit(3.0)).alias("last3_avg"),
        )
        .filter(F.col("game_count") >= MIN_GAMES)
    )


def scope_columns(rank_scope: str) -> list[str]:
    """The columns within which history rows are ranked (B3)."""
    return ["personid", "stat"] if rank_scope == "player_stat" else LINE_KEY


def month_rows(unified: DataFrame, scope: list[str], null_weight: str = "keep") -> DataFrame:
    """One row per (line, month of game dates) with what a month adds to the summary:
    row and value counts, decay sums relative to the month's newest row, sum, mean,
    squared deviations, extremes, and the month's first 82 and last 3 values."""
    # The exchange the windows need anyway, stated explicitly: on large input
    # Spark would insert this same hash partitioning (so it costs nothing
    # extra); on a single-split input it still spreads the work over all tasks.
    u = _with_month(unified).repartition("personid", "stat", _MONTH)
    newest = _newest_first()
    key_month = Window.partitionBy(*scope, _MONTH).orderBy(*newest, *_line_tie_order(), _value_order())
    line_month_part = ["personid", "stat", _MONTH, "player_name", "line", "team", F.col("x").isNull()]
    line_month = Window.partitionBy(*line_month_part).orderBy(*newest, _value_order())
    line_month_all = Window.partitionBy(*line_month_part)   # same sort as line_month: no extra sort
    r = (
        u.withColumn("_month_rk", F.row_number().over(key_month))
        .withColumn("_p", F.when(F.col("x").isNotNull(), F.row_number().over(line_month)))
        # position from the oldest end of the (line, month) values
        .withColumn("_q", F.when(F.col("x").isNotNull(),
                                 F.count("x").over(line_month_all) - F.col("_p") + 1))
    )
    w_month = F.pow(F.lit(DECAY), F.col("_month_rk") - 1)
    value = F.struct(F.col("_p").alias("p"), F.col("x").alias("x"))
    return r.groupBy(*LINE_KEY, _MONTH).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("x").alias("_vals"),
        F.sum(F.col("x") * w_month).alias("_a"),
        F.sum(w_month if null_weight == "keep" else F.when(F.col("x").isNotNull(), w_month)).alias("_b"),
        F.sum("x").alias("_sum_d"),
        F.avg("x").alias("_mean_d"),
        (F.var_pop("x") * F.count("x")).alias("_m2_d"),
        F.min("x").alias("_min_d"),
        F.max("x").alias("_max_d"),
        # bounded: at most SEASON_GAMES and 3 values per (line, month)
        F.collect_list(F.when(F.col("_p") <= SEASON_GAMES, value)).alias("_head"),
        F.collect_list(F.when(F.col("_q") <= 3, value)).alias("_tail"),
    )


def placed_months(months: DataFrame, scope: list[str]) -> DataFrame:
    """``month_rows`` with their place in the history: rows of the scope in newer
    months, the line's values in newer months, and the line's totals."""
    key_month_w = Window.partitionBy(*scope, _MONTH)
    key_newer = Window.partitionBy(*scope).orderBy(F.col(_MONTH).desc())
    line_newer = Window.partitionBy(*LINE_KEY).orderBy(F.col(_MONTH).desc())
    line_all = Window.partitionBy(*LINE_KEY)
    return (
        months.withColumn("_rk_base", F.sum("_rows").over(key_newer) - F.sum("_rows").over(key_month_w))
        .withColumn("_pos_base", F.sum("_vals").over(line_newer) - F.col("_vals"))
        .withColumn("_n", F.sum("_vals").over(line_all))
        .withColumn("_mean", F.try_divide(F.sum(F.col("_vals") * F.col("_mean_d")).over(line_all), F.col("_n")))
    )


def summarize_lines(unified: DataFrame, rank_scope: str = "player_stat", null_weight: str = "keep",
                    streak_side: str = "oldest") -> DataFrame:
    """The per-line summary of :func:`line_summary` in one pass over the rows.

    Options (defaults as in the reference): ``rank_scope`` (B3) ``player_stat``
    ranks the rows of all lines of a player and stat together, ``line`` each
    line alone; ``null_weight`` (B5) ``keep`` leaves the weight of a null value
    in the denominator, ``drop`` takes it out; ``streak_side`` (B6) ``oldest``
    averages the three oldest values for the streak, ``latest`` the newest.

    Only one shuffle moves history rows: the within-month windows over
    (personid, stat, month). Everything after works on one row per (line, month):

    * decay: sum(x * 0.95**(rk-1)) = sum over months of
      0.95**(rows in newer months) * sum(x * 0.95**(month rank - 1)),
    * season-tier mean: only the newest 82 positions have distinct weights, so
      each (line, month) keeps its first 82 values (by position) in a bounded
      array, the rest enters as a plain sum with weight 0.3,
    * last three: each (line, month) keeps its last three values,
    * standard deviation: per-month count, mean and squared deviations merged
      with the parallel-variance formula.

    The second shuffle moves (line, month) rows partitioned by (personid, stat):
    a hot player's rows are spread over its months, and its months are bounded
    by the calendar.
    """
    for given, known in ((rank_scope, ("player_stat", "line")), (null_weight, ("keep", "drop")), (streak_side, ("oldest", "latest"))):
        if given not in known:
            raise ValueError(f"{given!r} is none of {known}")
    scope = scope_columns(rank_scope)
    months = placed_months(month_rows(unified, scope, null_weight), scope)

    def pos(e):
        return F.col("_pos_base") + e["p"] - 1

    def tw(e):
        p = pos(e)
        return (F.when(p < RECENT_GAMES, F.lit(SEASON_WEIGHT * RECENCY_BOOST))
                .when(p < SEASON_GAMES, F.lit(SEASON_WEIGHT)).otherwise(F.lit(OLDER_WEIGHT)))

    # Months wholly behind the newest 82 values, or before the last three, are
    # plain sums: their arrays are not looked at.
    recent = F.col("_pos_base") < SEASON_GAMES
    head_x = F.aggregate("_head", F.lit(0.0), lambda acc, e: acc + e["x"])
    sum_d = F.coalesce(F.col("_sum_d"), F.lit(0.0))
    trend_num = F.when(recent, F.aggregate("_head", F.lit(0.0), lambda acc, e: acc + e["x"] * tw(e)) + (
        sum_d - head_x) * F.lit(OLDER_WEIGHT)).otherwise(sum_d * F.lit(OLDER_WEIGHT))
    trend_den = F.when(recent, F.aggregate("_head", F.lit(0.0), lambda acc, e: acc + tw(e)) + (
        F.col("_vals") - F.size("_head")).cast("double") * F.lit(OLDER_WEIGHT)).otherwise(
        F.col("_vals").cast("double") * F.lit(OLDER_WEIGHT))
    if streak_side == "oldest":
        values, within, any_within = "_tail", lambda e: pos(e) >= F.col("_n") - 3, F.col("_pos_base") + F.col("_vals") > F.col("_n") - 3
    else:
        values, within, any_within = "_head", lambda e: pos(e) < 3, F.col("_pos_base") < 3
    last3 = F.when(any_within, F.aggregate(values, F.lit(0.0), lambda acc, e: acc + F.when(within(e), e["x"]).otherwise(F.lit(0.0))))
    last3 = F.coalesce(last3, F.lit(0.0))
    scale = F.pow(F.lit(DECAY), F.col("_rk_base"))
    n = F.max("_n")
    m2 = F.sum("_m2_d") + F.sum(F.col("_vals") * (F.col("_mean_d") - F.col("_mean")) * (F.col("_mean_d") - F.col("_mean")))
    return (
        months.groupBy(*LINE_KEY)
        .agg(
            (F.sum(scale * F.col("_a")) / F.sum(scale * F.col("_b"))).alias("base_avg"),
            F.sqrt(F.try_divide(m2, (n - 1).cast("double"))).alias("std_dev"),
            F.min("_min_d").alias("min_val"),
            F.max("_max_d").alias("max_val"),
            n.alias("game_count"),
            (F.sum(trend_num) / F.sum(trend_den)).alias("recent_avg"),
            (F.sum(last3) / F.lit(3.0)).alias("last3_avg"),
        )
        .filter(F.col("game_count") >= MIN_GAMES)
    )


def with_model_inputs(summary: DataFrame) -> DataFrame:
    """SCN4, SCN5, SCN8 inputs: trend ratio, elite flag and streak state."""
    base = F.col("base_avg")
    return (
        summary.withColumn(
            "trend", F.when(base > 0, F.col("recent_avg") / base).otherwise(F.lit(1.0))
        )
        .withColumn("is_elite", is_elite("stat", base, "game_count"))
        .withColumn(
            "streak",
            F.when(F.col("last3_avg") > base * HOT_RATIO, F.lit("hot"))
            .when(F.col("last3_avg") < base * COLD_RATIO, F.lit("cold"))
            .otherwise(F.lit("none")),
        )
    )


def decay_summary(stats: DataFrame, props_with_id: DataFrame, games: DataFrame, **options: str) -> DataFrame:
    """Unified history -> ranks -> per-line summary with model inputs;
    ``options`` as in :func:`summarize_lines`."""
    return with_model_inputs(summarize_lines(unified_history(stats, props_with_id, games), **options))
