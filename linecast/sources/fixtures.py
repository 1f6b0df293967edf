"""The reference's relations derived from the driver's parquet tables.

| relation    | driver table | mapping                                                |
|-------------|--------------|--------------------------------------------------------|
| players     | supplier     | ``Supplier#000000001`` -> (Supplier, 000000001)        |
| namesakes   | part         | two-word part names, many ids per name                 |
| stats       | lineitem     | supplier = player, order = game, whole table           |
| games       | orders       | order date = game date                                 |
| props       | players      | one line per player, three for points players          |
| predictions | props+stats  | a stored predictions table for the report queries     |
| triggers    | events       | event type -> job type, event time -> message time    |
| short lines | customer     | customer = player, orders = games (few per player)    |

Every relation reads only the columns it needs, so scans carry a pruned
``ReadSchema``. Roundings use ``floor(x * k + 0.5) / k`` so that Spark and
DuckDB produce the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecast.functions.fmt import ISO_UTC_FORMAT
from linecast.functions.names import display_name

# Stat type and base line per ``personid % 7`` (fixture design).
PROP_STATS = ["points", "assists", "rebounds", "steals", "blocks", "threes", "turnovers"]
PROP_LINES = [24.5, 7.5, 5.5, 1.5, 0.5, 1.5, 22.5]
# Extra lines of points players (the same player and stat with several lines).
POINTS_LINE_DELTAS = [0.0, 1.0, -0.2]
PROP_GAME_DATE = "2024-01-01"


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the DataFrame (file listing and schema) is built once
    per session and path, then reused by every query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _round_to(c: Column, scale: float) -> Column:
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(personid, firstname, lastname)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("personid"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(1)).alias("firstname"),
        F.split_part(F.col("s_name"), F.lit("#"), F.lit(2)).alias("lastname"),
    )


def players_namesakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players whose names repeat across ids (part names)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("personid"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("firstname"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("lastname"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(gameid, gamedate)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("gameid"), F.col("o_orderdate").alias("gamedate"))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box-score row per lineitem: (personid, gameid, row_a, row_b, six measures).

    (gameid, row_a, row_b) orders the rows of one player totally.
    """
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.col("l_suppkey").alias("personid"),
        F.col("l_orderkey").alias("gameid"),
        F.col("l_partkey").alias("row_a"),
        F.col("l_linenumber").cast("long").alias("row_b"),
        F.col("l_quantity").alias("points"),
        (F.col("l_linenumber") * 2).cast("double").alias("assists"),
        _round_to(F.col("l_extendedprice") / F.lit(10000.0), 100.0).alias("reboundstotal"),
        _round_to(F.col("l_discount") * F.lit(30.0), 10.0).alias("steals"),
        _round_to(F.col("l_tax") * F.lit(10.0), 10.0).alias("blocks"),
        (F.col("l_linenumber") % 4).cast("double").alias("threepointersmade"),
    )


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offered lines (player_name, stat, line, game_date, team)."""
    p = players(spark, sf_dir)
    k = F.col("personid") % 7
    stat = F.element_at(F.array(*[F.lit(s) for s in PROP_STATS]), (k + 1).cast("int"))
    base = F.element_at(F.array(*[F.lit(v) for v in PROP_LINES]), (k + 1).cast("int"))
    deltas = F.when(k == 0, F.array(*[F.lit(d) for d in POINTS_LINE_DELTAS])).otherwise(
        F.array(F.lit(0.0))
    )
    return p.select(
        F.concat(F.col("firstname"), F.lit(" "), F.col("lastname")).alias("player_name"),
        stat.alias("stat"),
        base.alias("base_line"),
        F.explode(deltas).alias("delta"),
        F.lit(PROP_GAME_DATE).alias("game_date"),
        F.concat(F.lit("T"), (F.col("personid") % 5).cast("string")).alias("team"),
    ).select(
        "player_name",
        "stat",
        (F.col("base_line") + F.col("delta")).alias("line"),
        "game_date",
        "team",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored predictions table: one row per offered line, predicted by the
    player's mean points, three creation times and some null deviations."""
    pl = players(spark, sf_dir).withColumn(
        "player_name", F.concat(F.col("firstname"), F.lit(" "), F.col("lastname"))
    )
    pv = stats(spark, sf_dir).groupBy("personid").agg(F.avg("points").alias("pv"))
    r = props(spark, sf_dir)
    j = r.join(pl, "player_name").join(pv, "personid")
    dev = F.when(F.col("pv") > F.col("line"), (F.col("pv") - F.col("line")) / F.col("line") * 100.0).otherwise(
        (F.col("line") - F.col("pv")) / F.col("line") * 100.0
    )
    created = (
        F.when(F.col("personid") % 3 == 0, F.lit("2024-01-02 00:00:00"))
        .when(F.col("personid") % 3 == 1, F.lit("2024-01-02 00:04:00"))
        .otherwise(F.lit("2024-01-02 00:09:00"))
    )
    return j.select(
        "personid",
        display_name("firstname", "lastname").alias("player_name"),
        F.col("stat").alias("stat_type"),
        "line",
        F.lit(PROP_GAME_DATE).cast("date").alias("game_date"),
        "team",
        F.col("pv").alias("predicted_value"),
        F.when(F.col("pv") > F.col("line"), "over").otherwise("under").alias("bet_outcome"),
        F.when(F.col("personid") % 17 == 0, F.lit(None).cast("double")).otherwise(dev).alias("deviation_percentage"),
        F.col("pv").alias("probability_over_raw"),
        created.cast("timestamp").alias("created_at"),
        F.lit(1.5).alias("processing_time_seconds"),
        F.lit(12.25).alias("total_processing_time_seconds"),
    ).withColumn(
        # scenario columns of the stored rows (share of the line reached)
        "probability_over",
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("probability_over_raw") / (F.col("line") * 2.0))),
    ).withColumn("confidence_low", F.col("predicted_value") * 0.8).withColumn(
        "confidence_high", F.col("predicted_value") * 1.2
    ).withColumn(
        "confidence_score",
        F.when((F.col("probability_over") >= 0.7) | (F.col("probability_over") <= 0.3), "high")
        .when((F.col("probability_over") >= 0.55) | (F.col("probability_over") <= 0.45), "medium")
        .otherwise("low"),
    ).withColumn(
        "risk_assessment",
        F.when(F.col("confidence_high") - F.col("confidence_low") > F.col("predicted_value") * 0.5, "high_risk")
        .when(F.col("confidence_high") - F.col("confidence_low") > F.col("predicted_value") * 0.3, "medium_risk")
        .otherwise("low_risk"),
    ).drop("probability_over_raw")


def customer_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stats, resolved lines, games) with customers as players and their
    orders as games: whole tables in which many players have short histories
    (one to four games)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    box = o.select(
        F.col("o_custkey").alias("personid"), F.col("o_orderkey").alias("gameid"), F.col("o_orderkey").alias("row_a"), F.lit(0).cast("long").alias("row_b"),
        _round_to(F.col("o_totalprice") / F.lit(10000.0), 100.0).alias("points"),
        *[F.lit(None).cast("double").alias(m) for m in ["assists", "reboundstotal", "steals", "blocks", "threepointersmade"]],
    )
    lines = c.select(
        F.col("c_custkey").alias("personid"), F.replace("c_name", F.lit("#"), F.lit(" ")).alias("player_name"), F.lit("points").alias("stat"),
        F.lit(15.5).alias("line"), F.concat(F.lit("T"), (F.col("c_custkey") % 5).cast("string")).alias("team"),
    )
    return box, lines, games(spark, sf_dir)


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message records shaped like the trigger topic: (timestamp, value)."""
    e = table(spark, sf_dir, "events")
    job_type = F.when(F.col("event_type") == "purchase", F.lit("prop_bet_analysis")).otherwise(
        F.col("event_type")
    )
    value = F.to_json(
        F.named_struct(
            F.lit("job_type"), job_type,
            F.lit("timestamp"), F.date_format(F.col("ts"), ISO_UTC_FORMAT),
        )
    )
    return e.select(
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        value.cast("binary").alias("value"),
    )
