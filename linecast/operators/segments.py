"""AGG7: a line's history as an array, in segments of bounded length.

The reference collects all values of a line into one array. Here the array is
cut into segments of ``SEGMENT`` positions: one row per (line, segment), so no
row and no aggregation buffer grows with a player's career. Positions come from
:func:`linecast.operators.history.with_recency`: the place within the month
plus the values in newer months, with no window over a whole line.

The array's readers work on segments: only the first one holds positions with
weights of their own, only the last two can hold the last three values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.operators.history import MIN_GAMES, SEASON_GAMES, trend_weight, with_recency
from linecast.schemas import LINE_KEY

#: Positions of a segment: those of a season, so that only segment 0 has mixed weights.
SEGMENT = SEASON_GAMES


def history_segments(unified: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(line key, ``segment`` from 0, ``first_pos``, ``values`` newest first,
    ``n_vals`` of the whole line); null values are left out, as in the array."""
    placed = with_recency(unified).where(F.col("pos").isNotNull())
    item = F.struct("pos", "x")
    rows = placed.groupBy(*LINE_KEY, F.floor(F.col("pos") / size).cast("int").alias("segment")).agg(
        F.sort_array(F.collect_list(item)).alias("_items"), F.max("n_vals").alias("n_vals"))
    return rows.select(*LINE_KEY, "segment", F.col("_items")[0]["pos"].alias("first_pos"),
                       F.transform("_items", lambda i: i["x"]).alias("values"), "n_vals")


def rules_from_segments(segments: DataFrame) -> DataFrame:
    """AGG8 and AGG9 read from the array: season-tier mean ``recent_avg`` and the
    mean of the list's last three values ``last3_avg``, per line with at least
    three values (FLT3)."""
    positioned = F.transform("values", lambda x, i: F.struct((F.col("first_pos") + i).alias("pos"), x.alias("x")))
    items = segments.select(*LINE_KEY, "n_vals", F.explode(positioned).alias("i")).select(*LINE_KEY, "n_vals", "i.pos", "i.x")
    weight = trend_weight("pos")
    return items.groupBy(*LINE_KEY).agg(
        F.max("n_vals").alias("game_count"),
        (F.sum(F.col("x") * weight) / F.sum(weight)).alias("recent_avg"),
        (F.sum(F.when(F.col("pos") >= F.col("n_vals") - 3, F.col("x"))) / F.lit(3.0)).alias("last3_avg"),
    ).where(F.col("game_count") >= MIN_GAMES)


def concatenated(segments: DataFrame) -> DataFrame:
    """Segments with their values as one text (exact to four decimals)."""
    text = F.array_join(F.transform("values", lambda x: x.cast("decimal(18,4)").cast("string")), ",")
    return segments.select(*LINE_KEY, "segment", "first_pos", F.size("values").alias("n_values"), text.alias("values"), "n_vals")
