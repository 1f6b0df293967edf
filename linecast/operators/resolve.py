"""Player resolution: de-duplicate players and map offered lines to ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.functions.names import with_name_parts


def dedup_players(players: DataFrame) -> DataFrame:
    """DD1: one row per ``personid``.

    The survivor is the smallest (firstname, lastname), so reruns agree. An
    aggregate (not a window) keeps it skew-safe: partial aggregation collapses
    a hot id map-side before the shuffle.
    """
    return players.groupBy("personid").agg(
        F.min(F.struct("firstname", "lastname")).alias("_n")
    ).select("personid", F.col("_n.firstname").alias("firstname"), F.col("_n.lastname").alias("lastname"))


def resolve_players(props: DataFrame, players: DataFrame, keep_team: bool = True,
                    name_rule: str = "first_second") -> DataFrame:
    """JN1 + PRJ2: offered lines joined to players on (firstname, lastname).

    Unmatched names drop; a name shared by several ids fans out to each id.
    The join strategy is left to the optimizer and AQE, which broadcast the
    side whose estimated or measured size is under the broadcast threshold.
    """
    named = with_name_parts(props, name_rule=name_rule)
    cols = ["player_name", "stat", "line"] + (["team"] if keep_team else []) + ["personid"]
    return named.join(dedup_players(players), ["firstname", "lastname"], "inner").select(*cols)


def stat_types(props_with_id: DataFrame) -> DataFrame:
    """DD4: the distinct stat types of the resolved lines."""
    return props_with_id.select("stat").distinct()
