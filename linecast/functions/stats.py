"""Stat-type rules: which box-score column a line refers to and the
per-stat constants of the scenario model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Stat name of a line -> box-score column; any other name uses points.
STAT_COLUMN = {
    "points": "points",
    "assists": "assists",
    "rebounds": "reboundstotal",
    "steals": "steals",
    "blocks": "blocks",
    "threes": "threepointersmade",
    "3pm": "threepointersmade",
}
DEFAULT_STAT_COLUMN = "points"

# Stats simulated with the tighter variance set.
TIGHT_STATS = ["threes", "3pm", "threepointersmade", "steals"]

# Elite rule: more than ELITE_MIN_GAMES values and a base average above the
# stat's threshold.
ELITE_MIN_GAMES = 100
ELITE_THRESHOLDS = [
    (["points"], 20.0),
    (["assists"], 5.0),
    (["rebounds", "reboundstotal"], 6.5),
    (["steals"], 1.3),
    (["blocks"], 1.2),
    (["threes", "3pm", "threepointersmade"], 2.5),
]

# Minimum floor of a regular player's simulated value; other stats 0.5.
FLOOR_MINIMUMS = [
    (["points"], 2.0),
    (["assists"], 1.0),
    (["rebounds", "reboundstotal"], 1.5),
    (["steals"], 0.3),
    (["blocks"], 0.2),
    (["threes", "3pm", "threepointersmade"], 0.5),
]
DEFAULT_FLOOR_MINIMUM = 0.5
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stat_value(stat: Column | str = "stat") -> Column:
    """EXP5: the value of the line's stat on a box-score row (one pass, no
    per-stat branches)."""
    s = _col(stat)
    by_column: dict[str, list[str]] = {}
    for name, column in STAT_COLUMN.items():
        by_column.setdefault(column, []).append(name)
    expr = None
    for column, names in by_column.items():
        cond = s.isin(names)
        expr = F.when(cond, F.col(column)) if expr is None else expr.when(cond, F.col(column))
    return expr.otherwise(F.col(DEFAULT_STAT_COLUMN)).cast("double")


def stat_value_sql(stat: str = "stat") -> str:
    """The same lookup as SQL text (used by the oracle and the union form)."""
    arms = " ".join(
        f"WHEN {stat} = '{name}' THEN {column}" for name, column in STAT_COLUMN.items()
    )
    return f"CAST(CASE {arms} ELSE {DEFAULT_STAT_COLUMN} END AS DOUBLE)"


def is_tight(stat: Column | str = "stat") -> Column:
    return _col(stat).isin(TIGHT_STATS)


def elite_threshold(stat: Column | str = "stat") -> Column:
    """Base-average threshold of the elite rule; null for other stats."""
    s = _col(stat)
    return reduce(
        lambda acc, item: acc.when(s.isin(item[0]), F.lit(item[1])),
        ELITE_THRESHOLDS[1:],
        F.when(s.isin(ELITE_THRESHOLDS[0][0]), F.lit(ELITE_THRESHOLDS[0][1])),
    )


def is_elite(stat: Column | str, base: Column | str, n: Column | str) -> Column:
    """SCN5: elite iff n > 100 and base above the stat's threshold."""
    thr = elite_threshold(stat)
    return F.coalesce((_col(n) > ELITE_MIN_GAMES) & (_col(base) > thr), F.lit(False))


def floor_minimum(stat: Column | str = "stat") -> Column:
    s = _col(stat)
    expr = F.when(s.isin(FLOOR_MINIMUMS[0][0]), F.lit(FLOOR_MINIMUMS[0][1]))
    for names, value in FLOOR_MINIMUMS[1:]:
        expr = expr.when(s.isin(names), F.lit(value))
    return expr.otherwise(F.lit(DEFAULT_FLOOR_MINIMUM))
