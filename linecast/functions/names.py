"""Player-name handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_part(name: Column | str, index: int) -> Column:
    """Token ``index`` (0-based) of the name split on single spaces, trimmed.

    Only tokens 0 and 1 are used by the jobs: "Karl Anthony Towns" gives
    (Karl, Anthony) and a double space gives an empty last name. A missing
    token is null (``get`` instead of ``[]``, which throws under ANSI mode),
    so such a name simply finds no player in the join.
    """
    col = F.col(name) if isinstance(name, str) else name
    return F.trim(F.get(F.split(col, " "), index))


def with_name_parts(df, name_col: str = "player_name", name_rule: str = "first_second"):
    """PRJ1: add ``firstname`` and ``lastname`` derived from ``name_col``.

    ``name_rule`` (B2): ``first_second`` takes the first two tokens, as the
    reference does; ``first_rest`` keeps the whole rest as the last name
    ("Ann Lee Example" gives (Ann, Lee Example))."""
    if name_rule == "first_second":
        last = name_part(name_col, 1)
    elif name_rule == "first_rest":
        last = F.nullif(F.trim(F.regexp_replace(F.trim(name_col), r"^\S+\s*", "")), F.lit(""))
    else:
        raise ValueError(f"unknown name rule {name_rule!r}")
    return df.withColumn("firstname", name_part(F.trim(name_col) if name_rule == "first_rest" else name_col, 0)).withColumn("lastname", last)


def display_name(first: Column | str, last: Column | str) -> Column:
    """Display name ``first last``; a null part is skipped instead of printed."""
    return F.concat_ws(" ", first, last)
