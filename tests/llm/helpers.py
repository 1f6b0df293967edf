"""Small documents with the awkward cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"

EN = "the of and to in that was his with they have from this which one had were not but what all when there can".split()
DE = "der die und den von das mit sich des auf ist nicht ein eine als auch nach wie wird sind noch wurde".split()


def prose(seed: int, n: int, vocabulary: list[str] = EN) -> str:
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = r.choice(vocabulary) + (r.choice(["er", "ing", "ed", "", "s"]) if vocabulary is EN else r.choice(["en", "ung", "", "lich"]))
        out.append(w + (".\n" if i % 17 == 16 else ""))
    return " ".join(out)


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long text, exact
    copies, a near copy, a repeated row, a tie, other alphabets."""
    base = prose(1, 300)
    near = base + " " + prose(99, 5)
    rows = [
        (1, base, "en", "a", len(base), 0),
        (2, base, "en", "a", len(base), 1),
        (3, near, "en", "b", len(near), 2),
        (4, prose(2, 200, DE), "de", "b", 1, 3),
        (5, prose(3, 20_000), "en", "b", 2, 4),
        (6, "", "en", "c", 0, None),
        (7, " \n\t ", "de", "", 0, 5),
        (8, None, None, None, None, None),
        (None, prose(4, 80), "en", "a", 3, 6),
        (9, prose(5, 120, DE), "de", None, 4, 7),
        (9, prose(5, 120, DE), "de", None, 4, 7),
        (10, "12 !! 34", "en", "c", 5, 8),
        (11, "日本語 テスト 😀 ́x", None, "c", 6, 9),
        (12, "one two three", "en", "c", 7, 10),
        (13, "ONE two THREE", "en", "c", 8, 11),
    ]
    return rows


def awkward(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    """The same rows with extra columns named like operators' own columns."""
    for c in ("id", "n", "size", "target", "spans", "score", "component_id", "words", "h", "bucket", "rep", "label", "piece", "length", "line", "family", "conv", "vec", "node"):
        if c not in docs.columns:
            docs = docs.selectExpr("*", f"'x' as {c}")
    return docs


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
