"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size (words of its documents). The total size
is shared by weight; a source's target stops at ``max_epochs`` times its size,
and the excess is reshared by weight among the others until none is above.
The fixed point is found in closed form: ordered by cap / weight the clamped
sources are a prefix, and a source is clamped when its share of what the
sources before it leave exceeds its cap.

A target of r times the source's size is sampled as floor(r) whole repetitions
of every document plus a seeded fraction: in the order of a seeded hash of the
id, documents are taken once more as long as their sizes add up to the rest
(to within half a document). Nothing is drawn at random, so reruns agree.

Scale: a running sum over a whole source would put it in one task. The hash
space is cut into ``BUCKETS`` equal ranges instead; range sums place the cut,
ranges below it are taken whole, and only the one range that holds the cut is
ordered. The small table of sources is joined with salt, so a source with a
third of all rows is spread over ``SALTS`` partitions.

Defined results: null text has size 0 and takes 0; null is a source of its own
(last in order), the empty name another; a source of size 0 has target 0; an
empty table gives an empty table; repeated rows count as rows of their own;
extra columns are ignored by ``mix`` and kept by ``resample``.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linecast.llm.common import WORD, materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BUCKETS = 1 << 15
SALTS = 32


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def water_fill(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size), one row per source -> the same with
    ``target``. Weights repeat over the sources by code point, null last."""
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    total = F.col("_total")
    dec = lambda c: F.col(c).cast("decimal(38,0)")
    return (
        sizes.select("source", "source_size")
        .withColumn("_w", F.element_at(F.array(*(F.lit(int(w)) for w in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_total", F.sum("source_size").over(every))
        .withColumn("_before", F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_before", F.coalesce("_before", F.lit(0).cast("long")))
        .withColumn("_rest", F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_clamped", (dec("_total") - dec("_before")) * dec("_w") > dec("_cap") * dec("_rest"))
        .withColumn("_left", total - F.coalesce(F.sum(F.when(F.col("_clamped"), F.col("_cap"))).over(every), F.lit(0).cast("long")))
        .withColumn("_share", F.sum(F.when(~F.col("_clamped"), F.col("_w"))).over(every))
        .withColumn("target", F.when(F.col("_clamped"), F.col("_cap").cast("double")).otherwise(F.col("_left").cast("double") * F.col("_w") / F.col("_share")))
        .select("source", "source_size", "target")
    )


def _hash(seed: int) -> Column:
    """60 seeded bits per id (of its md5, which other engines compute alike)."""
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _bucket(h: Column | None = None) -> Column:
    """The hash range of a row."""
    return F.shiftright(F.col("h") if h is None else h, 60 - BUCKETS.bit_length() + 1).cast("int")


def plan(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: size, target, whole repetitions, words of the fraction, and
    the hash range that holds the cut with the sum of the ranges below it.

    ``sized``: (source, size, bucket) of every document.
    """
    ranges = sized.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    sizes = ranges.groupBy("source").agg(F.sum("sum").alias("source_size"))
    per_source = (
        water_fill(sizes, weights, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("part", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    )
    running = ranges.withColumn("below", F.sum("sum").over(Window.partitionBy("source").orderBy("bucket")) - F.col("sum"))
    cut = (
        running.alias("r").join(per_source.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        .where(F.col("r.below") <= F.col("s.part")).groupBy("r.source")
        .agg(F.max(F.struct("r.bucket", "r.below")).alias("cut"))
    )
    return (
        per_source.alias("s").join(cut.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left")
        .select("s.source", "s.source_size", "s.target", "s.whole", "s.part", F.col("c.cut.bucket").alias("cut_bucket"), F.col("c.cut.below").alias("cut_below"))
    )


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    return materialize(sized.withColumn("h", _hash(seed)).withColumn("bucket", _bucket()), "mixing-sizes")


def _at_cut(joined: DataFrame) -> DataFrame:
    """The rows of the cut ranges with ``extra``: taken once more."""
    before = Window.partitionBy("source").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")) + F.col("cut_below")
    inside = joined.where(F.col("bucket") == F.col("cut_bucket")).withColumn("below", below)
    return inside.withColumn("extra", (F.col("below") + F.col("size") / 2 <= F.col("part")) & (F.col("part") > 0)).drop("below")


def _before_cut() -> Column:
    return (F.col("bucket") < F.col("cut_bucket")) & (F.col("part") > 0)


def repetitions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document: id, size, source, source_size, target, ``reps``."""
    sized = _sized(docs, id_col, text_col, source_col, seed)
    sources = plan(sized, weights, max_epochs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = (
        sized.withColumn("salt", (F.col("h") % SALTS).cast("int")).alias("d")
        .join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.salt") == F.col("s.salt")))
        .select("d.id", "d.size", "d.source", "d.h", "d.bucket", "s.source_size", "s.target", "s.whole", "s.part", "s.cut_bucket", "s.cut_below")
    )
    outside = joined.where(F.col("bucket") != F.col("cut_bucket")).withColumn("extra", _before_cut())
    return _at_cut(joined).unionByName(outside).select("id", "size", "source", "source_size", "target", (F.col("whole") + F.col("extra").cast("long")).alias("reps")).withColumnRenamed("id", id_col)


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document with the words that the mix takes of it."""
    r = repetitions(docs, id_col, **options)
    return r.select(id_col, "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken"), "source", "reps")


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed rows themselves: every document as often as the mix takes it.

    Documents of size 0 take no words and go. Of rows that share an id and
    source at a cut, all are taken once more or none.

    Texts stay where they are: a row's repetitions follow from its source's
    plan and its own hash, except in the ranges that hold a cut. The plans
    (a row per source) and the ids taken there (about one document in
    ``BUCKETS``) are written tables of known size, which Spark broadcasts
    under its threshold and joins by a shuffle beyond it.
    """
    sized = _sized(docs, id_col, text_col, source_col, seed)
    plans = materialize(plan(sized, weights, max_epochs), "mixing-plan").withColumnRenamed("source", "_source")
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    at_cut = _at_cut(sized.join(plans, same_source & (F.col("bucket") == F.col("cut_bucket"))).drop("_source"))
    taken = at_cut.groupBy("id", "source").agg(F.min("extra").alias("extra")).where("extra")
    taken = materialize(taken.select(F.col("id").alias("_id"), F.col("source").alias("_at"), F.lit(1).cast("long").alias("_hit")), "mixing-taken")

    kept = [F.col(f"d.`{c}`") for c in docs.columns]
    own = F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.regexp_like(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).alias("sized"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), own.alias("o")).where("o.sized")
    rows = rows.select("d", F.col("o.id").alias("id"), F.col("o.source").alias("source")).withColumn("bucket", _bucket(_hash(seed)))
    mixed = (
        rows.join(plans, same_source)
        .join(taken, F.col("id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_at")) & (F.col("bucket") == F.col("cut_bucket")), "left")
        .withColumn("reps", F.col("whole") + _before_cut().cast("long") + (F.col("bucket") == F.col("cut_bucket")).cast("long") * F.coalesce("_hit", F.lit(0).cast("long")))
    )
    return mixed.where("reps > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("reps")))).select(*kept)


def oracle_sql(weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """``mix`` in DuckDB SQL: the same closed form, the fraction by one running sum per source."""
    return rf"""
WITH d AS (
  SELECT doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, {list(weights)}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT] AS w,
         source_size * {max_epochs} AS cap, sum(source_size) OVER () AS total
  FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM w
), c AS (
  SELECT *, (total - before)::HUGEINT * w > cap::HUGEINT * rest AS clamped FROM o
), t AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN cap::DOUBLE
              ELSE (total - coalesce(sum(cap) FILTER (clamped) OVER (), 0))::DOUBLE * w / (sum(w) FILTER (NOT clamped) OVER ())::DOUBLE END AS target
  FROM c
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.*, p.source_size, p.target, p.whole, greatest(0.0::DOUBLE, p.target - p.whole * p.source_size) AS part,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN part > 0 AND below + size / 2.0::DOUBLE <= part THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
