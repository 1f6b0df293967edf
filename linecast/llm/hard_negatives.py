"""Hard-negative mining by Strassen products of integer tiles.

Vector components become floor(``scale`` * x), as integers; a row's score for an
anchor is their integer inner product. An anchor's positives are its best
``positives`` other rows of its label; for each of them the best ``negatives``
rows of other labels whose score lies between ``low`` and ``high`` percent of
the positive's are returned. Higher scores come first, ties by smaller id.

* *Tiles.* Anchors and rows are dealt to tiles by a hash of the row's number. A
  task multiplies one anchor tile by one row tile, block by block: Strassen's
  seven products, recursively, on int64 blocks that are padded with zeros to
  even sides. All steps are integer additions and multiplications, exact modulo
  2^64, and rows whose scores could leave 63 bits take no part, so every score
  is exact. The stated anchors meet all rows; nothing is sampled or pruned.
* *Heaps.* Blocks leave each anchor its best few rows; heaps merge over the
  blocks of a task, then over tasks (a window limit, again per task first). The
  first pass gives the positives; the second, which knows their scores, keeps a
  heap per anchor and positive of the rows inside the score window. No label
  and no group of copies meets in one task.

Defined results: a row with a null id, null label, null vector, or a null or
non-finite component takes no part, nor one whose squared integer length is
2^62 or more; vectors of different length do not meet; rows that repeat an id
are rows of their own (an anchor's other rows are all but itself); extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linecast.llm.common import materialize

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
SCALE = 256
#: Rows of an anchor tile and of a row tile; sides of a block; side at which Strassen's recursion ends.
ANCHORS, ROWS = 4096, 4096
BLOCK = (512, 1024)
LEAF = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices by Strassen's recursion, modulo 2^64."""
    m, d, n = *a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return a @ b
    # Zero rows and columns make all sides even and change nothing.
    a = np.pad(a, ((0, m % 2), (0, d % 2)))
    b = np.pad(b, ((0, d % 2), (0, n % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j], out[:i, j:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :j], out[i:, j:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best ``size`` (score, id) of each of several keys, mergeable."""

    def __init__(self, size: int):
        self.size = size
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def merge(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key, score, ids = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, key))   # ~score descends and never overflows
        key, score, ids = key[order], score[order], ids[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        best = place < self.size
        self.key, self.score, self.id = key[best], score[best], ids[best]

    def offer(self, base: int, step: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Merge a block: row r of ``scores`` belongs to key ``base`` + r * ``step``."""
        masked = np.where(allowed, scores, np.iinfo(np.int64).min)
        if masked.shape[1] > self.size:
            # Equal scores all stay, so that ids decide between them.
            least = np.partition(masked, masked.shape[1] - self.size, axis=1)[:, -self.size]
            allowed = allowed & (masked >= least[:, None])
        row, column = np.nonzero(allowed)
        self.merge(base + row * step, scores[row, column], ids[column])


def _matrix(vectors: pa.ChunkedArray, scale: int) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(len(vectors), -1)


def _blocks(anchors: pa.Table, rows: pa.Table, scale: int):
    """(first anchor, ids, scores, same label, same row) of every block of two tiles."""
    rows = rows.sort_by([("id", "ascending")])
    label = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    a_label, r_label = label[:anchors.num_rows], label[anchors.num_rows:]
    a_row, r_row, ids = anchors["row"].to_numpy(), rows["row"].to_numpy(), rows["id"].to_numpy()
    a, b = _matrix(anchors["vec"], scale), _matrix(rows["vec"], scale).T
    for i in range(0, len(a), BLOCK[0]):
        for j in range(0, b.shape[1], BLOCK[1]):
            s, t = slice(i, i + BLOCK[0]), slice(j, j + BLOCK[1])
            yield i, ids[t], strassen(a[s], b[:, t]), a_label[s, None] == r_label[None, t], a_row[s, None] == r_row[None, t]


def _find_positives(scale: int, positives: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        heaps = Heaps(positives)
        if anchors.num_rows and rows.num_rows:
            for at, ids, scores, same, itself in _blocks(anchors, rows, scale):
                heaps.offer(at, 1, scores, same & ~itself, ids)
        return pa.table({"row": anchors["row"].take(pa.array(heaps.key)), "score": pa.array(heaps.score), "id": pa.array(heaps.id)})

    return task


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest integer between the percentages of a score."""
    return -(-low * score // 100), high * score // 100


def _find_negatives(scale: int, negatives: int, low: int, high: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        lists = anchors["positives"].to_pylist()
        most = max(map(len, lists), default=0)
        heaps = Heaps(negatives)
        # Per place of a positive: the score windows of all anchors (none: an empty one).
        windows = np.array([[_window(x[p]["score"], low, high) if p < len(x) else (1, 0) for x in lists] for p in range(most)], np.int64).reshape(most, len(lists), 2)
        if most and rows.num_rows:
            for at, ids, scores, same, _ in _blocks(anchors, rows, scale):
                for p in range(most):
                    least, largest = windows[p, at:at + len(scores), :, None].transpose(1, 0, 2)
                    heaps.offer(at * most + p, most, scores, ~same & (scores >= least) & (scores <= largest), ids)
        anchor, place = heaps.key // max(most, 1), heaps.key % max(most, 1)
        chosen = [lists[a][p] for a, p in zip(anchor.tolist(), place.tolist())]
        return pa.table({
            "row": anchors["row"].take(pa.array(anchor)), "place": pa.array([x["place"] for x in chosen], pa.int32()),
            "positive_id": pa.array([x["id"] for x in chosen], pa.int64()), "positive_score": pa.array([x["score"] for x in chosen], pa.int64()),
            "negative_id": pa.array(heaps.id), "negative_score": pa.array(heaps.score),
        })

    return task


def _best(rows: DataFrame, keys: list[str], score: str, ids: str, size: int, name: str) -> DataFrame:
    """Merge heaps: the first ``size`` rows of each key with their number from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ids)
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= size)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, anchor_tile: int = ANCHORS, row_tile: int = ROWS) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank
    (from 1), negative_id, positive_score, negative_score. ``anchors``: the
    condition on ``rows`` that names the queries."""
    kind = rows.schema[vec_col].dataType.simpleString()
    vec = F.col(vec_col).cast(kind if kind == "array<float>" else "array<double>")
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = base.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(~bad)
    side = lambda x: F.abs(x.cast("double") * scale) + 1.0
    good = good.where(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + side(x) * side(x)) < float(1 << 62))
    # Numbered in a written table: both passes and reruns see the same rows.
    good = materialize(good.select(F.monotonically_increasing_id().alias("row"), "*", F.size("vec").alias("dim")), "negatives-rows")

    # A tile count per vector length, joined by it.
    sizes = good.groupBy("dim").agg(F.ceil(F.count_if("anchor") / anchor_tile).cast("int").alias("a_tiles"), F.ceil(F.count(F.lit(1)) / row_tile).cast("int").alias("r_tiles")).where("a_tiles > 0")
    dealt = good.join(sizes, "dim")
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    tiles = ["dim", "a", "r"]
    left = dealt.where("anchor").withColumn("a", deal("a_tiles", 1)).withColumn("r", every("r_tiles"))
    right = dealt.withColumn("r", deal("r_tiles", 2)).withColumn("a", every("a_tiles"))
    right = right.select(*tiles, "row", "id", "label", "vec").toDF("_dim", "_a", "_r", "row", "id", "label", "vec").groupBy("_dim", "_a", "_r")

    found = left.select(*tiles, "row", "label", "vec").groupBy(*tiles).cogroup(right).applyInArrow(_find_positives(scale, positives), "row long, score long, id long")
    chosen = _best(found, ["row"], "score", "id", positives, "place").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "score", "id"))).alias("positives"))
    chosen = materialize(chosen, "negatives-positives")   # at most ``positives`` per anchor

    asked = left.join(chosen, "row").select(*tiles, "row", "label", "vec", "positives").groupBy(*tiles)
    schema = "row long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    mined = _best(asked.cogroup(right).applyInArrow(_find_negatives(scale, negatives, low, high), schema), ["row", "place"], "negative_score", "negative_id", negatives, "rank")
    names = good.where("anchor").select("row", F.col("id").alias("anchor_id"))
    return mined.join(names, "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle_sql(positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> str:
    """The query in DuckDB SQL, every anchor by every row: for small tables with
    unique ids and vectors of one length."""
    return f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), each AS (
  SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM v
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, sum(a.x * b.x)::BIGINT AS score
  FROM each a JOIN each b USING (i) WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id
), scored AS (
  SELECT s.*, a.label = b.label AS same FROM s JOIN v a ON a.vec_id = s.anchor_id JOIN v b ON b.vec_id = s.id
), p AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {positives}
)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INT AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND {low} * p.score <= 100 * n.score AND 100 * n.score <= {high} * p.score
QUALIFY rank <= {negatives}
"""
