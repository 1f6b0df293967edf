"""Embedding near-duplicates by an exact pivot index.

A vector's home is its nearest pivot. A vector ``y`` with home ``q`` may link with
one at home at ``p`` only if

    cos(y, q) - cos(y, p) <= sqrt(1 - threshold ** 2) * |q - p|

(unit pivots; the hyperplane midway between p and q lies between the two vectors,
so y is no further from it than the angle of a link). ``y`` visits every pivot
below its own for which this holds. Every linked pair so meets in the list of the
smaller of its two homes, once: no link is missed, whatever the pivots are. On
clustered vectors few visits pass; on vectors without any structure nearly all do
and the join is one over all pairs of a label, which is what an exact answer takes.
The pivots are dealt to ``GROUPS`` lists by number, so a vector is listed
``GROUPS`` times at most. Pairs of a list with at least one vector at home there
are verified by cosine in double precision. Equal vectors (same label, same
components) are one class: they are indexed once with their count, so copies
never multiply.

Fitting uses a bounded sample: of the ``SAMPLE`` x ``n_pivots`` distinct usable
vectors with the smallest hash, taken in that order, a vector becomes a pivot if
its cosine to every earlier pivot is below ``PIVOT_COSINE``, up to ``n_pivots``.
A group of near copies, however large, so supplies one pivot and its members
agree on it and on the order of the others. Every vector is indexed.

A list is cut into chunks of at most about ``chunk`` vectors, those at home and the
visitors apart; a task joins a chunk of the former with itself or one other chunk,
so its memory is bounded however many vectors a list holds. Tasks return, per
linked vector, the count of its links and the smallest vector that the task's links
connect it with: a star per component, which joins all that the links join. Rows
grow with the list, not with its pairs.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, and one with a null label, links with nothing; vectors
of different length never link; a null vec_id gives a row with 0 links and a
null component; rows that repeat an id are vectors of their own that share the
id's node (their links add up); extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import materialize
from linecast.llm.components import connected_components

THRESHOLD = 0.93
N_PIVOTS = 256
#: Lists that the pivots of a label are dealt to.
GROUPS = 8
CHUNK = 2000
#: Rounding allowed for where cosines are compared.
SLACK = 1e-9
#: Vectors sampled per pivot, and the cosine that two pivots stay below.
SAMPLE = 16
PIVOT_COSINE = 0.8


def usable(rows: DataFrame) -> DataFrame:
    """(id, label, vec) of the vectors that can link."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(~bad & F.exists("vec", lambda x: x != 0))


def spread(sample: np.ndarray, most: int, cosine: float = PIVOT_COSINE) -> np.ndarray:
    """Rows of unit vectors ``sample``, in order, whose cosine to every row
    taken before is below ``cosine``; at most ``most``."""
    taken, nearest = [], np.full(len(sample), -np.inf)
    for i in range(len(sample)):
        if len(taken) == most:
            break
        if nearest[i] < cosine:
            taken.append(i)
            nearest = np.maximum(nearest, sample @ sample[i])
    return sample[taken]


def pivots(rows: DataFrame, n_pivots: int) -> dict[int, np.ndarray]:
    """Unit pivots by vector length; at most ``SAMPLE`` x ``n_pivots`` rows reach the driver."""
    picked = rows.orderBy(F.xxhash64("vec"), "node").select("vec").limit(SAMPLE * n_pivots).toArrow()["vec"]
    by_len: dict[int, list] = {}
    for v in picked:
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        by_len.setdefault(len(x), []).append(x / max(np.linalg.norm(x), 1e-300))
    return {n: spread(np.stack(v), n_pivots) for n, v in by_len.items()}


def describe(classes: DataFrame, found: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """One row per vector and list: (node, copies, label, vec, home, list); ``home``
    is the list of the nearest pivot, the others are those it visits."""
    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    sent = classes.sparkSession.sparkContext.broadcast(found)
    # Beyond a right angle the hyperplane tells nothing.
    reach = math.sqrt(1 - threshold ** 2) if 0 < threshold <= 1 else math.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {n: np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0)) for n, p in sent.value.items()}
        for b in batches:
            vec = [v.values.to_numpy(zero_copy_only=False).astype(np.float64) for v in b.column("vec")]
            length = np.array([len(v) for v in vec])
            # Vectors of a length without pivots share one list.
            homes, lists = np.full(len(vec), -1), [[-1]] * len(vec)
            for n in np.intersect1d(length, list(sent.value)):
                at = np.flatnonzero(length == n)
                p, x = sent.value[n], np.stack([vec[i] for i in at])
                cos = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)) @ p.T
                nearest = cos.argmax(axis=1)
                visited = cos.max(axis=1)[:, None] - cos <= reach * gaps[n][nearest] + SLACK
                group = np.arange(len(p)) * GROUPS // N_PIVOTS
                homes[at] = group[nearest]
                near = np.stack([visited[:, group == g].any(axis=1) for g in np.unique(group)], axis=1)
                for r, i in enumerate(at):
                    lists[i] = [*np.flatnonzero(near[r, :homes[i]]).tolist(), int(homes[i])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(homes, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], [*b.schema.names, "home", "lists"])

    named = classes.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in kind.items()) + ", home int, lists array<int>")
    return named.withColumn("list", F.explode("lists")).drop("lists")


def connect(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join, in place, the components of the positions ``a`` and ``b``, pair by
    pair; ``root`` holds every position's root, which is its own."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def _join_chunks(threshold: float):
    """Function of one task: the rows of one or two chunks of a list, the first of
    vectors at home -> (node, links, least): links counted and the smallest node
    of the component that the task's links make."""

    def task(key, rows):
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy().astype(np.int64)
        _, _, one, other = (k.as_py() for k in key)
        part = rows["part"].to_numpy()
        vec = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) for v in rows["vec"]]
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))
        length = np.array([len(v) for v in vec])
        for n in np.unique(length):
            left, right = np.flatnonzero((length == n) & (part == one)), np.flatnonzero((length == n) & (part == other))
            if not len(left) or not len(right):
                continue
            units = [np.stack([vec[i] for i in at]) for at in (left, right)]
            x, y = (u / np.linalg.norm(u, axis=1, keepdims=True) for u in units)
            for lo in range(0, len(left), 512):
                i, j = np.nonzero(x[lo:lo + 512] @ y.T >= threshold - SLACK)
                i += lo
                if one == other:
                    i, j = i[i < j], j[i < j]
                for k in range(0, len(i), 100_000):
                    a, b = i[k:k + 100_000], j[k:k + 100_000]
                    hit = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
                    a, b = left[a[hit]], right[b[hit]]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    connect(root, a, b)
        least = node.copy()
        np.minimum.at(least, root, node)
        least = least[root]
        got = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[got], pa.int64()), "links": pa.array(links[got], pa.int64()), "least": pa.array(least[got], pa.int64())})

    return task


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, n_pivots: int = N_PIVOTS, prefix: int | None = None, min_shared: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    ``prefix`` and ``min_shared`` belonged to an index that could miss links;
    they are accepted and change nothing."""
    # Floats travel as they come; cosines are taken in double precision.
    kind = "array<float>" if rows.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec"), F.col(label_col).alias("label"))
    good = usable(base)
    # Equal vectors are one class, named by its smallest id. -0.0 equals 0.0.
    plain = F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0).cast(kind[6:-1])).otherwise(x))
    good = good.select("id", "label", plain.alias("vec"))
    classes = materialize(good.groupBy("label", "vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "embedding-classes")

    listed = describe(classes.select("node", "copies", "label", "vec"), pivots(classes, n_pivots), threshold)
    own = F.col("home") == F.col("list")
    parts_of = lambda some: F.ceil(F.count(F.when(some, 1)) / chunk).cast("int")
    sizes = listed.groupBy("label", "list").agg(parts_of(own).alias("own_parts"), parts_of(~own).alias("visitor_parts"))
    chunks = F.when(own, F.col("own_parts")).otherwise(F.col("visitor_parts"))
    first = F.when(own, F.lit(0)).otherwise(F.col("own_parts"))
    last = F.col("own_parts") - 1 + F.when(own, F.col("visitor_parts")).otherwise(0)
    tasks = (
        listed.join(sizes.where("own_parts > 0"), ["label", "list"])
        .withColumn("part", (F.pmod(F.xxhash64("node"), chunks) + first).cast("int"))
        # A chunk of vectors at home meets itself and every other chunk of its list.
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other"))
        .select("label", "list", "x", "y", "part", "node", "copies", "vec")
    )
    found = materialize(
        tasks.groupBy("label", "list", "x", "y").applyInArrow(_join_chunks(threshold), "node long, links long, least long"),
        "embedding-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = (
        classes.join(links, "node", "left").join(component, "node", "left")
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    )
    linked = good.join(named, ["label", "vec"]).select("id", F.col("n").alias("n_links"), F.col("c").alias("component_id"))
    # Rows that share an id share its node.
    linked = linked.groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = base.select("id").join(linked, "id", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """``near_duplicates`` in DuckDB SQL, over all pairs of equal label: for
    small tables with unique ids and vectors of one length."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(vec, lambda x: x / norm) AS unit FROM (
    SELECT vec_id, label, embedding::DOUBLE[] AS vec, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  ) WHERE norm > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.unit, b.unit) >= {threshold}
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id)::BIGINT AS n_links, min(b)::BIGINT AS component_id, min(b) = e.vec_id AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""
