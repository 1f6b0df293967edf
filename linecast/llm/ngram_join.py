"""N-gram Jaccard self-join with signature trees, skew-safe.

A text's set holds the 64-bit hashes of its distinct ``k``-word shingles
(words: runs of characters other than ASCII white space, A-Z lower-cased; a
shorter text is one shingle). Two texts link when
100 * intersection >= percent * union. The result is the connected components
over all links. Every link is verified exactly; that one is missed is less
likely than 1e-10 (see 2.).

1. *Sets.* One pass hashes every whole text. Texts with equal sets are one
   class; only classes go on.
2. *Routing to trees.* Every class issues the bands of a similarity sketch as
   keys; enough of them that a pair at the threshold shares none with a
   probability under ``MISS`` (1e-10; less above the threshold). Classes that
   share a key, directly or over others, are one candidate group. A group over
   ``block_weight`` (a passage that many texts share can tie them together) is
   routed anew with longer bands, which tie only texts that are much alike.
3. *Signature trees.* Groups are dealt to blocks of about ``block_weight``
   shingles. Inside a block a tree is built over the sets: every node holds
   the OR of its sets' bitmaps, its size range and its hash-collision slack.
   A dual traversal prunes node pairs by size and by the greatest overlap that
   their bitmaps allow, and pairs that are already connected; what is left is
   decided by exact intersection.
4. *Large groups.* A group that is still over ``block_weight`` is salted over several
   blocks. Its blocks are joined inside, then their leaders among each other,
   until one component holds the bulk; what does not belong to the bulk is
   compared with every block of the group. No task holds more than two blocks.

Keys that repeat inside an Arrow batch are combined before the shuffle, so a
hot key costs a row per batch, not a row per document.

Defined results: null or empty text (or one without words) has an empty set,
links with nothing and is its own component; a row with a null id links with
nothing and has a null component; repeated rows are a class; every input row
gives one row; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linecast.llm.common import TABLE_BYTES, materialize, own_cache, table_bytes
from linecast.llm.components import connected_components

SHINGLE = 5
PERCENT = 80
BLOCK_WEIGHT = 2_000_000
#: Largest candidate list that is broadcast to filter texts; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 500_000

#: Rows of a band; of a band for groups that are too large.
ROWS, ROWS_LARGE = 8, 16
#: Probability that a pair at the threshold shares no band.
MISS = 1e-10

_BITS = 1 << 16
_LEAF, _FAN = 8, 4
_U = np.uint64
_word_hash: dict[bytes, int] = {}
_held_bytes = 0


def _forget() -> None:
    """Drop the table of word hashes."""
    global _held_bytes
    _word_hash.clear()
    _held_bytes = 0


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    global _held_bytes
    known = _word_hash
    own_cache("ngram_join", _forget)
    if _held_bytes > TABLE_BYTES:
        _forget()
    new = set(found).difference(known)
    for w in new:
        known[w] = xxhash.xxh3_64_intdigest(w)
    _held_bytes += table_bytes(new)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(k, len(h))
    acc = np.zeros(len(h) - size + 1, np.uint64)
    for j in range(size):
        acc = acc * _U(0x9E3779B97F4A7C15) + _mix(h[j:len(h) - size + 1 + j])
    return np.unique(_mix(acc + _U(size)))


# --- routing keys -------------------------------------------------------------


class Router:
    """Routing keys of sets: bands of ``rows`` places of a similarity sketch.

    The sketch throws the set's hashes into its places round after round until
    all are filled; a place keeps the smallest value of its first round. Two
    sets agree in a place with probability equal to their Jaccard similarity,
    and in a whole band with its ``rows``-th power. There are as many bands as
    make a miss of a pair at the threshold less likely than ``MISS``.
    """

    def __init__(self, percent: int, rows: int):
        self.percent, self.rows = percent, rows
        self.bands = math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows)))
        self.places = rows * self.bands
        self.tags = _mix(np.arange(self.bands, dtype=np.uint64) + _U(rows << 32))

    def sketch(self, h: np.ndarray) -> np.ndarray:
        out = np.full(self.places, np.iinfo(np.uint64).max, np.uint64)
        step = max(1, math.ceil(self.places * (math.log(self.places) + 2) / len(h)))
        for start in range(1, 1 << 24, step):
            rounds = np.arange(start, start + step, dtype=np.uint64)[:, None]
            x = _mix(h[None, :] ^ _mix(rounds))
            place = ((x >> _U(40)) * _U(self.places) >> _U(24)).astype(np.int64)
            np.minimum.at(out, place.ravel(), (rounds << _U(40) | x & _U((1 << 40) - 1)).ravel())
            if out.max() != np.iinfo(np.uint64).max:
                break
        return out

    def keys(self, h: np.ndarray) -> np.ndarray:
        """None for sets that can only link with equal ones."""
        if 2 * (100 * len(h) // self.percent) * (100 - self.percent) < 100 + self.percent:
            return np.zeros(0, np.uint64)
        acc = self.tags
        for column in self.sketch(h).reshape(self.bands, self.rows).T:
            acc = _mix(acc * _U(0x9E3779B97F4A7C15) + column)
        return acc


def _combine(nodes: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs of a batch in which each key occurs once. Rows that
    shared a key are tied to the key's smallest node by a key of their own."""
    flat = np.concatenate([*keys, np.zeros(0, np.uint64)])
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    order = np.lexsort((nodes[row], flat))
    flat, row = flat[order], row[order]
    first = np.ones(len(flat), bool)
    first[1:] = flat[1:] != flat[:-1]
    head = row[np.maximum.accumulate(np.where(first, np.arange(len(flat)), 0))] if len(flat) else row
    tied = ~first & (nodes[row] != nodes[head])
    pairs = np.unique(np.stack([row[tied], head[tied]]), axis=1)
    tie = _mix(nodes[pairs[0]].view(np.uint64) ^ _mix(nodes[pairs[1]].view(np.uint64) + _U(7)))
    return np.concatenate([row[first], pairs[0], pairs[1]]), np.concatenate([flat[first], tie, tie])


def _digests(h: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit digests of a set."""
    d = np.array([_mix(h ^ _U(0x1234567)).sum(dtype=np.uint64) + _U(len(h)), _mix(h ^ _U(0x89ABCDEF01)).sum(dtype=np.uint64)], np.uint64)
    d = _mix(d).view(np.int64)
    return int(d[0]), int(d[1])


def _sets(docs: DataFrame, k: int, percent: int, rows: int) -> DataFrame:
    """(id, n, d1, d2, keys) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router(percent, rows)
        for b in batches:
            size, keys, d1, d2 = [], [], [], []
            # Keys are combined over the whole batch; texts are Python objects one by one.
            for i, value in zip(b.column("id").to_pylist(), b.column("text")):
                h = shingles(value.as_py(), k)
                size.append(len(h))
                keys.append(router.keys(h) if i is not None else h[:0])
                x, y = _digests(h)
                d1.append(x)
                d2.append(y)
            row, key = _combine(np.array(d1, np.int64), keys)
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(len(size) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), lists], ["id", "n", "d1", "d2", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, d1 long, d2 long, keys array<long>")


# --- signature trees ------------------------------------------------------------


class Node:
    """A run [lo, hi) of sets: OR of their bitmaps, size range, slack. Leaves (one
    set) and the nodes over them keep bitmaps of about eight bits a shingle."""

    __slots__ = ("lo", "hi", "bits", "least", "most", "slack", "children")

    def __init__(self, lo, hi, bits, least, most, slack, children=()):
        self.lo, self.hi, self.bits, self.least, self.most, self.slack, self.children = lo, hi, bits, least, most, slack, children


def _places(h: np.ndarray) -> np.ndarray:
    return (h >> _U(13)) % _U(_BITS)


def signature(h: np.ndarray) -> tuple[np.ndarray, int]:
    """Bitmap of a set, and by how much its size exceeds the bits set."""
    bits = np.zeros(_BITS // 64, np.uint64)
    at = _places(h)
    np.bitwise_or.at(bits, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    return bits, len(h) - int(np.bitwise_count(bits).sum())


def _words(shingles: int) -> int:
    """Words of a bitmap of about eight bits a shingle: a power of two."""
    return min(_BITS // 64, 1 << max(0, (max(shingles, 1) - 1).bit_length() - 3))


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of ``words`` words (a power of two): places modulo its size."""
    return bits if len(bits) <= words else np.bitwise_or.reduce(bits.reshape(-1, words))


class Forest:
    """Signature tree over sets, and its dual traversal."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, outer: np.ndarray, percent: int):
        """``outer``: sets that are not compared among each other."""
        self.sets, self.label, self.outer, self.percent = sets, labels, outer, percent
        level = []
        for lo in range(0, len(sets), _LEAF * _FAN):
            hi = min(lo + _LEAF * _FAN, len(sets))
            parts = [self._bottom(i, min(i + _LEAF, hi)) for i in range(lo, hi, _LEAF)]
            c = [x for x, _, _ in parts]
            level.append(Node(lo, hi, np.bitwise_or.reduce([b for _, b, _ in parts]), min(x.least for x in c), max(x.most for x in c), max(s for _, _, s in parts), c))
        while len(level) > 1:
            level = [self._over(c, min(x.least for x in c), max(x.most for x in c)) for c in (level[i:i + _FAN] for i in range(0, len(level), _FAN))]
        self.root = level[0] if level else None

    def _bottom(self, lo: int, hi: int) -> tuple[Node, np.ndarray, int]:
        """Node over single sets, with the whole bitmap and slack for its parent:
        those live for the parent's making only."""
        sig = [signature(h) for h in self.sets[lo:hi]]
        size = [len(h) for h in self.sets[lo:hi]]
        leaves = [Node(i, i + 1, fold(b, _words(n)), n, n, slack) for i, n, (b, slack) in zip(range(lo, hi), size, sig)]
        folded = [fold(b, _words(sum(size))) for b, _ in sig]
        slack = max(n - int(np.bitwise_count(b).sum()) for n, b in zip(size, folded))
        node = Node(lo, hi, np.bitwise_or.reduce(folded), min(size), max(size), slack, leaves)
        return node, np.bitwise_or.reduce([b for b, _ in sig]), max(x for _, x in sig)

    @staticmethod
    def _over(children: list[Node], least: int, most: int) -> Node:
        bits = np.bitwise_or.reduce([c.bits for c in children])
        return Node(children[0].lo, children[-1].hi, bits, least, most, max(c.slack for c in children), children)

    def _same(self, a: Node, b: Node) -> bool:
        """All sets of both are connected already."""
        x = self.label[a.lo]
        return bool((self.label[a.lo:a.hi] == x).all() and (self.label[b.lo:b.hi] == x).all())

    def _most_common(self, a: Node, b: Node) -> int:
        """Bound of the shingles that a set of ``a`` and one of ``b`` share."""
        words = min(len(a.bits), len(b.bits))
        if a.children and b.children:
            # The slack of one side is enough; that of a folded bitmap is not known.
            slack = min(x.slack for x in (a, b) if len(x.bits) == words)
            return int(np.bitwise_count(fold(a.bits, words) & fold(b.bits, words)).sum()) + slack
        if a.children or b.children:
            # Shingles of the single set whose bit the other node holds.
            one, many = (b, a) if a.children else (a, b)
            at = _places(self.sets[one.lo]) % _U(64 * len(many.bits))
            return int(((many.bits[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1)).sum())
        x, y = fold(a.bits, words), fold(b.bits, words)
        set_x, set_y, both = (int(np.bitwise_count(z).sum()) for z in (x, y, x & y))
        return both + min(a.most - set_x, b.most - set_y)

    def _may_link(self, a: Node, b: Node) -> bool:
        p = self.percent
        if 100 * a.most < p * b.least or 100 * b.most < p * a.least:
            return False
        overlap = self._most_common(a, b)
        return overlap * (100 + p) >= p * (a.least + b.least)

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect sets not connected before; updates the labels."""
        stack = [(self.root, self.root)] if self.root else []
        while stack:
            a, b = stack.pop()
            if self.outer[a.lo:a.hi].all() and self.outer[b.lo:b.hi].all() or self._same(a, b):
                continue
            if a is b:
                c = a.children
                # Last in, first out: nearby pairs come first and connect what follows.
                stack += [(x, y) for i, x in reversed([*enumerate(c)]) for y in reversed(c[i + 1:])] + [(x, x) for x in c if x.children]
            elif self._may_link(a, b):
                if a.children or b.children:
                    split_a = bool(a.children) and (not b.children or a.hi - a.lo >= b.hi - b.lo)
                    stack += [(x, b) for x in a.children] if split_a else [(a, y) for y in b.children]
                    continue
                x, y = self.sets[a.lo], self.sets[b.lo]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common * (100 + self.percent) >= self.percent * (len(x) + len(y)):
                    yield a.lo, b.lo
                    old, new = sorted((self.label[a.lo], self.label[b.lo]), reverse=True)
                    self.label[self.label == old] = new


def _join_block(k: int, percent: int):
    """Function of one block: rows (rep, label, d1, d2, outer, cand, text) ->
    edges (a, b) between labels."""

    def block(rows):
        items, seen = [], set()
        for rep, label, d1, d2, outer, cand, text in zip(*(rows[c].to_pylist() for c in ("rep", "label", "d1", "d2", "outer", "cand", "text"))):
            h = shingles(text, k)
            # An id may stand for several texts; only the class's own text counts.
            if _digests(h) == (d1, d2) and (rep, d1, d2, outer) not in seen:
                seen.add((rep, d1, d2, outer))
                items.append((cand, len(h), int(h[0]), d1, label, outer, h))
        items.sort(key=lambda x: x[:4])
        labels = np.array([x[4] for x in items], np.int64)
        was = labels.copy()
        forest = Forest([x[6] for x in items], labels, np.array([x[5] for x in items], bool), percent)
        for _ in forest.links():
            pass
        changed = np.unique(np.stack([was, forest.label]), axis=1) if len(was) else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(changed[0], pa.int64()), "b": pa.array(changed[1], pa.int64())})

    return block


# --- the join ---------------------------------------------------------------------


def _with_texts(items: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """Items with the text of their representative."""
    small = F.broadcast(items) if rows <= BROADCAST_ROWS else items
    return docs.where(F.col("id").isNotNull()).join(small, docs["id"] == items["rep"]).select(*items.columns, "text")


def _blocks(items: DataFrame, k: int, percent: int) -> DataFrame:
    """Join inside every block; edges (a, b) between labels."""
    wanted = items.select("block", "rep", "label", "d1", "d2", "outer", "cand", "text")
    return wanted.groupBy("block").applyInArrow(_join_block(k, percent), "a long, b long")


def _groups(sets: DataFrame) -> DataFrame:
    """(node, component): candidate groups of classes that share keys, where a
    class goes by its first digest (a collision only enlarges a group)."""
    keyed = sets.where(F.size("keys") > 0).select(F.col("d1").alias("node"), F.explode("keys").alias("key"))
    smallest = F.min("node").over(Window.partitionBy("key"))
    return connected_components(keyed.withColumn("least", smallest).where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")))


def _split_large(items: DataFrame, docs: DataFrame, k: int, percent: int, block_weight: int) -> DataFrame:
    """Route the members of too large groups anew, with longer bands."""
    weight = items.groupBy("cand").agg(F.sum("n").alias("w")).where(F.col("w") > block_weight)
    large = materialize(items.join(weight, "cand").select(*items.columns), "ngram-large")
    rows = large.count()
    if not rows:
        return items
    texts = _with_texts(large, docs, rows).select(F.col("rep").alias("id"), "text")
    groups = _groups(materialize(_sets(texts, k, percent, ROWS_LARGE), "ngram-sets-large"))
    again = large.join(groups, large["d1"] == groups["node"]).select("rep", "d1", "d2", "n", F.col("component").alias("cand"))
    return materialize(items.join(weight, "cand", "left_anti").select(*items.columns).unionByName(again), "ngram-items")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT, block_weight: int = BLOCK_WEIGHT) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = materialize(_sets(narrow, k, percent, ROWS), "ngram-sets")
    linkable = sets.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = linkable.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.first("n").alias("n"))
    groups = _groups(sets)
    items = materialize(classes.join(groups, classes["d1"] == groups["node"]).select("rep", "d1", "d2", "n", F.col("component").alias("cand")), "ngram-items")
    items = _split_large(items, narrow, k, percent, block_weight)
    labels = _labels(items, narrow, k, percent, block_weight)

    named = (
        classes.join(labels.withColumnRenamed("rep", "_rep"), F.col("rep") == F.col("_rep"), "left")
        .select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.coalesce("label", "rep").alias("_component"))
    )
    empty = F.col("n") == 0
    out = sets.select("id", "n", "d1", "d2").join(named, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")), "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).when(empty, F.col("id")).otherwise(F.col("_component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.cast("long").alias("component_id"))


def _labels(items: DataFrame, docs: DataFrame, k: int, percent: int, block_weight: int) -> DataFrame:
    """(rep, label) of every item; the label is the smallest rep it is connected with."""
    rows = items.count()
    weight = items.groupBy("cand").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    total = weight.agg(F.sum("w")).first()[0] or 0
    buckets = max(1, -(-total // block_weight))
    sized = items.join(weight, "cand")
    hot = F.col("w") > block_weight
    shares = F.ceil(F.col("w") / block_weight)
    salt = F.pmod(F.xxhash64("rep", F.lit(1)), shares)
    block = F.when(hot, F.xxhash64("cand", salt)).otherwise(F.pmod(F.xxhash64("cand"), F.lit(buckets)))
    first = _with_texts(sized.select("rep", "d1", "d2", "cand", F.col("rep").alias("label"), F.lit(False).alias("outer"), block.alias("block")), docs, rows)
    edges = _blocks(first, k, percent)
    labels = connected_components(edges)

    large = materialize(sized.where(hot).select("rep", "d1", "d2", "n", "cand", "w"), "ngram-large")
    if not large.isEmpty():
        labels = _large_groups(large, labels, docs, k, percent, block_weight)
    return labels.select(F.col("node").alias("rep"), F.col("component").alias("label"))


def _relabel(items: DataFrame, labels: DataFrame) -> DataFrame:
    return items.join(labels, items["rep"] == labels["node"], "left").select(*[items[c] for c in items.columns], F.coalesce("component", "rep").alias("label"))


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    return connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(edges))


def _large_groups(large: DataFrame, labels: DataFrame, docs: DataFrame, k: int, percent: int, block_weight: int) -> DataFrame:
    """Complete the labels of groups that were salted over several blocks."""
    texts = materialize(_with_texts(large, docs, large.count()), "ngram-large-texts")
    left = None
    while True:  # leaders among each other, as long as that halves them
        now = materialize(_relabel(texts.drop("text"), labels), "ngram-leaders")
        leaders = now.where("rep = label")
        count = leaders.count()
        if left is not None and 2 * count > left:
            break
        left = count
        width = leaders.groupBy("cand").agg(F.sum("n").alias("lw"), F.count(F.lit(1)).alias("many")).where("many > 1")
        block = F.xxhash64("cand", F.pmod(F.xxhash64("rep", F.lit(left)), F.ceil(F.col("lw") / block_weight)))
        dealt = leaders.drop("w").join(width, "cand").select("rep", "d1", "d2", "cand", "label", F.lit(False).alias("outer"), block.alias("block"))
        labels = _merged(labels, _blocks(dealt.join(texts.select(F.col("rep").alias("_rep"), "text"), F.col("rep") == F.col("_rep")).drop("_rep"), k, percent))

    # The bulk of a group is its heaviest label; all else meets every block.
    by_label = now.groupBy("cand", "label").agg(F.sum("n").alias("lw"))
    bulk = by_label.groupBy("cand").agg(F.max(F.struct("lw", "label")).alias("m"), F.sum("lw").alias("w"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    bulk = bulk.select("cand", F.col("m.label").alias("bulk"), F.ceil(F.col("w") / block_weight).alias("shares"), F.ceil((F.col("w") - F.col("m.lw")) / block_weight).alias("chunks"))
    open_ = now.drop("w").join(bulk, "cand").withColumn("h", F.xxhash64("rep", F.lit(3)))
    inner = open_.where("label != bulk").withColumn("chunk", F.pmod("h", "chunks")).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    outer = open_.withColumn("share", F.pmod("h", "shares")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pick = lambda d, flag: d.select("rep", "d1", "d2", "cand", "label", F.lit(flag).alias("outer"), F.xxhash64("cand", F.col("chunk").cast("long"), F.col("share").cast("long")).alias("block"))
    dealt = pick(inner, False).unionByName(pick(outer, True))
    edges = _blocks(dealt.join(texts.select(F.col("rep").alias("_rep"), "text"), F.col("rep") == F.col("_rep")).drop("_rep"), k, percent)
    return _merged(labels, edges)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, one document per group of linked texts: the one with
    the smallest id. Rows without an id all stay.

    Where ids repeat, rows are told apart by numbers of their own, so a row goes
    only if its own text is in another row's group."""
    if docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty():
        joined = ngram_join(docs, id_col, text_col, **options)
        gone = joined.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone"))
        return _without(docs, materialize(gone, "ngram-gone"), id_col)
    row = "_row"
    while row in docs.columns:
        row += "_"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "ngram-numbered")
    named = numbered.where(F.col(id_col).isNotNull())
    groups = materialize(ngram_join(named, row, text_col, **options).select(F.col(row).alias("_n"), F.col("component_id").alias("_group")), "ngram-groups")
    ids = groups.join(named.select(F.col(row).alias("_m"), F.col(id_col).alias("_id")), F.col("_n") == F.col("_m"))
    first = ids.groupBy("_group").agg(F.min(F.struct("_id", "_n")).alias("_first")).select(F.col("_first._n").alias("_stays"))
    gone = groups.join(first, F.col("_n") == F.col("_stays"), "left_anti").select(F.col("_n").alias("_gone"))
    return _without(numbered, materialize(gone, "ngram-gone"), row).drop(row)


def _without(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is not in column ``_gone``; broadcast by counted size."""
    small = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(small, docs[id_col] == small["_gone"], "left_anti")


def oracle_sql(k: int, percent: int) -> str:
    """``ngram_join`` in DuckDB SQL, over all pairs that share a shingle: for small tables with unique ids."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    gram = " || ' ' || ".join(f"words[i + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), g AS (
  SELECT doc_id, {gram} AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - {k - 2})) AS i FROM w WHERE len(words) >= {k})
  UNION SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND {k - 1}
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING count(*) * {100 + percent} >= {percent} * (x.n + y.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b)::BIGINT AS component_id
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""
