"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors: one per word, one per character
3- and 4-gram of the word between boundary marks and one per word 2-gram, all
hashed into ``BUCKETS`` rows. 2-grams of a word with itself share one bucket,
which generalises over the words that repetitive texts repeat. A softmax layer turns the average into class probabilities.
Embeddings and output layer are trained together by stochastic gradient
descent in numpy (AdaGrad steps, one document at a time, seeded order).

*Training* uses at most ``max_train_docs`` labelled documents (those with the
smallest hash of the id; whole texts). Executors turn them into sparse feature
rows; the driver receives only those rows, so its memory is bounded by that
parameter. *Scoring* covers every whole text and every n-gram of a word, however
long the word (texts written without blanks are one word). The average and the layer are
linear, so a word's share of the logit is a constant: it is computed once per
distinct word and worker, and the score equals the full forward pass.

Defined results: null and empty text has no features and scores the layer's
bias alone; without any training row every score is 0.5; null labels and
labels of unknown documents are not used; an id labelled twice counts with its
smaller label; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import ENTRY_BYTES, TABLE_BYTES, own_cache, slices, table_bytes

BUCKETS = 1 << 17
DIM = 8
MAX_TRAIN_DOCS = 2000
EPOCHS = 8
STEP = 0.5
GRAMS = (3, 4)
#: The bucket of a word's 2-gram with itself.
SAME = 0
#: Bytes of new words whose features are held at a time (a longer word is alone).
BLOCK = 1 << 20


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def features(word: bytes) -> array:
    """Buckets of a word and of all its character n-grams."""
    out = array("i", [zlib.crc32(word) % BUCKETS])
    s = "<" + word.decode("utf-8", "surrogatepass") + ">"
    for n in GRAMS:
        out.extend(zlib.crc32(s[i:i + n].encode("utf-8", "surrogatepass"), n) % BUCKETS for i in range(len(s) - n + 1))
    return out


def blocks(new: list[bytes]) -> Iterator[list[bytes]]:
    """The words in order, in lists of about ``BLOCK`` bytes."""
    some, size = [], 0
    for w in new:
        some.append(w)
        size += len(w)
        if size >= BLOCK:
            yield some
            some, size = [], 0
    if some:
        yield some


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the word 2-grams, given the words' hashes in order."""
    a, b = hashes[:-1], hashes[1:]
    return np.where(a == b, SAME, (a * 2_654_435_761 + b * 40_503 >> 7) % BUCKETS)


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of the average.

    Words with their subwords take one half of the average and the 2-grams the
    other (a text of one word has no 2-gram: words take it all).
    """
    found = words(text)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    known = {w: features(w) for w in set(found)}
    single = np.concatenate([np.frombuffer(known[w], np.int32) for w in found])
    pairs = bigrams(np.array([zlib.crc32(w) for w in found], np.int64))
    half = 0.5 if len(pairs) else 1.0
    share = np.concatenate([np.full(len(single), half / len(single)), np.full(len(pairs), 0.5 / max(len(pairs), 1))])
    buckets, inverse = np.unique(np.concatenate([single, pairs]), return_inverse=True)
    return buckets, np.bincount(inverse, share).astype(np.float32)


class Model:
    """Trained embeddings and output layer, as used for scoring: the logit
    that each bucket adds, and the bias."""

    def __init__(self, logit: np.ndarray, bias: float):
        self.logit, self.bias, self.token = logit, bias, uuid.uuid4().hex

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def forget(self) -> None:
        """Drop the table of word logits."""
        for name in ("_row", "_sum", "_n", "_hash"):
            self.__dict__.pop(name, None)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1 for each text."""
        own_cache(self.token, self.forget)
        if not hasattr(self, "_row") or self._held > TABLE_BYTES:
            self._row: dict[bytes, int] = {}
            self._held = 0
            self._sum, self._n, self._hash = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        row, out = self._row, np.full(len(texts), self.bias)
        found = [words(t) for t in texts]
        new = list({w for f in found for w in f}.difference(row))
        if new:
            sums, sizes = [], []
            for some in blocks(new):
                feats = [features(w) for w in some]
                size = np.array([len(f) for f in feats])
                flat = np.concatenate([np.frombuffer(f, np.int32) for f in feats])
                sums.append(np.add.reduceat(self.logit[flat], np.cumsum(size) - size))
                sizes.append(size)
            self._held += table_bytes(new, ENTRY_BYTES + 24)
            row.update(zip(new, range(len(row), len(row) + len(new))))
            self._sum = np.concatenate([self._sum, *sums])
            self._n = np.concatenate([self._n, *sizes])
            self._hash = np.concatenate([self._hash, np.fromiter(map(zlib.crc32, new), np.int64, len(new))])
        for i, f in enumerate(found):
            if f:
                at = np.fromiter(map(row.__getitem__, f), np.int64, len(f))
                pairs = self.logit[bigrams(self._hash[at])]
                single = self._sum[at].sum() / self._n[at].sum()
                out[i] += (single + pairs.mean()) / 2 if len(pairs) else single
        return 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, step: float = STEP, dim: int = DIM, seed: int = 11) -> Model:
    """``rows``: (label, buckets, shares)."""
    if not rows:
        return Model(np.zeros(BUCKETS), 0.0)
    rng = np.random.default_rng(seed)
    emb = (rng.uniform(-1, 1, (BUCKETS, dim)) / dim).astype(np.float32)
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    seen, out_seen, bias_seen = np.full((BUCKETS, dim), 1e-8, np.float32), np.full((dim, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, ids, share = rows[k]
            e = emb[ids]
            h = share @ e
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1.0
            g_out, g_emb = np.outer(h, p), np.outer(share, out @ p)
            out_seen += g_out**2
            bias_seen += p**2
            seen[ids] += g_emb**2
            out -= step * g_out / np.sqrt(out_seen)
            bias -= step * p / np.sqrt(bias_seen)
            emb[ids] = e - 0.1 * step * g_emb / np.sqrt(seen[ids])
    toward = out[:, 1] - out[:, 0]
    return Model((emb @ toward).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Train on the documents that ``labels`` (id, label 0/1) marks."""
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_train_docs)
    )
    # Broadcast: at most max_train_docs rows of two numbers.
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(marked), "id")
    # Rows that repeat an id count once, by their smallest text.
    joined = joined.groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [vector(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array([x[0].astype(np.int32) for x in got], pa.list_(pa.int32())), pa.array([x[1] for x in got], pa.list_(pa.float32()))], ["label", "ids", "share"])

    rows = joined.mapInArrow(run, "label int, ids array<int>, share array<float>").toArrow()
    got = [(label, ids.values.to_numpy().astype(np.int64), share.values.to_numpy()) for label, ids, share in zip(rows["label"].to_pylist(), rows["ids"], rows["share"]) if len(ids.values)]
    # A fixed order, whatever order the partitions came in.
    got.sort(key=lambda r: (r[0], zlib.crc32(r[1].tobytes()), zlib.crc32(r[2].tobytes())))
    return train(got)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``score``, the probability of class 1."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            got = [m.score(texts[i:i + 500]) for i in range(0, len(texts), 500)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.concatenate(got) if got else [], pa.float64())], ["id", "score"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
