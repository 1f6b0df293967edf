"""Language identification by prediction by partial matching.

Each language gets a variable-order byte context tree: for every context of up
to ``ORDER`` bytes the counts of the bytes that follow it. A byte unseen in a
context costs that context's escape (method C: distinct / (total + distinct))
and is then coded in the next shorter context, at last uniformly over 256
values. The statistics are frozen after training, so the code length of a
word, coded from the blank before it to the blank after it, is a fixed number
per language, and the code length of a text is the exact sum over its words.

Texts are lower-cased; ASCII characters that are not letters separate words.
The predicted language is the one with the shortest code; its score is the
posterior 2^-bits / sum(2^-bits) over the learned languages.

The trees are learned from at most ``max_docs_per_lang`` documents of each
language (the smallest by hash of the id; whole texts) and of the
``max_langs`` most frequent languages. These bounds also bound the model,
which is sent to the executors. Scoring covers every whole text.

Defined results: null text, or text without a letter, gives ``und`` with score
0; with no learned language every text gives ``und``; ties go to the language
that sorts first; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linecast.llm.common import ENTRY_BYTES, TABLE_BYTES, own_cache, slices, table_bytes

ORDER = 4
MAX_DOCS_PER_LANG = 300
MAX_LANGS = 1000

_FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Coded:
    """The bytes of a list of words as coded symbols with their contexts.

    ``b" w1 w2 ... wn "``: a word's symbols are its bytes and the blank after
    it; its contexts reach back to the blank before it.
    """

    def __init__(self, found: list[bytes]):
        self.data = np.frombuffer(b" " + b" ".join(found) + b" ", np.uint8).astype(np.int64)
        at = np.arange(len(self.data))
        blank = np.maximum.accumulate(np.where(self.data == 32, at, 0))
        self.known = at[1:] - blank[:-1]  # context bytes there are for symbol i + 1
        ends = np.flatnonzero(self.data[1:] == 32)
        self.starts = np.concatenate([[0], ends[:-1] + 1]) if len(found) else np.zeros(0, np.int64)
        self.word = np.repeat(np.arange(len(found)), np.diff(np.concatenate([self.starts, [len(self.known)]])) if len(found) else 0)

    def contexts(self, order: int, at: np.ndarray) -> np.ndarray:
        """Key of the context of ``order`` bytes before each symbol ``at``."""
        key = np.full(len(at), order, np.int64)
        for o in range(order, 0, -1):
            key = key << 8 | self.data[at + 1 - o]
        return key

    def symbols(self, context: np.ndarray, at: np.ndarray) -> np.ndarray:
        return context << 8 | self.data[at + 1]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


class Model:
    """Context trees of all languages, flattened by order.

    ``symbols[o]``: sorted keys (context of o bytes, next byte) seen in any
    language, with the bits of that byte in every language, escapes to shorter
    contexts included. ``escapes[o]``: sorted context keys with the bits of an
    escape in every language (0 where the language lacks the context).
    """

    def __init__(self, counts: dict[str, dict[bytes, int]], order: int = ORDER):
        self.langs, self.order, self.token = sorted(counts), order, uuid.uuid4().hex
        self.symbols: list[tuple[np.ndarray, np.ndarray]] = []
        self.escapes: list[tuple[np.ndarray, np.ndarray]] = []
        n_langs = len(self.langs)
        parts = [Coded(list(counts[x])) for x in self.langs]
        weights = [np.fromiter(counts[x].values(), np.float64, len(counts[x])) for x in self.langs]
        for o in range(order + 1):
            keys, n, lang = [], [], []
            for k, (c, w) in enumerate(zip(parts, weights)):
                at = np.flatnonzero(c.known >= o)
                keys.append(c.symbols(c.contexts(o, at), at))
                n.append(w[c.word[at]])
                lang.append(np.full(len(at), k))
            if not keys:
                break
            sym, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            count = np.bincount(inverse * n_langs + np.concatenate(lang), np.concatenate(n), len(sym) * n_langs).reshape(len(sym), n_langs)
            ctx, of = np.unique(sym >> 8, return_inverse=True)
            total, distinct = np.zeros((len(ctx), n_langs)), np.zeros((len(ctx), n_langs))
            np.add.at(total, of, count)
            np.add.at(distinct, of, count > 0)
            escape = np.log2((total + distinct) / np.maximum(distinct, 1), where=distinct > 0, out=np.zeros_like(total))
            seen = np.log2((total + distinct)[of] / np.maximum(count, 1), where=count > 0, out=np.zeros_like(count))
            if o:
                tail = (o - 1) << 8 * o | sym & ((1 << 8 * o) - 1)
                shorter = self.symbols[o - 1][1][_find(self.symbols[o - 1][0], tail)[0]]
            else:
                shorter = np.full_like(seen, 8.0)
            self.symbols.append((sym, np.where(count > 0, seen, escape[of] + shorter)))
            self.escapes.append((ctx, escape))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def forget(self) -> None:
        """Drop the table of word code lengths."""
        self.__dict__.pop("_row", None)
        self.__dict__.pop("_table", None)

    def code_lengths(self, found: list[bytes]) -> np.ndarray:
        """Bits of each word in each language."""
        c = Coded(found)
        bits = np.zeros((len(c.known), len(self.langs)))
        open_ = np.arange(len(c.known))
        for o in range(self.order, -1, -1):
            mine = c.known[open_] >= o
            at = open_[mine]
            ctx = c.contexts(o, at)
            k, hit = _find(self.symbols[o][0], c.symbols(ctx, at))
            bits[at[hit]] += self.symbols[o][1][k[hit]]
            k, has = _find(self.escapes[o][0], ctx)
            has &= ~hit
            bits[at[has]] += self.escapes[o][1][k[has]]
            open_ = np.concatenate([open_[~mine], at[~hit]])
        bits[open_] += 8.0
        return np.add.reduceat(bits, c.starts) if len(found) else bits[:0]

    def bits(self, texts: list[list[bytes]]) -> np.ndarray:
        """Code length of each text (as words) in each language."""
        own_cache(self.token, self.forget)
        if not hasattr(self, "_row") or self._held > TABLE_BYTES:
            self._row: dict[bytes, int] = {}
            self._held = 0
            self._table = np.zeros((0, len(self.langs)))
        new = list({w for t in texts for w in t}.difference(self._row))
        if new:
            rows = [self.code_lengths(new[i:i + 50_000]) for i in range(0, len(new), 50_000)]
            self._row.update(zip(new, range(len(self._row), len(self._row) + len(new))))
            self._table = np.concatenate([self._table, *rows])
            self._held += table_bytes(new, ENTRY_BYTES + 8 * len(self.langs))
        out = np.zeros((len(texts), len(self.langs)))
        for i, t in enumerate(texts):
            out[i] = self._table[np.fromiter(map(self._row.__getitem__, t), np.int64, len(t))].sum(axis=0)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        scored = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        for k in range(0, len(scored), 500):
            ids = scored[k:k + 500]
            bits = self.bits([words(texts[i]) for i in ids])
            best = bits.argmin(axis=1)
            score = 1.0 / np.exp2(bits.min(axis=1)[:, None] - bits).sum(axis=1)
            for i, b, s in zip(ids, best, score):
                out[i] = (self.langs[b], float(s))
        return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs_per_lang: int = MAX_DOCS_PER_LANG, max_langs: int = MAX_LANGS, order: int = ORDER) -> Model:
    """Learn the trees from the rows of ``labelled`` with a language.

    Spark picks the sample and counts its words; the driver receives word
    counts of at most ``max_docs_per_lang`` documents per language.
    """
    rows = (
        labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    )
    # A language's share of the hash range that holds about 8 times the wanted
    # documents goes on, so what is ranked stays small at every input size.
    # Broadcast: at most max_langs rows.
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), "lang").limit(max_langs)
    low = F.shiftrightunsigned(F.xxhash64("id"), 11) < F.least(F.lit(1.0), F.lit(8.0 * max_docs_per_lang) / F.col("docs")) * float(1 << 53)
    first = Window.partitionBy("lang").orderBy(F.shiftrightunsigned(F.xxhash64("id"), 11), "id", "text")
    sample = rows.join(F.broadcast(langs), "lang").where(low).withColumn("n", F.row_number().over(first)).where(F.col("n") <= max_docs_per_lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, bytes], int] = defaultdict(int)
        for b in slices(batches):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                for w in words(text):
                    n[lang, w] += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n]), pa.array([k[1] for k in n], pa.binary()), pa.array(list(n.values()), pa.int64())], ["lang", "word", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    by_lang: dict[str, dict[bytes, int]] = defaultdict(dict)
    for lang, word, n in zip(*(counted.column(c).to_pylist() for c in ("lang", "word", "n"))):
        by_lang[lang][word] = n
    return Model(dict(by_lang), order)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches):
            got = m.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["id", "lang_pred", "score"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", min_score: float = 0.0) -> DataFrame:
    """The rows whose language is identified (not ``und``; with ``min_score``, a
    posterior of at least that), all columns kept, ``lang_col`` set to the
    prediction."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches):
            got = m.predict(b.column(text_col).to_pylist())
            cols, i = list(b.columns), b.schema.get_field_index(lang_col)
            cols[i] = pa.array([x[0] for x in got], b.schema.field(i).type)
            kept = pa.array([x[0] != "und" and x[1] >= min_score for x in got], pa.bool_())
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema).filter(kept)

    return docs.mapInArrow(run, docs.schema)
