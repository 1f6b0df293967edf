"""Best-fit packing with a grouping genetic algorithm on islands.

Documents become token sequences (token ids, then one separator id); only
those longer than ``capacity`` are cut, into pieces of ``capacity`` and a
last, shorter one. The pieces are packed into as few sequences as possible.

*Grouping genetic algorithm.* An individual is a list of bins. Crossover
injects the well-filled bins of one parent into the other, drops the receiving
parent's bins that hold an injected document, and best-fits the documents so
displaced. Mutation empties a few of the worst bins and best-fits their
documents. Fitness is the mean of squared fill, which prefers full bins.

*Islands.* Pieces are dealt to islands by a hash, about ``island_size`` each.
Each island evolves its own population (seeded by its number, so retries
agree) and stops early at the lower bound ceil(sum / capacity). After an epoch
the elite's well-filled bins are final; its remaining bins migrate, as whole
bins, to the fewer islands of the next epoch, whose first individual they are.
From epoch ``patience`` on only an island's poorest bins migrate, so that lengths
that never fill a bin well end too. Epochs end when one island is left (or when
three of them leave as many pieces as they found), so the work is spread over
the cluster and no task holds more than an island.

*Tokenizing.* The vocabulary's own model encodes one pre-token at a time;
results are kept per word (a table bounded in bytes), so repeated words cost a lookup.
Splitting at ASCII white space first is exact, because the pre-tokenizer drops
white space and no rule reaches across it.

Defined results: null or empty text is the separator alone (one piece of
length 1); an empty table gives an empty table; repeated rows are packed as
rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import ENTRY_BYTES, materialize, own_cache, slices, table_bytes

CAPACITY = 2048
SEPARATOR = 0
ISLAND_SIZE = 2048
POPULATION = 6
GENERATIONS = 24
#: From this epoch on an island passes on only its ``POOREST`` bins, so that islands end in one.
PATIENCE, POOREST = 4, 2
#: Memory that both generations of the word tables may take in a Python worker.
WORD_BYTES = 64 << 20
#: A bin this full is final after an epoch.
WELL_FILLED = 0.999

_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Latin letters that normalization to NFC leaves as they are and whose lower case is one letter.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_encoders: dict[str, "WordEncoder"] = {}


def _byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    _PRE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pre = regex.compile(self._PRE)
        self.chars = _byte_characters()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.held = 0
        special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(re.escape(t.encode()) for t in special) or b"(?!)")
        self.plain = re.compile(f"([{_LATIN}]+)([{re.escape(_MARKS)}]*)").fullmatch
        # Whether a word of letters and marks can hold a special string.
        self.plain_special = any(re.fullmatch(f"[{_LATIN}]*[{re.escape(_MARKS)}]*", t) for t in special)

    def forget(self) -> None:
        """Drop the tables of word and pre-token ids."""
        for table in (self.words, self.parts, self.old_words, self.old_parts):
            table.clear()
        self.held = 0

    def _age(self) -> None:
        """Start new tables; the present ones stay as the old ones, from which
        words in use move over, so only those not met for a while are lost."""
        self.old_words, self.words = self.words, {}
        self.old_parts, self.parts = self.parts, {}
        self.held = 0

    def _ids(self, part: str) -> bytes:
        if not (part.isascii() and part.isprintable()):
            part = part.encode("utf-8").decode("latin-1").translate(self.chars)
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def _letters(self, letters: str) -> bytes:
        """Ids of lower-case letters, which are a word of their own in the table."""
        word = letters.encode()
        ids = self.words.get(word)
        if ids is None:
            ids = self.words[word] = self.old_words.pop(word, None) or self._ids(letters)
            self.held += ENTRY_BYTES + 2 * len(word)
        return ids

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.old_parts.pop(part, None)
            if ids is None:
                ids = self._ids(part)
            self.parts[part] = ids
            self.held += ENTRY_BYTES + 2 * len(part)
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        plain = self.plain(text)
        if plain and not self.plain_special:
            # Letters, then a run of marks without an apostrophe: two pre-tokens at most.
            letters, marks = plain.groups()
            low = letters.lower()
            if marks:
                return self._letters(low) + self._part(marks)
            return self._ids(low) if low == letters else self._letters(low)
        if word.isascii() and not self.special.search(word):
            return b"".join(map(self._part, self.pre.findall(text.lower())))
        low = unicodedata.normalize("NFC", text)
        if self.special.search(word) or not low.replace("İ", "").isprintable() or any(c in low for c in "İΣ"):
            # Special strings, unusual characters: the tokenizer as a whole.
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._part, self.pre.findall(low.lower())))

    def encode(self, text: str) -> bytes:
        if 2 * self.held > WORD_BYTES:
            self._age()
        known, old = self.words, self.old_words
        found = text.encode("utf-8").split()
        new = set(found).difference(known)
        for w in new:
            known[w] = old.pop(w, None) or self._word(w)
        self.held += table_bytes(new)
        return b"".join(map(known.__getitem__, found))


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and with
    ``with_ids`` the token ids themselves. ``vocabulary`` is the file's path."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        own_cache(("packing", vocabulary), enc.forget)
        for b in slices(batches):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                data = (enc.encode(text) if text else b"") + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [b.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


# --- the genetic algorithm, on the lengths of one island ---------------------

Bins = list[list[int]]


def fill(b: list[int], size: list[int]) -> int:
    return sum(map(size.__getitem__, b))


def best_fit(bins: Bins, items: Iterable[int], size: list[int], capacity: int, in_order: bool = False) -> Bins:
    """Put each item, longest first (``in_order``: as they come), into the
    fullest bin that still takes it."""
    out = [list(b) for b in bins]
    free = sorted((capacity - fill(b, size), k) for k, b in enumerate(out))
    for i in items if in_order else sorted(items, key=lambda i: (-size[i], i)):
        n = size[i]
        at = bisect.bisect_left(free, (n, -1))
        if at < len(free):
            room, k = free.pop(at)
            out[k].append(i)
        else:
            k, room = len(out), capacity
            out.append([i])
        bisect.insort(free, (room - n, k))
    return out


class Individual:
    """Bins, fullest first, and their fitness: fewest bins, then the mean of squared fill."""

    def __init__(self, bins: Bins, size: list[int], capacity: int):
        fills = [fill(b, size) for b in bins]
        order = sorted(range(len(bins)), key=lambda k: (-fills[k], k))
        self.bins = [bins[k] for k in order]
        self.fitness = (-len(bins), sum((f / capacity) ** 2 for f in fills) / max(len(fills), 1))


def crossover(giver: Individual, taker: Individual, size: list[int], capacity: int, rng: random.Random) -> Individual:
    """Inject the giver's fullest bins whole; best-fit what they displace."""
    full = giver.bins[: max(1, int(len(giver.bins) * rng.uniform(0.5, 0.95)))]
    inside = {i for b in full for i in b}
    kept, displaced = [], []
    for b in taker.bins:
        if inside.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in inside]
    return Individual(best_fit(full + kept, displaced, size, capacity), size, capacity)


def mutate(parent: Individual, size: list[int], capacity: int, rng: random.Random) -> Individual:
    """Empty the worst bins and a few others; best-fit their documents in random halves."""
    n = len(parent.bins)
    some = set(range(max(0, n - 2 - rng.randrange(3)), n)) | {rng.randrange(n) for _ in range(3)}
    loose = [i for k in sorted(some) for i in parent.bins[k]]
    rng.shuffle(loose)
    bins = best_fit([b for k, b in enumerate(parent.bins) if k not in some], loose[: len(loose) // 2], size, capacity)
    return Individual(best_fit(bins, loose[len(loose) // 2:], size, capacity), size, capacity)


def evolve(size: list[int], migrants: Bins, seed: int, capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS) -> Bins:
    """Pack items 0..n-1; ``migrants``: the bins they came in, or empty."""
    n = len(size)
    bound = -(-sum(size) // capacity)
    people = [Individual(best_fit([], range(n), size, capacity), size, capacity)]
    if migrants:
        people.append(Individual(migrants, size, capacity))
    if n >= 3 and -max(p.fitness for p in people)[0] > bound:
        rng = random.Random(seed)
        while len(people) < population:
            # Best fit in orders that are longest first only roughly: parents that differ.
            noise = [rng.uniform(0.5, 1.0) for _ in range(n)]
            order = sorted(range(n), key=lambda i: (-size[i] * noise[i], i))
            people.append(Individual(best_fit([], order, size, capacity, in_order=True), size, capacity))
        for _ in range(generations):
            people.sort(key=lambda p: p.fitness, reverse=True)
            if -people[0].fitness[0] <= bound:
                break
            a, b = people[rng.randrange(2)], people[rng.randrange(1, len(people))]
            people += [crossover(a, b, size, capacity, rng), crossover(b, a, size, capacity, rng), mutate(people[0], size, capacity, rng)]
            people = sorted(people, key=lambda p: p.fitness, reverse=True)[:population]
    return max(people, key=lambda p: p.fitness).bins


def _island(id_col: str, epoch: int, last: bool, poorest: int | None, capacity: int, seed: int):
    """The function that packs one island's rows in one epoch; with ``poorest``
    all but so many bins are final."""

    def island(key, rows):
        rows = rows.drop_columns(["_island"])
        rows = rows.sort_by([("sequence_id", "ascending"), ("length", "descending"), ("_h", "ascending"), ("ids_crc32", "ascending"), ("start", "ascending")])
        size, came = rows["length"].to_pylist(), rows["sequence_id"].to_pylist()
        migrants: dict[int, list[int]] = {}
        for i, k in enumerate(came):
            if k is not None:
                migrants.setdefault(k, []).append(i)
        number = key[0].as_py()
        bins = evolve(size, list(migrants.values()), seed * 1_000_003 + 131 * epoch + number, capacity)
        bin_of, offset, final = [0] * len(size), [0] * len(size), [False] * len(size)
        for k, b in enumerate(bins):
            # Bins come fullest first.
            at, done = 0, last or fill(b, size) >= WELL_FILLED * capacity or poorest is not None and k < len(bins) - poorest
            for i in b:
                # A bin's number is unique over epochs, islands and bins.
                bin_of[i], offset[i], final[i] = (epoch << 58) + (number << 20) + k, at, done
                at += size[i]
        rows = rows.drop_columns(["sequence_id"])
        return rows.append_column("sequence_id", pa.array(bin_of, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).append_column("final", pa.array(final, pa.bool_()))

    return island


def pack(cut: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, island_size: int = ISLAND_SIZE, patience: int = PATIENCE, seed: int = 7) -> DataFrame:
    """``cut`` (rows of ``pieces``, lengths up to ``capacity``) -> the same rows
    with ``sequence_id`` and ``offset``."""
    columns = [id_col, "piece", "start", "length", "ids_crc32"]
    cut = materialize(cut.select(*columns), "packing-pieces")
    kind = cut.schema[id_col].dataType.simpleString()
    full = F.col("length") >= capacity
    # A full piece is a sequence of its own; its number is negative.
    out = cut.where(full).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = cut.where(~full).select(*columns, F.xxhash64(F.lit(seed), *columns).alias("_h"), F.lit(None).cast("long").alias("sequence_id"))
    fields = f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long, _h long, sequence_id long, offset long, final boolean"

    before, stalled = None, 0
    for epoch in itertools.count():
        left = todo.count()
        islands = max(1, -(-left // island_size))
        stalled = stalled + 1 if before is not None and left >= before else 0
        before = left
        # Islands whose bins hold most of their pieces each cannot get fewer: they end apart.
        last = islands == 1 or stalled == 3
        poorest = POOREST if epoch >= patience else None
        # Rows are dealt one by one at first (equal rows must not meet in one island), then bin by bin.
        mark = F.xxhash64(F.lit(epoch), "sequence_id") if epoch else F.xxhash64("_h", F.monotonically_increasing_id())
        deal = F.pmod(mark, F.lit(islands)).cast("long")
        packed = materialize(todo.withColumn("_island", deal).groupBy("_island").applyInArrow(_island(id_col, epoch, last, poorest, capacity, seed), fields), f"packing-epoch{epoch}")
        out = out.unionByName(packed.where("final").select(*columns, "sequence_id", "offset"))
        if last:
            break
        todo = packed.where(~F.col("final")).select(*columns, "_h", "sequence_id")
    return out
