"""Vectorised words against bytes.split()."""

import random

import numpy as np
import pyarrow as pa
import pytest

from linecast.llm import wordhash
from linecast.llm.wordhash import Words, mix, rolling, text_slices

TEXTS = ["", "one", " one  two\n", None, "日本 テスト\tx", "\x0b\x0c\r", "a" * 50, "tail", "x\x1fy z\x85w", "one two one"]


def plain(texts, fold=False):
    return [[w.lower() if fold else w for w in (t or "").encode().split()] for t in texts]


@pytest.mark.parametrize("chunk", [16, 64, 1 << 18])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_are_those_of_split(monkeypatch, chunk, kind):
    monkeypatch.setattr(wordhash, "_CHUNK", chunk)
    wordhash._powers.cache_clear()
    words = Words(pa.array(TEXTS, kind))
    got = [[bytes(words.data[words.first[i]:words.last[i]]) for i in range(b, b + n)] for b, n in zip(words.begin, words.count)]
    assert got == plain(TEXTS)
    by_word = {}
    for w, h in zip((w for t in got for w in t), words.hash.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    wordhash._powers.cache_clear()


def test_hashes_do_not_depend_on_place_or_slice():
    r = random.Random(1)
    texts = [" ".join(r.choice(["alpha", "Beta", "gamma,", "ß", "日"]) for _ in range(r.randrange(400))) for _ in range(60)]
    whole = Words(pa.array(texts)).hash
    batch = pa.record_batch([pa.array(texts)], ["text"])
    pieces = [Words(b.column("text")).hash for b in text_slices(iter([batch]), limit=500)]
    assert len(pieces) > 10 and np.array_equal(np.concatenate(pieces), whole)


def test_fold_lowers_ascii_only():
    words = Words(pa.array(["ABC abc ÄBC äbc Äbc"]), fold=True)
    assert words.hash[0] == words.hash[1] and words.hash[2] == words.hash[4] != words.hash[3]


def test_many_words_have_distinct_hashes():
    words = Words(pa.array([" ".join(f"w{i:x}" for i in range(200_000))]))
    assert len(np.unique(words.hash)) == 200_000


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 15, 35])
def test_rolling(size):
    h = mix(np.arange(60, dtype=np.uint64))
    step = 0x9E3779B97F4A7C15
    want = []
    for i in range(60 - size + 1):
        acc = 0
        for x in h[i:i + size].tolist():
            acc = (acc * step + x) % (1 << 64)
        want.append(acc)
    assert rolling(h, size).tolist() == want


def test_runs_stay_inside_a_text():
    words = Words(pa.array(["a b c", None, "d", "e f"]))
    assert words.runs(2).tolist() == [0, 1, 4] and words.runs(3).tolist() == [0] and words.runs(9).tolist() == []
