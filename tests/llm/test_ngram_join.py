"""N-gram join against brute force over all pairs."""

import random
import subprocess
import sys

import numpy as np
import pytest

from linecast.llm import ngram_join as G
from linecast.llm.common import table
from tests.conftest import ROOT, SF_SMALL
from tests.llm.helpers import SCHEMA, awkward, awkward_rows, clashing, empty, prose


def brute(rows, k, percent):
    """{(position): component} by comparing all pairs of sets."""
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((str(doc), len(sets[i]), None if doc is None else doc if not sets[i] else least[find(i)]) for i, (doc, _) in enumerate(rows))


def got(df):
    return sorted((str(r[0]), r[1], r[2]) for r in df.collect())


@pytest.mark.parametrize("k,percent,block_weight", [(4, 85, G.BLOCK_WEIGHT), (5, 80, 3000)])
def test_matches_brute_force(spark, k, percent, block_weight):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert got(G.ngram_join(docs, k=k, percent=percent, block_weight=block_weight)) == brute(rows, k, percent)


def test_awkward_rows_and_clashing_columns(spark):
    expected = brute([(r[0], r[1]) for r in awkward_rows()], 4, 85)
    assert got(G.ngram_join(awkward(spark), k=4, percent=85)) == expected
    assert got(G.ngram_join(clashing(awkward(spark)), k=4, percent=85)) == expected


def test_empty_table(spark):
    assert G.ngram_join(empty(spark)).collect() == []


def test_large_group_of_near_copies_is_split_over_blocks(spark):
    """A group far over the block's bound: chains of edits around two bases that
    share a passage, so that the group holds more than one component."""
    r, rows = random.Random(3), []
    passage = prose(50, 60).split()
    for b in range(2):
        base = prose(60 + b, 100).split() + passage
        for i in range(40):
            w = list(base)
            for _ in range(r.randrange(0, 8)):
                w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame([(i, t, None, None, None, None) for i, t in rows], SCHEMA)
    assert got(G.ngram_join(docs, k=4, percent=85, block_weight=1500)) == brute(rows, 4, 85)


def test_large_group_with_an_incomplete_first_pass(spark):
    """Sliding texts: neighbours link, distant ones do not, so leaders alone
    cannot connect the blocks and every block must meet the rest."""
    words = prose(70, 700).split()
    rows = [(i, " ".join(words[3 * i:3 * i + 200])) for i in range(120)]
    docs = spark.createDataFrame([(i, t, None, None, None, None) for i, t in rows], SCHEMA)
    assert got(G.ngram_join(docs, k=4, percent=85, block_weight=4000)) == brute(rows, 4, 85)


def test_forest_matches_all_pairs():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 2**64, int(rng.integers(1, 200)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 9))):
            drop = int(rng.integers(0, 0.12 * len(base) + 1))
            sets.append(np.unique(np.concatenate([rng.permutation(base)[drop:], rng.integers(0, 2**64, drop, dtype=np.uint64)])))
    label = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((label[i], label[j]))
                label[label == b] = a
    forest = G.Forest(sets, np.arange(len(sets)), np.zeros(len(sets), bool), 85)
    for _ in forest.links():
        pass
    assert forest.label.tolist() == label.tolist()


def test_sets_at_the_threshold_share_a_key():
    rng, router = np.random.default_rng(2), G.Router(85, G.ROWS)
    for n in [8, 10, 14, 20, 50, 200, 1000] * 6:
        u = rng.integers(0, 2**64, n, dtype=np.uint64)
        d = int(0.15 * n)
        x, y = np.sort(u[d // 2:]), np.sort(np.concatenate([u[:d // 2], u[d // 2 + d - d // 2:]]))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 85 * (len(x) + len(y) - common):
            assert len(np.intersect1d(router.keys(x), router.keys(y)))


def test_keep_one(spark):
    kept = G.keep_one(awkward(spark), k=4, percent=85)
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(map(str, [1, 4, 5, 6, 7, 8, None, 9, 10, 11, 12]))
    assert kept.columns == awkward(spark).columns


def test_keep_one_decides_by_row_where_ids_repeat(spark):
    a, b, x, y = (prose(50 + i, 40) for i in range(4))
    rows = [(1, a, "r"), (2, a, "s"), (2, b, "t"), (3, x, "u"), (3, y, "v"), (None, a, "w"), (None, a, "w"), (7, "", "x"), (7, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = G.keep_one(docs)
    assert sorted(r["_row"] for r in kept.collect()) == ["r", "t", "u", "v", "w", "w", "x", "y"] and kept.columns == docs.columns


def test_word_table_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(G, "TABLE_BYTES", 20_000)
    for i in range(40):
        text = " ".join(f"w{i}-{j}" for j in range(50))
        assert np.array_equal(G.shingles(text, 3), G.shingles(text, 3))
    assert len(G._word_hash) < 200


def test_bounds_never_fall_below_the_overlap():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**62, 4000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, int(n), replace=False)) for n in rng.choice([1, 2, 3, 8, 9, 60, 700, 3000], 150)]
    forest = G.Forest(sets, np.arange(len(sets)), np.zeros(len(sets), bool), 80)
    nodes, stack = [], [forest.root]
    while stack:
        nodes.append(stack.pop())
        stack += nodes[-1].children
    for a in nodes:
        for b in nodes[::7]:
            if a.hi <= b.lo or b.hi <= a.lo:
                true = max(len(np.intersect1d(x, y)) for x in sets[a.lo:a.hi][:4] for y in sets[b.lo:b.hi][:4])
                assert forest._most_common(a, b) >= true


def test_a_block_of_250_000_short_sets_stays_small():
    """In a process of its own: sets of 8 shingles, under 600 MB in all."""
    code = """
import resource
import numpy as np
from linecast.llm import ngram_join as N
h = np.sort(np.random.default_rng(1).integers(0, 2**62, (250_000, 8)).astype(np.uint64), axis=1)
f = N.Forest(list(h), np.arange(len(h)), np.zeros(len(h), bool), 80)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT)
    assert int(out.stdout) < 600, out.stdout
