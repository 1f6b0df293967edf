import numpy as np

from linecast.llm import embedding_dedup as D


def brute(rows, threshold):
    """n_links and component by id over all pairs of equal label."""
    ok = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            ok[i] = (x / np.linalg.norm(x), label)
    links, comp = dict.fromkeys(ok, 0), {i: i for i in ok}
    for i in sorted(ok):
        for j in sorted(ok):
            if i < j and ok[i][1] == ok[j][1] and len(ok[i][0]) == len(ok[j][0]) and ok[i][0] @ ok[j][0] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = sorted((comp[i], comp[j]))
                comp = {k: a if c == b else c for k, c in comp.items()}
    return sorted((str(i), links.get(i, 0), comp.get(i, i), comp.get(i, i) == i or i is None) for i, _, _ in rows)


def vectors(n, seed=0, dim=16):
    rng, rows = np.random.default_rng(seed), []
    base = rng.normal(size=(n // 4, dim))
    for i in range(n):
        v = base[rng.integers(0, len(base))] + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    return rows


def got(df):
    return sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_against_brute_force_with_small_chunks(spark):
    rows = vectors(240)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows, 0.93)
    # Loose index settings: the few pivots of a small table must not cost recall here.
    for chunk in (2000, 7):
        assert got(D.near_duplicates(df, min_shared=1, prefix=12, chunk=chunk)) == expected


def test_default_recall(spark):
    rows = vectors(600, seed=5, dim=32)
    expected = brute(rows, 0.93)
    found = got(D.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    want, have = sum(r[1] for r in expected), sum(r[1] for r in found)
    assert want and 0.99 * want <= have <= want


def test_recall_with_a_third_in_one_group_of_near_copies(spark):
    rng = np.random.default_rng(3)
    center = rng.normal(size=64)
    alone, near = rng.normal(size=(1000, 64)), center + 0.2 * rng.normal(size=(500, 64))
    x = rng.permutation(np.vstack([alone, near])).astype(np.float32)
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], SCHEMA)
    unit = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    have = np.array([r["n_links"] for r in D.near_duplicates(df).orderBy("vec_id").collect()])
    assert want.sum() > 200_000 and (have <= want).all() and have.sum() >= 0.99 * want.sum()


def test_awkward_vectors(spark):
    a = [1.0, 2.0, 3.0]
    rows = [
        (1, a, 0), (2, a, 0), (3, [2.0, 4.0, 6.0], 0), (4, a, 1), (5, a, None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0),
        (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0), (11, [1.0, float("inf"), 3.0], 0), (12, [1.0, 2.0], 0), (None, a, 0), (13, [-0.0, 0.0, 1.0], 0), (14, [0.0, 0.0, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(D.near_duplicates(df)) == brute(rows, 0.93)
    wide = df.selectExpr("*", "'x' as id", "1 as vec", "2 as node", "3 as pivot", "'y' as n_links")
    assert got(D.near_duplicates(wide)) == brute(rows, 0.93)


def test_empty_table(spark):
    assert D.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_link_is_found_without_structure_and_beside_it(spark):
    """Pairs far from every pivot, whose nearest pivots differ, are links too."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(700, 64))
    noise = rng.normal(size=(700, 64))
    cosine = rng.uniform(0.925, 0.94, size=(700, 1))      # close to the threshold, on both sides
    flat = noise - (noise * base).sum(1, keepdims=True) / (base * base).sum(1, keepdims=True) * base
    flat *= np.linalg.norm(base, axis=1, keepdims=True) / np.linalg.norm(flat, axis=1, keepdims=True)
    x = np.vstack([base, cosine * base + np.sqrt(1 - cosine ** 2) * flat, 0.05 * rng.normal(size=(100, 64)) + base[:1]]).astype(np.float32)
    df = spark.createDataFrame([(i, v, i % 700 % 2) for i, v in enumerate(x.tolist())], SCHEMA)
    unit = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    label = np.arange(len(x)) % 700 % 2
    want = ((unit @ unit.T >= 0.93) & (label[:, None] == label)).sum(axis=1) - 1
    for options in ({}, {"n_pivots": 8}, {"chunk": 50}):
        have = [r["n_links"] for r in D.near_duplicates(df, **options).orderBy("vec_id").collect()]
        assert want.sum() > 400 and have == want.tolist(), options


def test_components_hold_every_link(spark):
    """A vector whose only links lead to larger ids, or to one that has a smaller
    neighbour, belongs to the component all the same."""
    rng = np.random.default_rng(17)
    chain = [[float(np.float32(np.cos(a))), float(np.float32(np.sin(a))), 0.0] for a in np.radians(20.0 * np.arange(18))]
    for n in (3, 7, 15):
        rows = [(int(i), v, 0) for i, v in zip(rng.permutation(n), chain)]
        assert all(r[2] == 0 for r in brute(rows, 0.93))
        for options in ({}, {"chunk": 2}, {"n_pivots": 3, "chunk": 2}):
            assert got(D.near_duplicates(spark.createDataFrame(rows, SCHEMA), **options)) == brute(rows, 0.93), (n, options)


def test_connect_joins_what_the_pairs_join():
    rng = np.random.default_rng(23)
    for n, m in ((10, 6), (500, 300), (3000, 4000)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        root, comp = np.arange(n), list(range(n))
        for k in range(0, m, 1000):
            D.connect(root, a[k:k + 1000], b[k:k + 1000])

        def find(i):
            while comp[i] != i:
                i = comp[i]
            return i

        for i, j in zip(a, b):
            x, y = sorted((find(i), find(j)))
            comp[y] = x
        assert root.tolist() == [find(i) for i in range(n)]
