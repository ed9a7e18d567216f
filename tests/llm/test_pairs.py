import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchvoice.llm import graph, minhash, vectors, words

from .conftest import prose


def components_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(90)] + [(7, 7)]
    nodes = {n for e in edges for n in e}
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components_of(edges, nodes)
    assert all(got.get(n, n) == want[n] for n in nodes)
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def near_brute(texts, n):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = {}
    for i, t in texts:
        w = (t or "").translate(low).split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, components_of(pairs, ids)


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_against_brute_force(make, n):
    draw, texts = random.Random(n), []
    for g in range(60):
        base = prose(1000 + g, draw.choice([1, 2, 5, 40, 120])).split(" ")
        for _ in range(draw.choice([1, 2, 6])):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 5])):
                own[draw.randrange(len(own))] = prose(draw.random(), 1)
            texts.append((len(texts), draw.choice([" ".join, "\n".join])(own).upper() if draw.random() < 0.3 else " ".join(own)))
    sets, want = near_brute(texts, n)
    rows = minhash.near_duplicates(make([(i, t, "en", "a") for i, t in texts]), shingle=n).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in rows)


def test_hot_group_of_edited_copies(make):
    """One bucket family with many members outside the main component."""
    draw, base = random.Random(5), prose(77, 60).split(" ")
    texts = []
    for i in range(300):
        own = list(base)
        for k in draw.sample(range(60), draw.randint(0, 9)):
            own[k] = f"w{i}x{k}"
        texts.append((i, " ".join(own)))
    _, want = near_brute(texts, 2)
    rows = minhash.near_duplicates(make([(i, t, "en", "a") for i, t in texts]), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in rows} == want and len(set(want.values())) > 20


def test_only_texts_of_named_documents_move(make, monkeypatch):
    """Texts go from the scan to their cells; with many places the join shuffles, and the result is the same."""
    seen = []
    stage = minhash.stage
    monkeypatch.setattr(minhash, "stage", lambda df, label: seen.append((label, df)) or stage(df, label))
    texts = [(i, prose(i // 3, 50) + (" x" if i % 3 == 2 else ""), "en", "a") for i in range(120)]
    want = near_brute([t[:2] for t in texts], 2)[1]
    for small in (True, False):
        monkeypatch.setattr(minhash, "broadcast_if_small", lambda df, size, s=small: F.broadcast(df) if s else df.hint("merge"))
        rows = minhash.near_duplicates(make(texts), shingle=2).collect()
        assert {r.doc_id: r.component_id for r in rows} == want
        plan = [df for label, df in seen if label == "links"][-1]._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) != small and plan.count("BroadcastHashJoin") == (2 if small else 0)


def test_odd_documents(odd, empty):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r.component_id for r in rows}
    assert got[1] == got[2] == 1 and got[4] == 4 and got[5] == 5 and got[6] == 6
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    kept = minhash.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 2
    assert minhash.near_duplicates(empty).collect() == [] and minhash.deduplicated(empty).collect() == []


def test_two_bijections_make_all_coordinates():
    draw = np.random.default_rng(0)
    a = draw.integers(0, 1 << 63, 900).astype(np.uint64)
    b = np.concatenate([a[:800], draw.integers(0, 1 << 63, 100).astype(np.uint64)])
    s = minhash.signatures([a, b], 512)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.07
    places = np.arange(1 << 16, dtype=np.uint32)
    minhash._order(places, np.empty_like(places))
    assert len(np.unique(places)) == 1 << 16


def test_words_and_hashes_follow_the_bytes():
    import pyarrow as pa

    texts = ["a b\tc", None, "", "Äb  A", "a"]
    found = words.split(pa.array(texts), lower=True)
    cut = lambda i: [bytes(found.data[a:b]).decode() for a, b in zip(found.start[found.of(i)], found.end[found.of(i)])]
    assert [cut(i) for i in range(5)] == [["a", "b", "c"], [], [], ["Äb", "a"], ["a"]]
    assert found.hash[0] == found.hash[4] == found.hash[5] != found.hash[1]
    again = words.split(pa.array(["x" * 5000, *texts])[1:], lower=True)
    assert (again.hash == found.hash).all()


def vector_brute(rows, least):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _ in rows}
    pairs = []
    for k, (i, u) in enumerate(good):
        for j, v in good[:k]:
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= least:
                links[i].add(j)
                links[j].add(i)
                pairs.append((i, j))
    return {i: len(s) for i, s in links.items()}, components_of(pairs, list(links))


def test_vectors_against_brute_force(spark):
    draw, rows = np.random.default_rng(4), []
    for g in range(40):
        base = draw.normal(size=16)
        for _ in range(draw.integers(1, 9)):
            rows.append((len(rows), (base + draw.normal(size=16) * draw.choice([0, 0.05, 0.3, 0.5])).astype(np.float32).tolist()))
    rows += [(len(rows) + k, v) for k, v in enumerate([None, [0.0] * 16, [float("nan")] * 16, [1.0, None] + [0.0] * 14, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], []])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, vector string")
    links, component = vector_brute(rows, 0.9)
    for tile in (8192, 20):
        got = vectors.near_vectors(df, tile=tile).collect()
        assert {r.vec_id: r.n_links for r in got} == links
        assert {r.vec_id: r.component_id for r in got} == component and all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vectors.near_vectors(df.limit(0)).collect() == []
    ghosts = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted((str(r.vec_id), r.n_links) for r in vectors.near_vectors(ghosts).collect()) == [("3", 0), ("None", 0), ("None", 0)]


def test_vectors_of_extreme_size_and_repeated_ids(spark):
    huge = [(1, [1e200, 1e199]), (2, [1e200, 0.0]), (3, [1e-200, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 5e-324]), (6, [0.0, 1e300])]
    df = spark.createDataFrame([(i, v, 1) for i, v in huge], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5)}
    # Rows that share an id are vectors of their own.
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [0.1, 1.0]), (3, [0.1, 1.0])], "vec_id long, embedding array<double>")
    rows = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(twice).collect())
    assert rows == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)]


def test_wide_vectors_and_pairs_in_the_band(spark):
    """Beyond 1,024 components sums go over to doubles; pairs close to the threshold are decided exactly."""
    draw, rows = np.random.default_rng(8), []
    base = draw.normal(size=1100)
    base /= np.linalg.norm(base)
    for k in range(60):
        off = draw.normal(size=1100)
        off -= off @ base * base
        off /= np.linalg.norm(off)
        cosine = np.sqrt(0.9) + (k - 30) * 1e-4
        rows.append((k, (cosine * base + np.sqrt(1 - cosine**2) * off).tolist()))
    rows.append((60, base.tolist()))
    links, component = vector_brute(rows, 0.9)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for tile in (8192, 16):
        got = vectors.near_vectors(df, tile=tile).collect()
        assert {r.vec_id: r.n_links for r in got} == links and {r.vec_id: r.component_id for r in got} == component


def test_only_codes_travel_to_the_tiles(spark, monkeypatch):
    seen = []
    stage = vectors.stage
    monkeypatch.setattr(vectors, "stage", lambda df, label: seen.append((label, df)) or stage(df, label))
    df = spark.range(50).select(F.col("id").alias("vec_id"), F.array(*[F.rand(k) for k in range(8)]).alias("embedding"))
    vectors.near_vectors(df).collect()
    plan = dict(seen)["vector-links"]._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "FlatMapCoGroups" in line or "Project" in line]
    assert exchanges and all("vector" not in line for line in exchanges)


def test_quantisation_bound_is_rigorous():
    draw = np.random.default_rng(9)
    u = draw.normal(size=(300, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    codes, scale, error = vectors.quantised(u)
    product = (codes.astype(int) @ codes.astype(int).T) * scale[:, None] * scale[None, :]
    assert (np.abs(product - u @ u.T) <= error[:, None] + (1 + error[:, None]) * error[None, :]).all()
