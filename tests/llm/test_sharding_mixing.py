import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from branchvoice.llm import mixing, sharding

from .conftest import prose


def shards_of(df, **k):
    return sharding.sharded(df, **k).collect()


def test_every_row_once_and_slots_without_gaps(odd):
    rows = shards_of(odd, shards=4)
    assert Counter((r.doc_id, r.text, r.n) for r in rows) == Counter((r.doc_id, r.text, r.n) for r in odd.collect())
    slots = defaultdict(list)
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 1
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sizes_near_equal_and_copies_together(make):
    texts = [(i, prose(i % 700, 5 + i % 30), "en", "a") for i in range(1500)]
    rows = shards_of(make(texts), shards=8)
    size, places = Counter(), defaultdict(set)
    for r in rows:
        size[r.shard] += r.size
        places[r.text].add(r.shard)
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(size.values()) < 1.1 * mean and min(size.values()) > 0.9 * mean
    assert all(len(p) == 1 for p in places.values())


def test_groups_of_a_third_of_a_shard_stay_whole(make):
    """Eight texts with 160 copies each, a third of one of 16 shards, among others."""
    texts = [(i, f"hot {i % 8} " + "equal words " * 20, "en", "a") for i in range(1280)]
    rest = sum(len(t[1]) + 1 for t in texts) * 16 / (8 / 3) - sum(len(t[1]) + 1 for t in texts)
    while rest > 0:
        texts.append((len(texts), prose(len(texts), 40), "en", "a"))
        rest -= len(texts[-1][1]) + 1
    rows = shards_of(make(texts), shards=16)
    size, places = Counter(), defaultdict(set)
    for r in rows:
        size[r.shard] += r.size
        places[r.text].add(r.shard)
    mean = sum(size.values()) / 16
    assert all(len(p) == 1 for p in places.values())
    assert len(size) == 16 and max(size.values()) < 1.06 * mean and min(size.values()) > 0.94 * mean


def test_the_query_gives_crc_law_and_no_grown_shard(spark):
    """Against the rows computed one by one."""
    import zlib

    from branchvoice.llm import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op1_sharding(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)


def test_a_hot_text_is_cut_over_shards(make):
    texts = [(i, "one text for all of them", "en", "a") for i in range(900)] + [(i, prose(i, 6), "en", "a") for i in range(900, 1500)]
    rows = shards_of(make(texts), shards=8)
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(size.values()) < 1.1 * mean and min(size.values()) > 0.9 * mean


def test_reruns_agree(odd):
    key = lambda r: (str(r.doc_id), str(r.text)[:50], r.shard, r.slot)
    assert sorted(map(key, shards_of(odd))) == sorted(map(key, shards_of(odd.repartition(7))))


def test_empty_table(empty):
    assert shards_of(empty) == []
    assert mixing.mix(empty).collect() == [] and mixing.mixed(empty).collect() == []


def water(sizes: dict, weights=(5, 2, 1), most=3):
    """Targets by resharing until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left, w = total - sum(target.values()), sum(weight[s] for s in open_)
        above = {s for s in open_ if most * sizes[s] <= left * weight[s] / w}
        if not above:
            return target | {s: left * weight[s] / w for s in open_}
        target |= {s: most * sizes[s] for s in above}
        open_ -= above
    return target


def test_targets_by_resharing(spark):
    for sizes in ({"a": 10, "b": 100, "c": 1000, None: 5}, {"a": 0, "b": 7}, {"é": 3, "z": 900, "Z": 40, "y": 1, "x": 2}, {"a": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = water(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def test_mix_meets_targets_and_reruns_agree(make):
    texts = [(i, prose(i, 1 + (i * 37) % 90), "en", f"s{i % 5}" if i % 11 else None) for i in range(2500)]
    df = make(texts)
    rows = mixing.mix(df, leaf=20).collect()
    again = mixing.mix(df.repartition(9), leaf=20).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    taken, target = Counter(), {}
    for r in rows:
        assert r.size == len(r.text.split()) and r.taken % r.size == 0 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 25 for s in target)
    assert math.isclose(sum(target.values()), sum(r.size for r in rows))


def test_mixed_repeats_rows(odd):
    copies = {(r.doc_id, r.text, r.source): r.copies for r in mixing.mix(odd).collect()}
    rows = Counter((r.doc_id, r.text, r.source) for r in mixing.mixed(odd).collect())
    before = Counter((r.doc_id, r.text, r.source) for r in odd.collect())
    assert rows == Counter({k: n * copies[k] for k, n in before.items() if copies[k]})
    assert mixing.mixed(odd).columns == odd.columns


def test_pivot_and_sweep_keep_words_and_chances():
    draw = np.random.default_rng(1)
    words, chance = draw.integers(1, 500, 301).astype(float), draw.random(301)
    p = mixing.pivot(words, chance, np.random.default_rng(2))
    assert ((p > 0) & (p < 1)).sum() <= 1 and math.isclose(p @ words, chance @ words)
    runs = [mixing.sweep(words[:20], chance[:20], np.random.default_rng(s)) for s in range(3000)]
    assert all(set(r) <= {0.0, 1.0} for r in runs)
    assert np.abs(np.mean(runs, axis=0) - chance[:20]).max() < 0.05


def test_native_plan_of_sharding(odd):
    plan = sharding.sharded(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_null_source_and_sizes(odd):
    rows = mixing.mix(odd).select("doc_id", "source", "size", "source_size").distinct().collect()
    total = defaultdict(int)
    for r in mixing.mix(odd).collect():
        total[r.source] += r.size
    assert all(r.source_size == total[r.source] for r in rows) and None in total
    assert odd.where(F.col("text").isNull()).count() == sum(1 for r in rows if r.doc_id in (4, None) and r.size == 0)
