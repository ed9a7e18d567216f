import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchvoice.llm import lexical, packing, queries, vector_codes

from .conftest import prose

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def search_brute(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in set(items):
        scored = []
        for i, bag in bags:
            m = 75 + (25 * sum(bag.values()) * n_docs) // total
            weight = lambda w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
            score = sum(weight(w) * ((10**9 * bag[w]) // (1000 * bag[w] + 12 * m)) for w in terms(text) if w in bag)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def search_rows(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def asked(spark):
    items = [(1, prose(1, 40)), (2, "the thing THE"), (3, None), (4, ""), (5, " ?! "), (6, "nowhere found"), (7, "Äx éa 12"), (None, prose(2, 8)), (1, prose(1, 40)), (8, prose(3, 400))]
    return items, spark.createDataFrame([(i, t, "x", 1, 2) for i, t in items], "item_id long, text string, doc_id string, score int, rank int")


def test_search_against_brute_force(spark, make, asked, monkeypatch):
    items, frame = asked
    draw = random.Random(11)
    docs = [(i, " ".join(draw.choice(["the", "thing", "er", "Ou", "éa", "12", "tion-an", "x"]) for _ in range(draw.choice([1, 2, 3, 9])))) for i in range(300)]
    docs += [(1000 + i, prose(1, 40) if i % 3 else prose(1, 40).upper() + "!") for i in range(60)] + [(2000, prose(4, 30_000)), (None, "the thing"), (2001, None), (2002, "?"), (5, docs[5][1])]
    draw.shuffle(docs)
    frame_docs = make([(i, t, "en", "a") for i, t in docs]).repartition(7)
    kept = [x for x in items if x[1]]
    assert search_rows(lexical.search(frame_docs, frame)) == search_brute(docs, kept, 20)
    assert search_rows(lexical.search(frame_docs, frame, top=3, slice_bytes=300)) == search_brute(docs, kept, 3)
    # Small groups and batches, and whole numbers instead of doubles.
    monkeypatch.setattr(lexical, "CELLS", 64)
    monkeypatch.setattr(lexical, "GROUP_ITEMS", 2)
    own = lexical.groups(lexical.Vocabulary([t for _, t in kept]), np.full(10_000, 1 << 40))
    assert {g.exact for g in own} == {np.int64}
    assert {int(i) for g in own for i in g.items} == {k for k, (_, t) in enumerate(kept) if terms(t)}


def test_copies_are_scored_once_and_expanded_by_id(make, spark):
    docs = [(i, "alpha beta", "en", "a") for i in range(500, 0, -1)] + [(900 + i, f"gamma w{i}", "en", "a") for i in range(50)]
    items = spark.createDataFrame([(1, "alpha"), (2, "gamma")], "item_id long, text string")
    rows = search_rows(lexical.search(make(docs).repartition(5), items))
    # w0, w1 ... are not words of an item: those documents are one class too.
    assert [r[2] for r in rows if r[0] == 1 and r[1] <= 20] and {r[2] for r in rows if r[0] == 1} == set(range(1, 21))
    assert {r[2] for r in rows if r[0] == 2} == set(range(900, 920))


def test_search_of_odd_and_empty_tables(odd, odd_texts, empty, asked, spark):
    items, frame = asked
    kept = [x for x in items if x[1]]
    assert search_rows(lexical.search(odd, frame)) == search_brute([(i, t) for i, t, _, _ in odd_texts], kept, 20)
    assert lexical.search(empty, frame).collect() == []
    assert lexical.search(odd, frame.limit(0)).collect() == []


def lloyd_brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, lab, [int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(1, max(len(v) for _, _, v in kept)) // parts) * parts
    kept = sorted(((i, lab, v + [0] * (width - len(v))) for i, lab, v in kept), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = width // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, _, v in kept:
                groups[nearest(p, cut(v, p))[1]].append(cut(v, p))
            for k, own in groups.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(c) for part in books for e in part for c in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for i, lab, v in kept:
        best = [nearest(p, cut(v, p)) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[lab] += error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, lab))
    fit = lambda x: x if x < 2**63 else None
    lost = {lab for _, _, e, lab in out if e >= 2**63}
    return sorted(((i, c, fit(e), None if lab in lost else fit(by_label[lab]), sha) for i, c, e, lab in out), key=str)


def coded(spark, rows, **parameters):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, lab, v in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    return sorted([(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.coded_vectors(df.repartition(3), **parameters).collect()], key=str)


def blobs(seed, n, width, spread=0.05):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(7, width))
    return (centers[draw.integers(0, 7, n)] + draw.normal(size=(n, width)) * spread).tolist()


def test_codes_against_brute_force(spark, monkeypatch):
    rows = [(i, [None, 1, 2][i % 3], v) for i, v in enumerate(blobs(1, 220, 16))]
    rows += [(300 + i, 1, rows[i][2]) for i in range(40)] + [(7, 2, rows[9][2]), (None, 1, rows[3][2]), (None, None, [0.0] * 16)]
    assert coded(spark, rows) == lloyd_brute(rows)
    monkeypatch.setattr(vector_codes, "CHUNK", 50)
    assert coded(spark, rows, rounds=2, entries=5, parts=4) == lloyd_brute(rows, parts=4, entries=5, rounds=2)


def test_ties_and_odd_vectors(spark):
    grid = [(i, i % 2, [float(i % 3), float(i % 2), 0.0, 1.0] * 4) for i in range(60)]
    odd = [(100, 1, None), (101, 1, [1.0, None] + [0.0] * 14), (102, 1, [float("nan")] * 16), (103, None, [float("inf")] * 16), (104, 1, [1.0, 2.0]), (105, 0, []), (106, 0, [0.25] * 19)]
    assert coded(spark, grid + odd) == lloyd_brute(grid + odd)
    assert coded(spark, grid[:3]) == lloyd_brute(grid[:3])
    assert coded(spark, odd[:4]) == [] and coded(spark, []) == []


def test_codes_of_huge_numbers_are_exact(spark):
    rows = [(i, i % 2, v) for i, v in enumerate(blobs(2, 60, 8, 0.5))]
    rows += [(70, 0, [1e6, -1e6] * 4), (71, 0, [1e12] * 8), (72, 1, [1e30, 1.0] * 4), (73, 1, [-1e306] * 8)]
    assert coded(spark, rows) == lloyd_brute(rows)


def test_cover_tree_keeps_its_laws():
    points = np.unique(np.round(np.array(blobs(3, 900, 4)) * 4096), axis=0)
    point, own, depth, radius = vector_codes.cover_tree(points)
    assert sorted(point[own].tolist()) == list(range(len(points)))
    forest = vector_codes.planted(points.astype(np.int64), 1)
    for k in range(len(forest.depth)):
        away = np.sqrt(((forest.point[k : forest.end[k]] - forest.point[k]) ** 2).sum(axis=1))
        assert away.max() <= forest.radius[k]
        children = forest.levels[forest.depth[k] + 1][forest.child[k] : forest.child_end[k]] if forest.child_end[k] > forest.child[k] else []
        assert all(forest.depth[c] == forest.depth[k] + 1 and k < c < forest.end[k] for c in children)
        if len(children) > vector_codes.LEAF:
            net = forest.point[children]
            apart = np.sqrt(((net[:, None] - net[None]) ** 2).sum(axis=2)) + np.eye(len(net)) * 1e9
            assert apart.min() > 0 and (apart > (forest.radius[k] - 1) / 2 - 1).all()
    assert forest.total[-1].tolist() == points.sum(axis=0).astype(int).tolist() and forest.count[-1] == len(points)
    # Most points are assigned with their subtree.
    start, end, _ = vector_codes.assigned(forest, points[None, [0, 300, 700]].astype(np.int64))
    assert len(start) < len(points) / 2


def test_digits_of_sums():
    for v in (0, 1, -1, 2**31, -(2**31), 2**62 + 5, -(2**90) - 7, 10**300):
        assert sum(d << 32 * k for k, d in enumerate(vector_codes.limbs(v))) == v


def packs_of(histogram, room, worth=1):
    """Pieces (length class, document, start, length, pack, offset) of packed lengths."""
    out, pack = [], 0
    for p in packing.packed_lengths(histogram, room, worth):
        for i in range(p.count):
            offset = 0
            for s in p.slots:
                out.append((s.of, s.rank + i, s.start, s.length, pack, offset))
                offset += s.length
            pack += 1
    return out


def test_shortest_pack_first_is_that_of_one_by_one():
    draw = random.Random(4)
    for _ in range(60):
        room = draw.choice([8, 32])
        histogram = {length: draw.randint(1, 20) for length in draw.sample(range(1, room + 1), draw.randint(1, room))}
        packs = []
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fits = [k for k, p in enumerate(packs) if p + length <= room]
                if fits:
                    packs[min(fits, key=packs.__getitem__)] += length
                else:
                    packs.append(length)
        got = Counter()
        for p in packing.shortest_pack_first(histogram, room):
            assert p.used == sum(s.length for s in p.slots)
            got[p.used] += p.count
        assert got == Counter(packs)


def test_every_token_lies_in_one_place():
    draw = random.Random(5)
    for _ in range(80):
        room = draw.choice([8, 64])
        histogram = {length: draw.randint(1, 30) for length in draw.sample(range(1, room), draw.randint(0, room - 1))}
        pieces = packs_of(histogram, room, draw.choice([1, 3]))
        tokens = [(of, rank, start + k) for of, rank, start, length, _, _ in pieces for k in range(length)]
        assert sorted(tokens) == sorted((of, rank, k) for of, n in histogram.items() for rank in range(n) for k in range(of))
        known = packing.places(packing.packed_lengths(histogram, room), room)
        for of, n in histogram.items():
            doc, row = known.of(np.full(n, of), np.arange(n))
            assert np.bincount(doc, weights=known.rows[row, 4], minlength=n).tolist() == [of] * n


@pytest.mark.parametrize("histogram", [{1100: 10**9}, {1: 10**9}, {1100: 1}, {2047: 5, 500: 7, 1: 10}, {k: 10**7 + k for k in range(1, 2048)}])
def test_little_padding_whatever_the_counts(histogram):
    packs = packing.packed_lengths(histogram, 2048)
    tokens = sum(k * n for k, n in histogram.items())
    assert sum(p.used * p.count for p in packs) == tokens
    padding = sum(p.count * (2048 - p.used) for p in packs if p.used & (p.used - 1))
    assert padding < 0.01 * tokens
    assert sum(len(p.slots) for p in packs) < 200_000


def test_packing_against_the_library(make, odd, odd_texts, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    more = [(100 + i, prose(i, random.Random(i).choice([3, 30, 300, 900])), "en", "a") for i in range(200)]
    for texts in (odd_texts, odd_texts + more + more[:50]):
        rows = packing.packed(make(texts).repartition(6), path).collect()
        by_doc = defaultdict(list)
        for r in rows:
            by_doc[r.doc_id].append(r)
        want = defaultdict(Counter)
        for i, t, _, _ in texts:
            want[i][tuple(library.encode(t or "", add_special_tokens=False).ids + [1])] += 1
        for i, found in want.items():
            pieces = sorted(by_doc[i], key=lambda r: r.start)
            assert sum(r.length for r in pieces) == sum(len(x) * n for x, n in found.items())
            if sum(found.values()) == 1:
                ids = b"".join(bytes(r.ids) for r in pieces)
                assert tuple(np.frombuffer(ids, "<u4").tolist()) in found and [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
                assert all(r.doc_tokens * 4 == len(ids) for r in pieces)
        sequences = defaultdict(list)
        for r in rows:
            assert len(r.ids) == 4 * r.length
            sequences[r.sequence_id].append((r.offset, r.length))
        assert sorted(sequences) == list(range(len(sequences)))
        padding = 0
        for own in sequences.values():
            ends = 0
            for offset, length in sorted(own):
                assert offset == ends
                ends += length
            assert ends <= 2048
            padding += 2048 - ends if ends & (ends - 1) else 0
        assert padding <= 0.01 * sum(r.length for r in rows)
    assert packing.packed(empty, path).collect() == []


def test_ranks_by_shuffle_join_are_the_same(make, monkeypatch):
    from branchvoice.llm import stages

    path = queries.tokenizer("byte_bpe_50k.json")
    docs = make([(i, prose(i % 40, 5 + i % 40), "en", "a") for i in range(300)]).repartition(5)
    rows = lambda: packing.packed(docs, path).withColumn("crc", F.crc32("ids")).select("sequence_id", "offset", "length").orderBy("sequence_id", "offset").collect()
    want = rows()
    monkeypatch.setattr(stages, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(packing, "broadcast_if_small", lambda df, row_bytes: df)
    assert rows() == want


def test_query_crc_is_that_of_the_ids(spark):
    rows = queries.op13_packing(spark, "/root/testdata/sf0.001")
    own = packing.packed(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), queries.tokenizer("byte_bpe_50k.json"))
    want = Counter((r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)) & 0xFFFFFFFF) for r in own.collect())
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows.collect()) == want
