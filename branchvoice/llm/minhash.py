"""Near-duplicate documents by circulant MinHash.

Two fixed bijections of 32-bit numbers serve all coordinates: the first scatters the shingles
over the universe, the second, shifted round by one place per coordinate, orders them; the
signature coordinate is the smallest place. Bands of coordinates propose pairs, which are
confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchvoice.llm import words
from branchvoice.llm.graph import components
from branchvoice.llm.stages import broadcast_if_small, slices, stage

#: 28 bands of 4: a pair at similarity 0.8 shares no band with probability 4e-7.
BANDS, ROWS = 28, 4
PIECE = 2 << 20
FLAT = 1 << 15
#: Documents of one side that are compared in one task.
CELL = 512
#: A place of a document in a cell, in memory.
PLACE_BYTES = 40


def _order(x: np.ndarray, spare: np.ndarray) -> None:
    """The second bijection, in place: the place of each number of the 32-bit universe."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint32(factor), out=x)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row per shingle set (none empty), one column per coordinate."""
    out = np.empty((len(sets), coordinates), np.uint32)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= FLAT):
            size += len(sets[j])
            j += 1
        flat = (words.mix(np.concatenate(sets[i:j]), 11) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[i : j - 1]])
        place, spare = np.empty_like(flat), np.empty_like(flat)
        for k in range(coordinates):
            np.add(flat, np.uint32(k), out=place)
            _order(place, spare)
            out[i:j, k] = np.minimum.reduceat(place, starts)
        i = j
    return out


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct shingles of `n` words; fewer words: the whole sequence as one; none: empty."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(words.grams(hashes, min(n, len(hashes))))


def _signed(n: int, bands: int, rows: int):
    """Per document: size and digest of its set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices("text", PIECE)(batches):
            found = words.split(batch.column("text"), lower=True)
            sets = [shingle_set(found.hash[found.of(i)], n) for i in range(batch.num_rows)]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((batch.num_rows, bands), np.uint64)
            if full:
                places = signatures([sets[i] for i in full], bands * rows).reshape(len(full), bands, rows).astype(np.uint64)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(full), bands)).copy()
                for r in range(rows):
                    key = words.mix(key * np.uint64(0xFF51AFD7ED558CCD) + places[:, :, r], 13)
                keys[full] = key
            digest = lambda seed: np.array([words.mix(s, seed).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1) * bands, pa.int32()), pa.array(keys.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest(17)), pa.array(digest(19)), lists],
                names=["doc_id", "n_shingles", "d1", "d2", "bands"],
            )

    return run


def _links(n: int, percent: int):
    """Links between the strangers and the members of one cell, as few as keep what is connected so."""

    def sets_of(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
        table = table.select(["node", "text"]).combine_chunks()
        ids, sets = [], []
        for batch in slices("text", PIECE)(table.to_batches()):
            found = words.split(batch.column("text"), lower=True)
            ids += batch.column("node").to_pylist()
            sets += [shingle_set(found.hash[found.of(i)], n) for i in range(batch.num_rows)]
        return ids, sets

    def run(members: pa.Table, strangers: pa.Table) -> pa.Table:
        ids, sets = sets_of(members)
        queries, query_sets = sets_of(strangers)
        out_a, out_b, parent = [], [], {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        if ids and queries:
            flat = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            size = np.array([len(s) for s in sets])
            for q, own in zip(queries, query_sets):
                low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                spans = high - low
                at = np.repeat(low - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
                common = np.bincount(owner[at], minlength=len(ids))
                for k in np.flatnonzero(100 * common >= percent * (size + len(own) - common)):
                    x, y = root(q), root(ids[k])
                    if x != y:
                        parent[x] = y
                        out_a.append(q)
                        out_b.append(ids[k])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def _in_cells(docs: DataFrame, left: DataFrame, right: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between the two sides of every cell (family, i, j), whose rows name documents by `node`.

    Texts are looked up by the places that name them: where those are few enough to be broadcast, texts
    go straight from the scan to their cells, and no other text moves. Otherwise all are shuffled once by
    doc_id before that.
    """
    key = ["family", "i", "j"]
    sides = [x.select(*key, "node", F.lit(side).alias("side")) for side, x in enumerate((left, right))]
    places = stage(sides[0].union(sides[1]).distinct(), "places")
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "text")
    placed = texts.join(broadcast_if_small(places, PLACE_BYTES), "node")
    # Aliases tell the two sides apart, which read the same tables.
    left, right = (placed.where(F.col("side") == k).select(*[F.col(c).alias(c) for c in (*key, "node", "text")]) for k in (0, 1))
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_links(n, percent), "a long, b long")


def _last(c: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(c) - 1)


def _cell(c: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(c))


def _verify(docs: DataFrame, stars: DataFrame, n: int, percent: int) -> DataFrame:
    """Rows (a, b) of links among the pairs of a head `a` and a member `b`: a head goes to as many cells as its members fill."""
    counts = stage(stars.groupBy(F.col("a").alias("family")).agg(F.ceil(F.count("*") / CELL).alias("js")), "heads")
    heads = counts.select("family", F.lit(0).cast("long").alias("i"), F.explode(_last("js")).alias("j"), F.col("family").alias("node"))
    members = stars.select(F.col("a").alias("family"), F.col("b").alias("node")).join(counts, "family")
    members = members.select("family", F.lit(0).cast("long").alias("i"), _cell("js").alias("j"), "node")
    return _in_cells(docs, heads, members, n, percent)


def _compared(docs: DataFrame, strangers: DataFrame, label: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between the strangers of a family and all its members and strangers.

    A family is a component; its strangers share a bucket with it. Both sides are dealt into cells
    of bounded size, each compared in one task; pairs never become rows unless they join something.
    """
    own = label.join(strangers.select(F.col("family").alias("component")).distinct(), "component", "left_semi")
    members = own.select(F.col("component").alias("family"), F.col("id").alias("node")).union(strangers)
    members = members.union(strangers.select("family", F.col("family").alias("node"))).distinct()
    counts = members.groupBy("family").agg(F.count("*").alias("m")).join(strangers.groupBy("family").agg(F.count("*").alias("s")), "family")
    counts = stage(counts.select("family", F.ceil(F.col("m") / CELL).alias("ms"), F.ceil(F.col("s") / CELL).alias("ss")), "families")
    left = members.join(counts, "family").select("family", "node", _cell("ms").alias("i"), F.explode(_last("ss")).alias("j"))
    right = strangers.join(counts, "family").select("family", "node", _cell("ss").alias("j"), F.explode(_last("ms")).alias("i"))
    return _in_cells(docs, left, right, n, percent)


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest reachable doc_id), kept.

    Texts are lower-cased in A-Z and cut at ASCII white space; documents with
    100 * |intersection| >= percent * |union| of their shingle sets are linked.

    Equal sets are one node, so copies add no pairs. In a bucket of a band every member is first
    compared with its smallest; components of those links are formed; then the members outside
    their bucket's commonest component are compared with that component and with each other, cell
    by cell. After that no proposed pair of different components is left uncompared, so the
    components are those of all proposed pairs, while a bucket of copies costs as many pairs as it
    has members.

    Null or empty text: empty set, linked with nothing. A null doc_id is never linked: its
    component_id is null and it is kept. Repeated rows of a doc_id are one node, each is returned.
    Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(
        base.mapInArrow(_signed(shingle, bands, rows), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"),
        "signatures",
    )
    digest = ["d1", "d2", "n_shingles"]
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = stage(named.groupBy(*digest).agg(F.min("doc_id").alias("node")), "nodes")
    members = stage(
        named.select("doc_id", "bands")
        .join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
        .distinct(),
        "buckets",
    )
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    stars = stage(
        members.join(heads.select("bucket", "head"), "bucket").where("node > head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(),
        "stars",
    )
    linked = stage(_verify(base, stars, shingle, percent), "links")
    label = stage(components(linked), "labels")

    placed = members.join(heads.where("n > 2").select("bucket"), "bucket", "left_semi").join(
        label.withColumnRenamed("id", "node"), "node", "left"
    ).select("bucket", "node", F.coalesce("component", "node").alias("label"))
    sizes = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("family"), F.count("*").alias("labels"))
    strangers = placed.join(main.where("labels > 1").select("bucket", "family"), "bucket").where("label != family")
    strangers = stage(strangers.select("family", "node").distinct(), "strangers")
    more = stage(_compared(base, strangers, label, shingle, percent), "late-links")
    label = stage(components(linked.union(more)), "labels")

    placed = signed.select("doc_id", "n_shingles", "d1", "d2").join(nodes, digest, "left")
    return (
        placed.join(label.withColumnRenamed("id", "node"), "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def deduplicated(docs: DataFrame, **parameters) -> DataFrame:
    """The documents kept, one row of each group, with all their columns.

    A doc_id on several rows keeps one of them; rows with a null doc_id all stay.
    """
    gone = stage(near_duplicates(docs, **parameters).where("NOT kept").select("doc_id").distinct(), "gone")
    left = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
    again = stage(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return left
    single = left.join(again, left["doc_id"] == again["doc_id"], "left_anti")
    return single.union(left.join(again, left["doc_id"] == again["doc_id"], "left_semi").dropDuplicates(["doc_id"]))
