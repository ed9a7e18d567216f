"""Vector codes: exact Lloyd rounds over cover trees of each partition's vector parts.

Every task builds a cover tree of each part of its vectors once. A node covers the points of its
subtree within a known radius; trees are kept in the order of a walk from the root, so a subtree
is a range and its sum the difference of two cumulative sums. In a round a whole subtree goes to
one codebook entry where the triangle inequality proves that no other can be nearest to any of its
points; only other nodes are descended, and decided by exact distances. All sums are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchvoice.llm.stages import broadcast_if_small, ship, stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of one set of trees.
CHUNK = 8192
#: Nodes with no more other points than this have them as leaves.
LEAF = 8
LIMB = 32


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64 where the results stay below 2^53, Python integers otherwise."""
    if not len(values) or np.abs(values).max() * scale < 1 << 53:
        return np.floor(values * scale).astype(np.int64)  # a power of two times a double, below 2^53: exact
    exact = [int(x) * scale if abs(x) >= 1 << 53 else int(np.floor(x * scale)) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def kind_of(most: int, size: int) -> type:
    """The numbers in which squared distances of `size` components up to `most` are exact."""
    squares = 4 * most * most * max(1, size)
    return np.float64 if squares < 1 << 53 else np.int64 if squares < 1 << 62 else object


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of a cover tree of different points, in the order of a walk: point, own, depth, radius.

    A node's children lie on a net of half its radius: further from each other than that, and every
    point of the subtree within it of one of them. The first child is the node's point once more
    (own is false: it counts once). `radius` covers the subtree, rounded up.
    """

    def distance(a: int, others: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((points[others] - points[a]) ** 2).sum(axis=1), 0))

    out: list[tuple[int, bool, int, float]] = []
    rest = np.arange(1, len(points))
    stack = [(0, True, 0, rest, distance(0, rest))] if len(points) else []
    while stack:
        center, own, depth, others, away = stack.pop()
        radius = float(away.max()) * (1 + 1e-9) + 1e-9 if len(others) else 0.0
        out.append((center, own, depth, radius))
        if len(others) <= LEAF:
            none = others[:0]
            stack += [(p, True, depth + 1, none, away[:0]) for p in others.tolist()]
            continue
        half = away.max() / 2
        near = away <= half
        if near.any():
            stack.append((center, False, depth + 1, others[near], away[near]))
        left = others[~near]
        while len(left):
            pick, left = int(left[0]), left[1:]
            away = distance(pick, left)
            near = away <= half
            stack.append((pick, True, depth + 1, left[near], away[near]))
            left = left[~near]
    point, own, depth, radius = zip(*out) if out else ((), (), (), ())
    return np.array(point, np.int64), np.array(own, bool), np.array(depth, np.int16), np.array(radius, np.float64)


@dataclass
class Forest:
    """The trees of all parts, one after the other.

    `point`: components of each node; `weight`: vectors it stands for itself; `place`: node of each
    vector's part (parts x vectors); `end`: first node behind the subtree; `child`, `child_end`:
    range of its children within the nodes of the next depth.
    """

    part: np.ndarray
    point: np.ndarray
    weight: np.ndarray
    depth: np.ndarray
    radius: np.ndarray
    place: np.ndarray

    def __post_init__(self) -> None:
        n = len(self.depth)
        self.levels = [np.flatnonzero(self.depth == k) for k in range(int(self.depth.max()) + 1 if n else 0)]
        self.end = np.full(n, n)
        self.child, self.child_end = np.zeros(n, np.int64), np.zeros(n, np.int64)
        above = np.zeros(0, np.int64)
        for k, level in enumerate(self.levels):
            above = np.union1d(above, level)
            behind = np.searchsorted(above, level, side="right")
            self.end[level] = np.append(above, n)[behind]
            if k + 1 < len(self.levels):
                self.child[level] = np.searchsorted(self.levels[k + 1], level)
                self.child_end[level] = np.searchsorted(self.levels[k + 1], self.end[level])
        weighted = self.point * self.weight[:, None]
        self.total = np.concatenate([np.zeros((1, self.point.shape[1]), self.point.dtype), np.cumsum(weighted, axis=0)])
        self.count = np.concatenate([[0], np.cumsum(self.weight)])


def planted(vectors: np.ndarray, parts: int) -> Forest:
    """Trees of all parts of some whole-number vectors."""
    n, width = vectors.shape
    size = width // parts
    wide = kind_of(largest(vectors), width) is object
    vectors = vectors.astype(object) if wide else vectors
    found, place, before = [], np.empty((parts, n), np.int64), 0
    for p in range(parts):
        own = vectors[:, p * size : (p + 1) * size]
        if wide:
            # Beyond 64 bits every vector is a root of its own, and decided exactly.
            point, counted, depth, radius, back = np.arange(n), np.ones(n, bool), np.zeros(n, np.int16), np.zeros(n), np.arange(n)
            points, times = own, np.ones(n, np.int64)
        else:
            points, back, times = np.unique(own, axis=0, return_inverse=True, return_counts=True)
            point, counted, depth, radius = cover_tree(points.astype(np.float64))
        node = np.empty(len(points), np.int64)
        node[point[counted]] = np.flatnonzero(counted)
        place[p] = before + node[back.ravel()]
        found.append((np.full(len(point), p), points[point], np.where(counted, times[point], 0), depth, radius))
        before += len(point)
    return Forest(*(np.concatenate(x) for x in zip(*found)), place)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    kind = kind_of(max(largest(points), largest(entries)), points.shape[1])
    a, b = points.astype(kind), entries.astype(kind)
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]


def assigned(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of nodes and the entry that they go to: start, end, entry. Ties go to the lower entry."""
    out = [(np.zeros(0, np.int64),) * 3]
    here = forest.levels[0] if forest.levels else np.zeros(0, np.int64)
    for depth in range(len(forest.levels)):
        below = []
        for p in range(len(books)):
            own = here[forest.part[here] == p]
            if not len(own):
                continue
            d = squared(forest.point[own], books[p])
            nearest = d.argmin(axis=1)
            inner = forest.end[own] > own + 1
            whole_tree = np.zeros(len(own), bool)
            if inner.any() and d.dtype != object:
                away = np.sort(np.sqrt(d[inner].astype(np.float64)), axis=1)
                # Every point of the subtree is nearer to the first than to the second, rounding included.
                second = away[:, 1] if away.shape[1] > 1 else np.inf
                whole_tree[inner] = second - away[:, 0] > 2 * forest.radius[own[inner]] + 1e-6 * (1 + away[:, 0])
            out.append((own, np.where(whole_tree, forest.end[own], own + 1), nearest))
            below.append(own[inner & ~whole_tree])
        if depth + 1 == len(forest.levels):
            break
        go = np.concatenate(below) if below else here[:0]
        times = forest.child_end[go] - forest.child[go]
        at = np.repeat(forest.child[go] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        here = forest.levels[depth + 1][at]
    return tuple(np.concatenate(x) for x in zip(*out))


def _packed(forest: Forest, ids: list, labels: pa.Array) -> list:
    wide = forest.point.dtype == object
    one = lambda x, t: pa.array([x.astype(t).tobytes()], pa.binary())
    lists = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    text = [str(x) for x in forest.point.ravel().tolist()] if wide else None
    small = not wide and largest(forest.point) < 1 << 31
    return [
        lists(pa.array(ids, pa.int64())), lists(labels), pa.array([text], pa.list_(pa.string())),
        pa.array([None if wide else forest.point.astype("<i4" if small else "<i8").tobytes()], pa.binary()), pa.array([small], pa.bool_()),
        one(forest.part, "<i2"), one(forest.weight, "<i4"), one(forest.depth, "<i2"), one(forest.radius, "<f8"), one(forest.place, "<i4"),
    ]


PACKED = ["ids", "labels", "text", "point", "small", "part", "weight", "depth", "radius", "place"]


def _schema(label: str) -> str:
    kinds = ["array<long>", f"array<{label}>", "array<string>", "binary", "boolean", *["binary"] * 5]
    return ", ".join(f"{name} {kind}" for name, kind in zip(PACKED, kinds))


def _planted(parts: int, width: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grown(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            column = table.column("vector").combine_chunks()
            values, ends = np.asarray(column.flatten(), np.float64), np.cumsum(column.value_lengths().to_numpy())
            length = np.diff(ends, prepend=0)
            vectors = np.zeros((len(length), width))
            vectors[np.repeat(np.arange(len(length)), length), np.arange(len(values)) - np.repeat(ends - length, length)] = values
            forest = planted(whole(vectors, scale), parts)
            return pa.RecordBatch.from_arrays(_packed(forest, table.column("vec_id").to_pylist(), table.column("label").combine_chunks()), names=PACKED)

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, CHUNK - n)
                batch = batch.slice(take.num_rows)
                held.append(take)
                n += take.num_rows
                if n == CHUNK:
                    yield grown(held)
                    held, n = [], 0
        if n:
            yield grown(held)

    return run


def _forests(batches: Iterator[pa.RecordBatch], size: int, parts: int) -> Iterator[tuple[Forest, pa.RecordBatch]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            raw = lambda name, kind: np.frombuffer(row.column(name)[0].as_py(), kind)
            if row.column("text")[0].is_valid:
                point = np.array([int(x) for x in row.column("text")[0].as_py()], object)
            else:
                point = raw("point", "<i4" if row.column("small")[0].as_py() else "<i8").astype(np.int64)
            yield Forest(
                raw("part", "<i2").astype(np.int64), point.reshape(-1, size), raw("weight", "<i4").astype(np.int64),
                raw("depth", "<i2"), raw("radius", "<f8"), raw("place", "<i4").reshape(parts, -1),
            ), row


def limbs(value: int) -> list[int]:
    """Digits of a whole number to the base 2^32, the last one signed: they may be added one by one."""
    out = []
    while not -(1 << LIMB - 1) <= value < 1 << LIMB - 1:
        out.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*out, value]


def _summed(books: np.ndarray):
    """Sums and counts of each entry, by task, as digits: entry, place (-1: count), limb, n."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, size + 1), object)
        for forest, _ in _forests(batches, size, parts):
            start, end, entry = assigned(forest, books)
            slot = forest.part[start] * entries + entry
            own = np.zeros((parts * entries, size + 1), forest.total.dtype)
            np.add.at(own, slot, np.column_stack([forest.total[end] - forest.total[start], forest.count[end] - forest.count[start]]))
            total += own
        rows = [(s, c, k, v) for s, c in zip(*(x.tolist() for x in np.nonzero(total))) for k, v in enumerate(limbs(int(total[s, c])))]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], names=["entry", "place", "limb", "n"])

    return run


def _coded(books: np.ndarray):
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest, row in _forests(batches, size, parts):
            start, end, entry = assigned(forest, books)
            # Ranges of one walk do not overlap but for subtrees opened up, whose nodes are all decided one by one.
            times = end - start
            at = np.repeat(start - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
            code = np.zeros(len(forest.depth), np.int64)
            code[at] = np.repeat(entry, times)
            codes = code[forest.place]
            ids = row.column("ids").flatten()
            error = 0
            for p in range(parts):
                points, entries_of = forest.point[forest.place[p]], books[p][codes[p]]
                kind = kind_of(max(largest(points), largest(books[p])), size * parts)
                kind = np.int64 if kind is np.float64 else kind
                error = error + ((points.astype(kind) - entries_of.astype(kind)) ** 2).sum(axis=1)
            known = [int(x) if x < 1 << 63 else None for x in error.tolist()]
            digits = np.array([f"{k:02x}" for k in range(256)])
            text = ["".join(x) for x in digits[codes.T].tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(text, pa.string()), pa.array(known, pa.int64()), row.column("labels").flatten()], names=["vec_id", "code", "error", "label"]
            )

    return run


def coded_vectors(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256, codebooks.

    A component x counts as floor(scale * x), `scale` a power of two. Vectors are cut into `parts`
    equal parts; the codebook of each starts with that part of the `entries` (256 at most) smallest
    vec_ids, in their order. Each round assigns all parts to the nearest entry (ties: the lower
    one) and replaces entries by floor(sum / count); unused ones stay. `error` is the sum of final
    squared distances, `code` the entries as two hex digits each, `codebooks` [part][entry] the
    final components as text, joined by commas.

    Null vectors and those with null or non-finite components are left out; zeros fill vectors up
    to the longest one's length, rounded up to a multiple of `parts`. A null vec_id comes last among
    the first entries, vectors of one vec_id in the order of their components; every row counts and
    is returned. Fewer kept vectors than entries make smaller codebooks, none an empty result.
    Numbers beyond 64 bits are computed exactly without trees; an error, or the sum of a label's
    errors, that exceeds 64 bits is null. Other columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.where(vector.isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), vector.alias("vector"))
    label = dict(kept.dtypes)["label"]
    first = [r["vector"] for r in kept.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vec_id", "vector").limit(entries).collect()]
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string, codebooks array<array<string>>")
    size = -(-max(1, kept.agg(F.max(F.size("vector"))).first()[0]) // parts)
    seeds = np.zeros((len(first), size * parts))
    for k, v in enumerate(first):
        seeds[k, : len(v)] = v
    books = whole(seeds, scale).reshape(len(first), parts, size).transpose(1, 0, 2)
    trees = stage(kept.mapInArrow(_planted(parts, size * parts, scale), _schema(label)), "cover-trees")

    for _ in range(rounds):
        found = trees.mapInArrow(_summed(books), "entry long, place long, limb long, n long")
        total = np.zeros((parts * len(first), size + 1), object)
        for r in found.groupBy("entry", "place", "limb").agg(F.sum("n").alias("n")).collect():
            total[r["entry"], r["place"]] += r["n"] << LIMB * r["limb"]
        fresh = books.reshape(-1, size).astype(object)
        used = np.flatnonzero(total[:, size])
        fresh[used] = total[used, :size] // total[used, size:]
        fresh = fresh.reshape(books.shape)
        books = fresh if largest(fresh) >= 1 << 62 else fresh.astype(np.int64)

    coded = stage(trees.mapInArrow(_coded(books), f"vec_id long, code string, error long, label {label}"), "vector-codes")
    exact = F.sum(F.col("error").cast("decimal(38, 0)"))
    by_label = coded.groupBy("label").agg(F.when(F.count("*") == F.count("error"), exact.try_cast("long")).alias("label_error"))
    by_label = stage(by_label.withColumnRenamed("label", "own_label"), "label-errors")
    by_label = broadcast_if_small(by_label, 64)
    lines = [[",".join(map(str, e)) for e in part] for part in books.tolist()]
    digest = hashlib.sha256(",".join(x for part in lines for x in part).encode()).hexdigest()
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("own_label")), "left")
    books_column = F.array(*[F.array(*[F.lit(x) for x in part]) for part in lines])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), books_column.alias("codebooks"))
