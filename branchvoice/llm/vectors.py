"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Unit vectors are quantised to int8 once, with a scale of their own; the exact length of what rounding
took away bounds how far a quantised product can be from the cosine. Tiles of products, to which
only codes travel, tell pairs that are surely linked or surely not; for the others, in a narrow band
around the threshold, the tile gets the full vectors and computes in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchvoice.llm.graph import components
from branchvoice.llm.stages import stage

#: Vectors on each side of a tile, and of the squares it is worked off in.
TILE, SQUARE = 8192, 1024
#: Above this share of possible pairs a square is computed again as a whole.
DENSE = 0.02
#: Tasks of one round over all tiles at most; each works off its tiles one after the other.
MOST_PARTITIONS = 20_000


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and lengths of the rounding errors (rounded up) of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return codes, scale, error


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1. A power of two is taken out first, so that no square overflows or vanishes."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def judged(a: tuple, b: tuple, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose cosine surely is `least` or more, and pairs that may be either way.

    |u.v - su sv qu.qv| <= |eu| + (1 + |eu|) |ev|, for codes q, scales s and rounding errors e.
    """
    (qa, sa, ea), (qb, sb, eb) = a, b
    kind = np.float32 if qa.shape[1] <= 1024 else np.float64  # sums of products of int8 are exact in it
    product = qa.astype(kind) @ qb.astype(kind).T
    slack = float(ea.max() + (1 + ea.max()) * eb.max()) + 1e-6
    maybe = product >= ((least - slack) / sa).astype(kind)[:, None] * (1 / sb).astype(kind)[None, :] * kind(1 - 1e-6)
    i, j = np.nonzero(maybe)
    about, error = sa[i] * sb[j] * product[i, j], ea[i] + (1 + ea[i]) * eb[j] + 1e-12
    sure, open_ = np.zeros_like(maybe), np.zeros_like(maybe)
    above = about - error >= least
    sure[i[above], j[above]] = True
    either = ~above & (about + error >= least)
    open_[i[either], j[either]] = True
    return sure, open_


def linked(a: np.ndarray, b: np.ndarray, maybe: np.ndarray, least: float) -> np.ndarray:
    """Of these pairs, those whose cosine in double precision is `least` or more."""
    i, j = np.nonzero(maybe)
    if len(i) > DENSE * maybe.size:
        return maybe & (a @ b.T >= least)
    out = np.zeros_like(maybe)
    good = np.einsum("ij,ij->i", a[i], b[j]) >= least
    out[i[good], j[good]] = True
    return out


def tied(link: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of a square that have links, and for each the column it is tied to."""
    rows, columns = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    own = link[np.ix_(rows, columns)]
    label = np.arange(len(columns))
    while True:
        of_row = np.where(own, label[None, :], len(columns)).min(axis=1)
        new = np.minimum(label, np.where(own, of_row[:, None], len(columns)).min(axis=0))
        if (new == label).all():
            return rows, columns[of_row], columns, columns[label]
        label = new


def _matrix(column: pa.Array, kind: type, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1)


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of each vector, with their scale and error."""
    for batch in batches:
        n = batch.num_rows
        size = batch.column("vector").value_lengths().to_numpy()
        flat, ends = np.asarray(batch.column("vector").flatten(), np.float64), np.cumsum(size)
        codes, scales, errors = [None] * n, np.zeros(n), np.zeros(n)
        for length in np.unique(size):
            at = np.flatnonzero(size == length)
            q, scales[at], errors[at] = quantised(unit(flat[(ends[at] - length)[:, None] + np.arange(length)]))
            for k, row in zip(at.tolist(), q):
                codes[k] = row.tobytes()
        keep = [batch.column(c) for c in ("node", "least", "copies", "size")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(codes, pa.binary()), pa.array(scales), pa.array(errors)], names=["node", "least", "copies", "size", "code", "scale", "error"])


class Side:
    """One side of a tile, sorted by node: codes and, where they are needed, full vectors."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks().sort_by("node")
        n = table.num_rows
        self.node, self.copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        codes = table.column("code").combine_chunks()
        self.codes = (_matrix(codes, np.int8, n), table.column("scale").to_numpy(), table.column("error").to_numpy())
        self.unit = None
        if "vector" in table.column_names:
            flat = table.column("vector").combine_chunks()
            self.unit = unit(np.asarray(flat.flatten(), np.float64).reshape(n, -1))

    def part(self, own: slice) -> tuple:
        return tuple(p[own] for p in self.codes)


def _tile(least: float, exact: bool):
    """Links of a tile: those that the codes prove, or (`exact`) of the pairs that they leave open.

    Rows (a, b, n): ties (n = 0) that keep connected what is connected; link counts of node a (n > 0);
    and from the first round nodes with an open pair (n = -1 on the left, -2 on the right side).
    """

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, n = [], [], []

        def out(first: np.ndarray, second: np.ndarray, number) -> None:
            a.append(first)
            b.append(second)
            n.append(np.broadcast_to(number, len(first)))

        if left.num_rows and right.num_rows:
            own = key[0].as_py() == key[1].as_py()
            x, y = Side(left), Side(right)
            links_a, links_b = np.zeros(len(x.node), np.int64), np.zeros(len(y.node), np.int64)
            open_a, open_b = np.zeros(len(x.node), bool), np.zeros(len(y.node), bool)
            for r in range(0, len(x.node), SQUARE):
                for c in range(0, len(y.node), SQUARE):
                    u, v = slice(r, r + SQUARE), slice(c, c + SQUARE)
                    if own and y.node[v][-1] <= x.node[u][0]:
                        continue
                    link, either = judged(x.part(u), y.part(v), least)
                    if own:
                        once = x.node[u][:, None] < y.node[v][None, :]
                        link, either = link & once, either & once
                    if exact:
                        link = linked(x.unit[u], y.unit[v], either, least) if either.any() else either
                    else:
                        open_a[u] |= either.any(axis=1)
                        open_b[v] |= either.any(axis=0)
                    if not link.any():
                        continue
                    links_a[u] += link @ y.copies[v]
                    links_b[v] += x.copies[u] @ link
                    rows, row_to, columns, column_to = tied(link)
                    out(x.node[u][rows], y.node[v][row_to], 0)
                    out(y.node[v][columns], y.node[v][column_to], 0)
            for side, links, open_, mark in ((x, links_a, open_a, -1), (y, links_b, open_b, -2)):
                out(side.node[links > 0], side.node[links > 0], links[links > 0])
                out(side.node[open_], side.node[open_], mark)
        join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        rows = len(join(a))
        tile = [pa.array(np.full(rows, k.as_py() or 0), pa.int64()) for k in key]
        return pa.table([*tile, join(a), join(b), join(n)], names=["i", "j", "size", "a", "b", "n"])

    return run


def usable(vector: Column) -> Column:
    """A vector that has a direction: not null, only finite numbers, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(rows: DataFrame, least: float = 0.9, tile: int = TILE) -> DataFrame:
    """Per vector: vec_id, n_links (other vectors with cosine >= least), component_id, kept.

    Equal vectors are one node with a number of copies. Nodes are quantised once and dealt into
    blocks by hash; each pair of blocks of vectors of one length is a tile worked off by one task on
    the codes, an eighth of the bytes. It returns link counts and, instead of pairs, ties that keep
    connected what is connected, and the vectors with a pair that the codes leave open; the second
    round brings those vectors, and no others, to their tiles. All pairs of blocks are compared: the work
    grows with the square of the number of different vectors.

    Null, zero and non-finite vectors link with nothing; vectors of different lengths neither;
    components may be as large or small as doubles can be. Every row is a vector of its own, also where
    rows share a vec_id: links are counted between rows, and component_id is the least vec_id of the
    rows reached. A null vec_id links with nothing, has a null component and is kept. Other columns
    are not read.
    """
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    base = base.withColumn("good", usable(F.col("vector")) & F.col("vec_id").isNotNull())
    grouped = base.where("good").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = stage(grouped.select("vector", "least", "copies", F.size("vector").cast("long").alias("size"), F.monotonically_increasing_id().alias("node")), "vectors")
    schema = "node long, least long, copies long, size long, code binary, scale double, error double"
    codes = stage(nodes.select("vector", "node", "least", "copies", "size").mapInArrow(_quantised, schema), "vector-codes")
    counts = stage(codes.groupBy("size").agg(F.ceil(F.count("*") / tile).alias("blocks")), "vector-blocks")
    placed = codes.join(F.broadcast(counts) if counts.count() < 10_000 else counts, "size").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    key, columns = ["i", "j", "size"], ["node", "copies", "code", "scale", "error"]
    last = F.col("blocks") - 1
    left = placed.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence("block", last)))
    right = placed.withColumn("j", F.col("block")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), "block")))
    left, right = (x.select(*[F.col(c).alias(c) for c in (*key, *columns)]) for x in (left, right))
    out = "i long, j long, size long, a long, b long, n long"
    # A tile's work goes with its rows on both sides, not with its bytes: partitions are not joined again.
    tiles = lambda x: x.repartition(tile_parts, *key).groupBy(*key)
    pairs = counts.agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()[0] or 0
    tile_parts = max(1, min(MOST_PARTITIONS, int(pairs)))
    found = stage(tiles(left).cogroup(tiles(right)).applyInArrow(_tile(least, False), out), "vector-links")

    full = nodes.select(F.col("node").alias("a"), "vector")
    again = []
    for mark, side in ((-1, left), (-2, right)):
        asked = found.where(F.col("n") == mark).select(*key, "a").join(full, "a")
        asked = asked.select(*key, F.col("a").alias("node"), "vector").join(codes.select("node", "copies", "code", "scale", "error"), "node")
        again.append(asked.select(*[F.col(c).alias(c) for c in (*key, *columns, "vector")]))
    more = stage(tiles(again[0]).cogroup(tiles(again[1])).applyInArrow(_tile(least, True), out), "exact-links")

    found = found.where("n >= 0").unionByName(more)
    label = stage(components(found.where("n = 0").select("a", "b")), "vector-labels")
    links = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    known = nodes.join(links, "node", "left").join(label.withColumnRenamed("id", "node"), "node", "left").select(
        "vector", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "node").alias("component")
    )
    known = stage(known, "linked-vectors")
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(named, "component").select("vector", "links", "component_id", F.lit(True).alias("good"))
    return base.join(known, ["vector", "good"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
