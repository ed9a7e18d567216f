"""Documents packed into sequences of a fixed number of tokens, shortest pack first.

Packing is decided on the histogram of lengths alone: lengths are placed longest first, each into
the pack that holds least so far, many documents at a time, so that the driver works on a few
thousand pattern counts however many documents there are. Documents find their places by their
rank among those of their length.
"""

from __future__ import annotations

import uuid
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from branchvoice.llm.stages import broadcast_if_small, ship, slices, stage
from branchvoice.llm.token_files import encoder_of

#: Tokens of a sequence, and the space that is worth a cut.
LENGTH, WORTH = 2048, 16
PIECE = 1 << 20


@dataclass
class Slot:
    """A piece of documents of one length: the pack's first has rank `rank` among them, the next `rank` + 1 ..."""

    of: int
    rank: int
    start: int
    length: int


@dataclass
class Packs:
    """`count` packs of one pattern, which hold `used` tokens each of at most `room`."""

    count: int
    room: int
    used: int = 0
    slots: list[Slot] = field(default_factory=list)

    @property
    def space(self) -> int:
        return self.room - self.used

    def cut(self, n: int) -> Packs:
        """Split off the packs behind the first `n`."""
        rest = Packs(self.count - n, self.room, self.used, [Slot(s.of, s.rank + n, s.start, s.length) for s in self.slots])
        self.count = n
        return rest

    def add(self, of: int, rank: int, start: int, length: int) -> None:
        self.slots.append(Slot(of, rank, start, length))
        self.used += length


def shortest_pack_first(histogram: dict[int, int], room: int) -> list[Packs]:
    """Place all lengths, longest first, each document into the pack that holds least of those it fits in."""
    by_used: list[list[Packs]] = [[] for _ in range(room + 1)]
    for length in sorted(histogram, reverse=True):
        rank, n = 0, histogram[length]
        for used in range(1, room - length + 1):
            # Packs move up as they are filled, so that one pass meets them all in order.
            while n and by_used[used]:
                packs = by_used[used].pop()
                if packs.count > n:
                    by_used[used].append(packs.cut(n))
                packs.add(length, rank, 0, length)
                by_used[packs.used].append(packs)
                rank, n = rank + packs.count, n - packs.count
        while n:
            # A new pack is the shortest until it is full.
            each = min(room // length, n)
            packs = Packs(n // each, room)
            for _ in range(each):
                packs.add(length, rank, 0, length)
                rank, n = rank + packs.count, n - packs.count
            by_used[packs.used].append(packs)
    return [p for group in by_used for p in group]


def fill(donors: Packs, takers: list[Packs]) -> tuple[list[Packs], list[tuple[int, Slot]]]:
    """Hand the pieces of all `donors` packs on: whole into the smallest space that holds them, else cut to fill the largest.

    Returns the takers as they then are, and the pieces left (so many documents from slot.rank on).
    """
    done = [p for p in takers if not p.space]
    free = sorted((p for p in takers if p.space), key=lambda p: p.space)
    left = sorted(((donors.count, s) for s in donors.slots), key=lambda x: x[1].length)
    rest = []
    while left:
        n, slot = left.pop()
        if not free:
            rest.append((n, slot))
            continue
        at = next((i for i, p in enumerate(free) if p.space >= slot.length), len(free) - 1)
        taker = free.pop(at)
        k, size = min(n, taker.count), min(slot.length, taker.space)
        if taker.count > k:
            insort(free, taker.cut(k), key=lambda p: p.space)
        taker.add(slot.of, slot.rank, slot.start, size)
        if taker.space:
            insort(free, taker, key=lambda p: p.space)
        else:
            done.append(taker)
        if n > k:
            left.append((n - k, Slot(slot.of, slot.rank + k, slot.start, slot.length)))
        if size < slot.length:
            left.append((k, Slot(slot.of, slot.rank, slot.start + size, slot.length - size)))
    return done + free, rest


def packed_lengths(histogram: dict[int, int], room: int = LENGTH, worth: int = WORTH) -> list[Packs]:
    """Patterns of all packs, with their counts.

    After shortest-pack-first, the shortest packs are given up as long as the space of `worth` tokens
    or more in the others takes their pieces, cut where they must be. The last one that cannot be
    given up whole becomes sequences whose sizes are powers of two, which need no padding.
    """
    packs = shortest_pack_first(histogram, room)
    done, opened = [p for p in packs if p.space < worth], [p for p in packs if p.space >= worth]
    while opened:
        opened.sort(key=lambda p: p.used)
        short, others = opened[0], opened[1:]
        given = min(short.count, sum(p.count * p.space for p in opened) // room)
        if not given:
            break
        if short.count > given:
            others.append(short.cut(given))
        packs, rest = fill(short, others)
        if rest:
            raise AssertionError("pieces were left although the space had been counted")
        done += [p for p in packs if p.space < worth]
        opened = [p for p in packs if p.space >= worth]
    if opened:
        short, others = opened[0], opened[1:]
        if short.count > 1:
            others.append(short.cut(1))
        packs, rest = fill(short, others)
        done += packs
        tokens = sum(n * s.length for n, s in rest)
        small = [Packs(1, 1 << b) for b in range(tokens.bit_length()) if tokens >> b & 1]
        for n, slot in rest:
            small, none = fill(Packs(n, room, slot.length, [slot]), small)
            if none:
                raise AssertionError("pieces were left although the space had been counted")
        done += small
    return done


@dataclass
class Places:
    """Where the documents of each length go: `of`, `rank`, `count`, `start`, `length`, `sequence`, `offset` of each slot.

    There are as many as the patterns have pieces, a number that depends on the sequence length and
    not on the number of documents.
    """

    rows: np.ndarray
    #: Number of the first sequence that holds a full piece.
    full: int
    room: int

    def __post_init__(self) -> None:
        of, rank, count = self.rows[:, 0], self.rows[:, 1], self.rows[:, 2]
        # Cut pieces of one document have ranges of their own: split all ranges of a length at each other's ends.
        low, high = of << 48 | rank, of << 48 | (rank + count)
        self.begin = np.unique(np.concatenate([low, high]))
        first, last = np.searchsorted(self.begin, low), np.searchsorted(self.begin, high)
        at = _each(first, last - first)
        row = np.repeat(np.arange(len(of)), last - first)
        order = np.lexsort((self.rows[row, 3], at))
        self.row, at = row[order], at[order]
        self.first = np.searchsorted(at, np.arange(len(self.begin) + 1))

    def of(self, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and slot of all pieces of documents with rests of these lengths and ranks, in order."""
        at = np.searchsorted(self.begin, rest << 48 | rank, side="right") - 1
        times = np.where(rest > 0, self.first[at + 1] - self.first[at], 0)
        return np.repeat(np.arange(len(rest)), times), self.row[_each(self.first[at], times)]


def _each(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Numbers first, first + 1, ... of each range, one range after the other."""
    return np.repeat(first - np.cumsum(times) + times, times) + np.arange(int(times.sum()))


def places(packs: list[Packs], room: int) -> Places:
    rows, sequence = [], 0
    for p in packs:
        offset = 0
        for s in p.slots:
            rows.append((s.of, s.rank, p.count, s.start, s.length, sequence, offset))
            offset += s.length
        sequence += p.count
    return Places(np.array(rows, np.int64).reshape(-1, 7), sequence, room)


def _encoded(path: str, end: int, room: int):
    """Ids of each document, and its ranks in this task: among those of its rest, and of its full pieces."""
    this_run = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(this_run, path), TaskContext.get().partitionId()
        seen, full = np.zeros(room, np.int64), 0
        for batch in slices("text", PIECE)(batches):
            ids, n = encoder.ids(batch.column("text"), end)
            ends = np.concatenate([[0], np.cumsum(n)]) * 4
            raw = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            whole, rest = np.divmod(n, room)
            order = np.argsort(rest, kind="stable")
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n)) - np.searchsorted(rest[order], rest[order])
            rank += seen[rest]
            seen += np.bincount(rest, minlength=room)
            before = full + np.cumsum(whole) - whole
            full += int(whole.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), raw, *(pa.array(x, pa.int64()) for x in (n, rest, rank, before, np.full(len(n), part)))],
                names=["doc_id", "ids", "doc_tokens", "rest", "rank", "full", "part"],
            )

    return run


def _pieces(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices("ids", 4 * PIECE)(batches):
            tokens, rest, rank, full = (batch.column(c).to_numpy() for c in ("doc_tokens", "rest", "rank", "full"))
            whole = tokens // known.room
            doc = np.repeat(np.arange(len(whole)), whole)
            at = _each(np.zeros(len(whole), np.int64), whole)
            parts = [(doc, at * known.room, np.full(len(doc), known.room), known.full + full[doc] + at, np.zeros(len(doc), np.int64))]
            if len(known.rows):
                doc, row = known.of(rest, rank)
                own = known.rows[row]
                parts.append((doc, whole[doc] * known.room + own[:, 3], own[:, 4], own[:, 5] + rank[doc] - own[:, 1], own[:, 6]))
            doc, start, length, sequence, offset = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, doc))
            doc, start, length, sequence, offset = (x[order] for x in (doc, start, length, sequence, offset))
            # Pieces in order are the documents in order: the ids stay where they are.
            data = b"".join(batch.column("ids").to_pylist())
            ends = np.concatenate([[0], np.cumsum(length)]) * 4
            ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length)), ids, *(pa.array(x, pa.int64()) for x in (tokens[doc], sequence, offset))],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def packed(docs: DataFrame, tokenizer: str, end: int = 1, room: int = LENGTH, worth: int = WORTH) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's ids are those of the byte-level `tokenizer` file, then `end`. They are cut at
    multiples of `room`, a power of two; full pieces are sequences of their own. The rests are
    packed by their lengths alone, see `packed_lengths`, and meet their packs by rank: the
    documents of a length before them in their task and in the tasks before. A sequence's pieces
    follow each other from offset 0 on; sequence ids are gapless from 0.

    Null text is empty and has one id, the end. Every row is a document, whatever its doc_id; a null
    one stays null. An empty table has no pieces. Other columns are not read. Encoding writes all
    ids to the shared folder once; the driver sees a count for each length.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, ids binary, doc_tokens long, rest long, rank long, full long, part long"
    coded = stage(texts.mapInArrow(_encoded(tokenizer, end, room), schema), "packing-ids")

    counts = stage(coded.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.expr(f"doc_tokens DIV {room}")).alias("whole")), "packing-lengths")
    histogram = {r["rest"]: r["n"] for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    sent = spark.sparkContext.broadcast(places(packed_lengths(histogram, room, worth), room))

    earlier = lambda column, *keys: F.coalesce(F.sum(column).over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = counts.groupBy("part").agg(F.sum("whole").alias("whole")).select("part", earlier("whole").alias("full_before"))
    before = counts.select("part", "rest", earlier("n", "rest").alias("rank_before")).join(whole, "part")
    before = broadcast_if_small(stage(before, "packing-ranks"), 32)
    placed = coded.join(before, ["part", "rest"]).select(
        "doc_id", "ids", "doc_tokens", "rest", (F.col("rank") + F.col("rank_before")).alias("rank"), (F.col("full") + F.col("full_before")).alias("full")
    )
    return placed.mapInArrow(_pieces(sent), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
