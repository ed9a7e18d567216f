"""Ranked lexical search over bags of words that are scored once per class of equal bags.

Documents are restricted to the words of the items. What is left of a document, its word counts,
and its length measure m decide its score for every item, so documents with equal counts and equal
m form a class: classes are hashed, compared in full, scored once, and only the classes that reach
a result are expanded to their documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from branchvoice.llm import words
from branchvoice.llm.stages import BROADCAST_BYTES, ship, slices, stage

#: Results per item.
TOP = 20
#: Text of the items sent to the tasks at once.
SLICE_BYTES = 8 << 20
PIECE = 2 << 20
#: Items are scored in groups of at most so many, and of so many different words (one item at least).
GROUP_ITEMS, GROUP_WORDS = 256, 4096
#: Numbers in the matrix of one batch of classes.
CELLS = 4 << 20
#: A document's count enters its score as (SATURATED * tf) div (STEP * tf + DAMPING * m).
SATURATED, STEP, DAMPING = 1_000_000_000, 1000, 12
#: Salt of the first of two rounds that rank what the tasks found.
SALTS = 64
BAG = np.dtype([("word", "<u4"), ("tf", "<u4")])


def _heads(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word, as a number."""
    padded = np.append(data, np.zeros(8, np.uint8))
    head = np.zeros(len(start), np.uint64)
    for k in range(8):
        head |= np.where(k < length, padded[start + k], 0).astype(np.uint64) << np.uint64(8 * k)
    return head


class Vocabulary:
    """The different words of some texts; a word is known by hash, length and first bytes."""

    def __init__(self, texts: list[str]) -> None:
        found = words.split(pa.array(texts, pa.string()), lower=True, separators=words.NOT_ALNUM)
        self.hash, at, back = np.unique(found.hash, return_index=True, return_inverse=True)
        self.length = (found.end - found.start)[at]
        self.head = _heads(found.data, found.start[at], self.length)
        self.near = np.zeros(1 << 20, bool)
        self.near[(self.hash >> np.uint64(44)).astype(np.int64)] = True
        #: Word numbers of each text, repeats included.
        self.of = [back[found.of(i)] for i in range(len(texts))]

    def __len__(self) -> int:
        return len(self.hash)

    def known(self, found: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that are in the vocabulary, and their numbers."""
        at = np.flatnonzero(self.near[(found.hash >> np.uint64(44)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.hash, found.hash[at]), max(0, len(self) - 1))
        same = self.hash[number] == found.hash[at] if len(self) else np.zeros(len(at), bool)
        at, number = at[same], number[same]
        length = found.end[at] - found.start[at]
        same = (length == self.length[number]) & (_heads(found.data, found.start[at], length) == self.head[number])
        return at[same], number[same]


def _bagged(vocabulary):
    """Number of words and counts of the vocabulary's words of each document that has a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in slices("text", PIECE)(batches):
            found = words.split(batch.column("text"), lower=True, separators=words.NOT_ALNUM)
            at, number = known.known(found)
            text = np.searchsorted(found.first, at, side="right") - 1
            key, tf = np.unique(text * max(1, len(known)) + number, return_counts=True)
            text, number = np.divmod(key, max(1, len(known)))
            pairs = np.empty(len(key), BAG)
            pairs["word"], pairs["tf"] = number, tf
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)) * BAG.itemsize
            bags = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(pairs.tobytes())])
            n = np.diff(found.first)
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), bags], names=["doc_id", "n", "bag"])
            yield out.filter(pa.array(n > 0))

    return run


def _bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all bags of a batch, one after the other, and the bag of each."""
    size = np.array([len(b.as_buffer()) for b in column], np.int64) // BAG.itemsize
    flat = np.frombuffer(b"".join(b.as_py() for b in column), BAG)
    return flat, np.repeat(np.arange(len(size)), size)


def _held(size: int):
    """How many documents hold each word, by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            flat, owner = _bags(batch.column("bag"))
            np.add.at(total, flat["word"].astype(np.int64), batch.column("members").to_numpy()[owner])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["word", "n"])

    return run


@dataclass
class Group:
    """Items scored together: their numbers, their words, and how often each item has each word."""

    items: np.ndarray
    words: np.ndarray
    often: np.ndarray
    exact: type


def groups(vocabulary: Vocabulary, weight: np.ndarray) -> list[Group]:
    out, own, known = [], [], set()

    def close() -> None:
        if own:
            used = np.array(sorted(known), np.int64)
            often = np.zeros((len(own), len(used)), np.int64)
            for row, i in enumerate(own):
                number, times = np.unique(vocabulary.of[i], return_counts=True)
                often[row, np.searchsorted(used, number)] = times
            # Below 2^53 sums of whole numbers are exact in doubles, whatever their order.
            most = (often.astype(object) * weight[used].astype(object)).sum(axis=1).max() * (SATURATED // STEP)
            out.append(Group(np.array(own), used, often, np.float64 if most < 1 << 53 else np.int64))

    for i, number in enumerate(vocabulary.of):
        if not len(number):
            continue
        fresh = set(number.tolist())
        if own and (len(own) == GROUP_ITEMS or len(known | fresh) > GROUP_WORDS):
            close()
            own, known = [], set()
        own.append(i)
        known |= fresh
    close()
    return out


def _first(item, score, nothing, doc, k: int) -> np.ndarray:
    """Indexes of the first `k` of each item, by falling score, then doc_id, nulls last."""
    order = np.lexsort((doc, nothing, -score, item))
    begin = np.flatnonzero(np.append(True, np.diff(item[order]) != 0))
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[rank < k]


FOUND = "item int, score long, class long, nothing boolean, first long"


def _scored(sent, k: int):
    """The best classes of each item in a task, with their scores and first documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, parts = sent.value
        best = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64)]
        floor = {}
        for batch in batches:
            flat, owner = _bags(batch.column("bag"))
            tf, m = flat["tf"].astype(np.int64), batch.column("m").to_numpy()[owner]
            gain = weight[flat["word"]] * ((SATURATED * tf) // (STEP * tf + DAMPING * m))
            own = [batch.column("class").to_numpy(), batch.column("nothing").to_numpy(zero_copy_only=False), batch.column("first").fill_null(0).to_numpy()]
            for g, part in enumerate(parts):
                place = np.full(len(weight), -1)
                place[part.words] = np.arange(len(part.words))
                column = place[flat["word"]]
                least = floor.setdefault(g, np.ones(len(part.items), np.int64))
                rows = max(1, CELLS // (len(part.words) + len(part.items)))
                often = part.often.T.astype(part.exact)
                for start in range(0, batch.num_rows, rows):
                    stop = min(batch.num_rows, start + rows)
                    a, b = np.searchsorted(owner, [start, stop])
                    use = a + np.flatnonzero(column[a:b] >= 0)
                    matrix = np.zeros((stop - start, len(part.words)), part.exact)
                    matrix[owner[use] - start, column[use]] = gain[use]
                    score = (matrix @ often).astype(np.int64)
                    row, item = np.nonzero(score >= least)
                    fresh = [part.items[item], score[row, item], *(x[start + row] for x in own)]
                    best = [np.concatenate(x) for x in zip(best, fresh)]
                    if len(best[0]) > 8 * k * sum(len(p.items) for p in parts):
                        best = cut(best, k)
                        raise_floor(best, part, least, k)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cut(best, k), (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()))], names=["item", "score", "class", "nothing", "first"])

    def cut(best: list, k: int) -> list:
        item, score, number, nothing, first = best
        if not len(item):
            return best
        keep = _first(item, score, nothing, first, k)
        return [x[keep] for x in best]

    def raise_floor(best: list, part: Group, least: np.ndarray, k: int) -> None:
        """A score below an item's k-th so far is not looked at again."""
        item, score = best[0], best[1]
        for j, i in enumerate(part.items.tolist()):
            a, b = np.searchsorted(item, [i, i + 1])
            if b - a == k:
                least[j] = max(least[j], score[b - 1])

    return run


def _top(rows: DataFrame, k: int, *keys) -> DataFrame:
    own = Window.partitionBy(*keys).orderBy(F.desc("score"), "nothing", "first")
    return rows.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the `top` highest-scoring documents of each item.

    Words are maximal runs of ASCII letters, digits and characters outside ASCII, lower-cased in
    A-Z. With N documents that have a word, L words in all of them, n words in one of them and df
    documents that hold a word: its weight w is floor(1000 * ln((2N + 2) / (2 df + 1))), a document's
    m is 75 + (25 n N) div L, and the score is the sum of w * (10^9 tf div (1000 tf + 12 m)) over the
    item's words, repeats included. Only scores above 0 are returned; equal scores go by doc_id.

    Each class of equal counts and m is a row with its number of documents and its first doc_id.
    A document among the first `top` lies in a class among the first `top` by score and first
    doc_id, as the first document of every class before it comes before it too. So only those
    classes are expanded, and of a class no more than its `top` smallest doc_ids are needed, however
    many documents it has.

    Null and empty texts have no words and are in no result or count. Every row is a document;
    repeated rows of a doc_id are ranked one by one. A null doc_id comes after all others. Equal
    items are one; several texts under one item_id are ranked each by itself; an item without
    words has no rows. Items beyond `slice_bytes` are searched for in so many slices. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    asked = stage(items.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct(), "search-items")
    parts = (asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // slice_bytes + 1
    found = None
    for part in range(parts):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        rows = _searched(texts, [r["item_id"] for r in own], [r["text"] for r in own], top)
        found = rows if found is None else found.union(rows)
    return found


def _searched(texts: DataFrame, ids: list[int | None], items: list[str], top: int) -> DataFrame:
    spark = texts.sparkSession
    vocabulary = Vocabulary(items)
    bags = stage(texts.mapInArrow(_bagged(spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, bag binary"), "bags")
    documents, length = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"75 + CAST((CAST(25 AS DECIMAL(38, 0)) * n * {documents}) DIV {max(1, length)} AS BIGINT)")
    placed = bags.where(F.octet_length("bag") > 0).select("doc_id", m.alias("m"), F.xxhash64("bag").alias("digest"), "bag")

    # Rows meet by hash; the bag is part of the key, so that only equal ones are one class.
    classes = placed.groupBy("digest", "m", "bag").agg(
        F.count("*").alias("members"), F.min(F.struct(F.col("doc_id").isNull().alias("nothing"), F.col("doc_id").alias("first"))).alias("least")
    )
    classes = stage(classes.select("digest", "m", "bag", "members", "least.*", F.monotonically_increasing_id().alias("class")), "classes")
    held = classes.select("bag", "members").mapInArrow(_held(len(vocabulary)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = np.zeros(len(vocabulary), np.int64)
    for r in held.collect():
        df[r["word"]] = r["n"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    sent = spark.sparkContext.broadcast((weight, groups(vocabulary, weight)))
    scored = classes.select("class", "m", "bag", "nothing", "first").mapInArrow(_scored(sent, top), FOUND)
    scored = _top(scored, top, "item", F.pmod("class", F.lit(SALTS))).drop("rank")
    best = stage(_top(scored, top, "item").drop("rank", "nothing", "first"), "best-classes")

    wanted = best.select("class").distinct()
    wanted = F.broadcast(wanted) if best.count() * 24 <= BROADCAST_BYTES else wanted
    chosen = stage(classes.select("class", "digest", "m", "bag").join(wanted, "class"), "chosen-classes")
    size = chosen.agg(F.sum(F.octet_length("bag").cast("long") + 64)).first()[0] or 0
    members = placed.join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, ["digest", "m", "bag"])
    members = members.select("class", F.col("doc_id").isNull().alias("nothing"), F.col("doc_id").alias("first"))
    ascending = Window.partitionBy("class").orderBy("nothing", "first")
    members = members.withColumn("place", F.row_number().over(ascending)).where(F.col("place") <= top).drop("place")
    ranked = _top(best.join(members, "class"), top, "item")
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    return ranked.join(names, "item").select("item_id", "rank", F.col("first").alias("doc_id"), "score")
