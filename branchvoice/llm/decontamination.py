"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment.

Test items are small enough to send to every task in slices of a fixed size. An alignment of score s
keeps at least s - 1 neighbouring word pairs of the item, as each break between runs of equal words
costs one. So a document needs a known number of an item's pairs, and all but that number less one
suffice to find it: the item's rarest, counted in all documents, are its seeds. Nothing is lost by
leaving the others out, however common they are. Pairs of one alignment lie on diagonals no further
apart than the gaps that its score allows; passages with so many pairs on so few diagonals are
aligned with the item, word by word, so that edited and partly rewritten copies score as well as
exact ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchvoice.llm import words
from branchvoice.llm.stages import slices, stage

#: Candidate pairs of document and item are checked so many item words at a time.
CHECKED = 1 << 20
MATCH, MISMATCH, GAP = 1.0, -1.0, -1.0
#: An item is found where the best alignment reaches this share of the item's own score.
SHARE = 0.4
#: Text of the items sent to the tasks at once.
SLICE_BYTES = 8 << 20
PIECE = 2 << 20


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment score of two word sequences, and the passage words it covers (start, end)."""
    m = len(passage)
    slope = -GAP * np.arange(m + 1)
    above, above_from = np.zeros(m + 1), np.arange(m + 1)
    best, span = 0.0, (0, 0)
    for word in item:
        here = np.zeros(m + 1)
        came = np.arange(m + 1)
        step = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        better = step > 0
        here[1:][better], came[1:][better] = step[better], above_from[:-1][better]
        skip = above + GAP
        better = skip > here
        here[better], came[better] = skip[better], above_from[better]
        # Gaps in the item's row: the best earlier column less the way from it.
        raised = here + slope
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, np.arange(m + 1), 0))
        here, came = top - slope, came[source]
        above, above_from = here, came
        at = int(here.argmax())
        if here[at] > best:
            best, span = float(here[at]), (int(came[at]), at)
    return best, *span


def _join(parts: list[np.ndarray], kind=np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _each(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Numbers first, first + 1, ... of each range, one range after the other."""
    return np.repeat(first - np.cumsum(times) + times, times) + np.arange(int(times.sum()))


class Places:
    """The items of each n-gram, by n-gram."""

    def __init__(self, gram: np.ndarray, item: np.ndarray, widths: list[int]) -> None:
        order = np.argsort(gram, kind="stable")
        self.item, self.widths = item[order], widths
        self.distinct, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.near = np.zeros(1 << 20, bool)
        self.near[(self.distinct >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, found: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """Text and index of the n-gram, for each n-gram of an item."""
        texts, grams = [], []
        for n in self.widths:
            h = words.grams(found.hash, n)
            at = np.flatnonzero(self.near[(h >> np.uint64(44)).astype(np.int64)])
            index = np.searchsorted(self.distinct, h[at])
            same = index < len(self.distinct)
            same[same] = self.distinct[index[same]] == h[at[same]]
            at, index = at[same], index[same]
            text = np.searchsorted(found.first, at, side="right") - 1
            inside = at + n <= found.first[text + 1]
            texts.append(text[inside])
            grams.append(index[inside])
        return _join(texts), _join(grams)


class Items:
    """Items of a slice, their pairs of neighbouring words (or single words) and how many a document needs."""

    def __init__(self, ids: list[int], texts: list[str], share: float) -> None:
        found = words.split(pa.array(texts, pa.string()), lower=True, separators=words.NOT_ALNUM)
        own = [found.hash[found.of(i)] for i in range(len(ids))]
        some = [i for i, w in enumerate(own) if len(w)]
        self.ids, self.words = [ids[i] for i in some], [own[i] for i in some]
        self.share = share
        self.pair = [words.grams(w, min(2, len(w))) for w in self.words]
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.size = np.array([len(g) for g in self.pair], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.item = np.repeat(np.arange(len(self.words)), self.size)
        gram, widths = _join(self.pair, np.uint64), sorted({min(2, len(w)) for w in self.words})
        self.pairs = self.seeds = Places(gram, self.item, widths)
        self.index = np.searchsorted(self.pairs.distinct, gram)
        self.least = np.ceil(share * self.length - 1e-9).astype(np.int64)
        self.need = np.maximum(self.least - 1, 1)

    def keep_rarest(self, documents: np.ndarray) -> None:
        """Seeds are each item's rarest pairs, by the documents that hold each n-gram: all but need - 1."""
        order = np.lexsort((documents[self.index], self.item))
        rank = np.arange(len(order)) - np.repeat(self.start, self.size)
        keep = order[rank < (self.size - self.need + 1)[self.item]]
        self.seeds = Places(self.pairs.distinct[self.index[keep]], self.item[keep], self.pairs.widths)

    def candidates(self, found: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """Text and item of all texts with as many of an item's pairs as an alignment needs."""
        text, gram = self.seeds.hits(found)
        if not len(text):
            return text, gram
        grams = len(self.pairs.distinct)
        text, gram = np.divmod(np.unique(text * grams + gram), grams)
        times = self.seeds.count[gram]
        pair = np.unique(np.repeat(text, times) * len(self.ids) + self.seeds.item[_each(self.seeds.first[gram], times)])
        text, item = np.divmod(pair, len(self.ids))
        held_text, held_gram = self.pairs.hits(found)
        held = np.unique(held_text * grams + held_gram)
        kept = []
        ends = np.cumsum(self.size[item])
        start = 0
        while start < len(item):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHECKED, side="right")))
            times = self.size[item[start:stop]]
            key = np.repeat(text[start:stop] * grams, times) + self.index[_each(self.start[item[start:stop]], times)]
            at = np.minimum(np.searchsorted(held, key), len(held) - 1)
            held_each = np.add.reduceat((held[at] == key).astype(np.int64), np.cumsum(times) - times)
            kept.append(start + np.flatnonzero(held_each >= self.need[item[start:stop]]))
            start = stop
        chosen = _join(kept)
        return text[chosen], item[chosen]

    def passages(self, item: int, text: np.ndarray, grams: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
        """Word ranges of a text that hold every sufficient alignment: as many pairs as it needs, their diagonals no further apart than its gaps."""
        size = int(self.length[item])
        n = min(2, size)
        if n not in grams:
            g = words.grams(text, n)
            order = np.argsort(g, kind="stable")
            grams[n] = g[order], order
        known, place = grams[n]
        own = self.pair[item]
        first = np.searchsorted(known, own)
        times = np.searchsorted(known, own, side="right") - first
        # Where the item would begin if the pair's words were its only ones to match.
        begin = np.sort(place[_each(first, times)] - np.repeat(np.arange(len(own)), times))
        last = np.searchsorted(begin, begin + (size - int(self.least[item])), side="right")
        enough = np.flatnonzero(last - np.arange(len(begin)) >= self.need[item])
        if not len(enough):
            return
        low, high = begin[enough], np.maximum.accumulate(begin[last[enough] - 1] + size)
        cut = np.flatnonzero(low[1:] > high[:-1])
        for a, b in zip(low[np.append(0, cut + 1)].tolist(), high[np.append(cut, len(high) - 1)].tolist()):
            yield max(0, a), min(len(text), b)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, words.Words]]:
    for batch in slices("text", PIECE)(batches):
        yield batch, words.split(batch.column("text"), lower=True, separators=words.NOT_ALNUM)


def _counted(items):
    """How many documents hold each n-gram, by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        grams = len(known.pairs.distinct)
        total = np.zeros(grams, np.int64)
        for _, found in _cut(batches):
            text, gram = known.pairs.hits(found)
            total += np.bincount(np.unique(text * grams + gram) % max(1, grams), minlength=grams)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "n"])

    return run


def _aligned(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        for batch, found in _cut(batches):
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            last, own, grams = -1, found.hash[:0], {}
            for t, i in zip(*(x.tolist() for x in known.candidates(found))):
                if t != last:
                    last, own, grams = t, found.hash[found.of(t)], {}
                for a, b in known.passages(i, own, grams):
                    score, x, y = align(known.words[i], own[a:b])
                    score /= MATCH * len(known.words[i])
                    if score >= known.share and score > best.get((t, i), (0.0,))[0]:
                        best[t, i] = (score, a + x, a + y)
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[t], known.ids[i], *v) for (t, i), v in best.items()]
            yield pa.RecordBatch.from_pydict(
                {k: [r[j] for r in rows] for j, k in enumerate(("doc_id", "item_id", "score", "start_word", "end_word"))},
                schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]),
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rows (doc_id, item_id, score, start_word, end_word) of documents that hold a test item.

    Words are runs of letters and digits, lower-cased in A-Z; score is the best alignment's share of
    the item's own score, at least `share`; the words of the document it covers are
    [start_word, end_word). One row per document row and item. Every document whose score suffices is
    found, however its words are spread and in however many documents they occur; items of fewer than
    three words are sought as a whole. Null or wordless texts and items are never found; a null doc_id
    is reported as null; repeated rows are reported one by one. Other columns of either table are not
    read. A benchmark beyond `slice_bytes` is searched for in so many slices, one pass each.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = stage(benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // slice_bytes + 1
    found = None
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        own = Items([r["item_id"] for r in rows], [r["text"] for r in rows], share)
        sent = spark.sparkContext.broadcast(own)
        counts = texts.select("text").mapInArrow(_counted(sent), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        in_documents = np.zeros(len(own.pairs.distinct), np.int64)
        for r in counts.collect():
            in_documents[r["gram"]] = r["n"]
        own = Items([r["item_id"] for r in rows], [r["text"] for r in rows], share)
        own.keep_rarest(in_documents)
        hits = texts.mapInArrow(_aligned(spark.sparkContext.broadcast(own)), "doc_id long, item_id long, score double, start_word long, end_word long")
        found = hits if found is None else found.union(hits)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents in which no test item is found, columns unchanged; rows with a null doc_id stay."""
    gone = stage(contaminated(docs, benchmark, **parameters).where("doc_id IS NOT NULL").select("doc_id").distinct(), "contaminated")
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
