"""Removal of repeated passages by suffix automata of reference shards.

A passage of `window` words that two documents share contains the same lowest n-gram (its anchor).
Anchors that only one document has need no further look. Around the others the words are cut out,
equal cuts are made one, and every shard of cuts builds the suffix automaton of its words, in which
each state knows the first document that holds its words. Streaming the cuts through it gives
matching statistics; a match of `window` words or more that an earlier document holds is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchvoice.llm import words
from branchvoice.llm.automaton import SuffixAutomaton
from branchvoice.llm.stages import slices, stage

WINDOW, ANCHOR = 13, 5
PIECE = 2 << 20
#: Cuts under one anchor beyond this number are dealt out again by their windows.
CUTS = 2000
#: Words of a shard's automaton, about.
SHARD_WORDS = 20_000


def anchored(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts with the same anchor: text, first window, number of windows, anchor's hash.

    The anchor of a window is the n-gram with the least mixed hash in it, the leftmost of equals.
    """
    g = words.mix(words.grams(hashes, anchor), 29)
    span = window - anchor + 1
    m = len(hashes) - window + 1
    if m <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least, at = g[:m].copy(), np.arange(m)
    for k in range(1, span):
        lower = g[k : k + m] < least
        least[lower] = g[k : k + m][lower]
        at[lower] = np.flatnonzero(lower) + k
    starts = np.arange(m)
    text = np.searchsorted(first, starts, side="right") - 1
    inside = starts + window <= first[text + 1]
    starts, text, least, at = starts[inside], text[inside], least[inside], at[inside]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (np.diff(starts) != 1) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(starts)))
    return text[begin], starts[begin] - first[text[begin]], count, least[begin]


def _anchors(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices("text", PIECE)(batches):
            found = words.split(batch.column("text"))
            text, start, count, key = anchored(found.hash, found.first, window, anchor)
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("doc_id").take(owner), batch.column("tid").take(owner), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], names=["key", "doc_id", "tid", "start", "count"]
            )

    return run


def _spaced(found: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words, each followed by one space, and where each word starts in them."""
    size = found.end - found.start + 1
    begin = np.cumsum(size) - size
    index = np.repeat(found.start - begin, size) + np.arange(size.sum())
    out = found.data[np.minimum(index, max(0, len(found.data) - 1))] if len(size) else np.zeros(0, np.uint8)
    out[begin + size - 1] = 0x20
    return out, np.append(begin, size.sum())


def _cuts(window: int):
    """The words of each run, from its first window's first word to its last window's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices("text", PIECE)(batches):
            found = words.split(batch.column("text"))
            spaced, begin = _spaced(found)
            raw = spaced.tobytes()
            runs = batch.column("runs")
            count = runs.value_lengths().to_numpy()
            key, start, windows = (runs.flatten().field(i) for i in range(3))
            text = np.repeat(np.arange(batch.num_rows), count)
            a = found.first[text] + start.to_numpy()
            b = a + windows.to_numpy() + window - 1
            cuts = [raw[x : y - 1] for x, y in zip(begin[a].tolist(), begin[b].tolist())]
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [key, batch.column("doc_id").take(owner), batch.column("tid").take(owner), start, windows, pa.array(cuts, pa.binary())],
                names=["key", "doc_id", "tid", "start", "count", "cut"],
            )

    return run


def earlier(cuts: list[tuple[list[bytes], int]], window: int) -> list[list[int]]:
    """For each cut (words, first document): its windows that the cuts of an earlier document hold."""
    automaton = SuffixAutomaton()
    for sequence, owner in cuts:
        automaton.add(sequence, owner)
    automaton.settle()
    out = []
    for sequence, owner in cuts:
        own = []
        for at, (state, length) in enumerate(automaton.matches(sequence)):
            if length >= window and automaton.owner[automaton.ancestor(state, window)] < owner:
                own.append(at - window + 1)
        out.append(own)
    return out


def _sharded(window: int):
    """Cuts sorted by key; whole groups are gathered into shards, each with an automaton of its own.

    A group of one cut is left out: its windows have one first document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[int, int, list[bytes], int]] = []
        group: list[tuple[int, int, list[bytes], int]] = []
        size = 0

        def worked_off() -> pa.RecordBatch:
            found = [(k, c, w) for (k, c, _, _), w in zip(shard, earlier([(s, d) for _, _, s, d in shard], window)) if w]
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.int32()))],
                names=["key", "code", "windows"],
            )

        for batch in batches:
            for key, code, cut, first in zip(*(batch.column(c).to_pylist() for c in ("key", "code", "cut", "first"))):
                if group and group[0][0] != key:
                    if len(group) > 1:
                        shard += group
                        size += sum(len(g[2]) for g in group)
                        if size >= SHARD_WORDS:
                            yield worked_off()
                            shard, size = [], 0
                    group = []
                group.append((key, code, cut.split(b" "), first))
        if len(group) > 1:
            shard += group
        yield worked_off()

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices("text", PIECE)(batches):
        found = words.split(batch.column("text"))
        spaced, begin = _spaced(found)
        spans = batch.column("spans")
        count = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        base = np.repeat(found.first[:-1], count)
        edges = np.zeros(len(found.start) + 1, np.int64)
        np.add.at(edges, base + spans.flatten().field(0).to_numpy(), 1)
        np.add.at(edges, base + spans.flatten().field(1).to_numpy(), -1)
        keep = np.cumsum(edges[:-1]) == 0
        total = np.concatenate([[0], np.cumsum(~keep)])
        flags = np.repeat(keep, np.diff(begin))
        raw, place = spaced[flags].tobytes(), np.concatenate([[0], np.cumsum(flags)])[begin][found.first]
        texts = [raw[a : max(a, b - 1)] for a, b in zip(place[:-1].tolist(), place[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(found.first)), pa.array(np.diff(total[found.first])), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, cuts_each: int = CUTS) -> DataFrame:
    """Word ranges (doc_id, tid, spans array of from, to) covered by windows that an earlier document holds.

    `tid` is the hash of the text, so that rows which share a doc_id are told apart.
    """
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tid"), "text")
    anchors = stage(texts.mapInArrow(_anchors(window, anchor), "key long, doc_id long, tid long, start int, count int"), "anchors")
    shared = anchors.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key")
    runs = anchors.join(stage(shared, "shared-anchors"), "key", "left_semi").groupBy("doc_id", "tid")
    runs = stage(runs.agg(F.collect_set(F.struct("key", "start", "count")).alias("runs")), "runs")
    cuts = stage(
        texts.join(runs, ["doc_id", "tid"]).select("doc_id", "tid", "text", "runs").mapInArrow(
            _cuts(window), "key long, doc_id long, tid long, start int, count int, cut binary"
        ).withColumn("code", F.xxhash64("cut")),
        "cuts",
    )
    distinct = stage(cuts.groupBy("key", "code", "cut").agg(F.min("doc_id").alias("first")), "distinct-cuts")
    hot = stage(distinct.groupBy("key").count().where(F.col("count") > cuts_each).select("key"), "hot-anchors")
    cold = distinct.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key", "code", "cut")
    windows = cold.mapInArrow(_sharded(window), "key long, code long, windows array<int>")
    # Under a hot anchor each window is a key of its own; the least first document of a key decides.
    sequence = F.split(F.col("cut").cast("string"), " ")
    single = distinct.join(hot, "key", "left_semi").select("key", "code", "first", F.posexplode(
        F.transform(F.sequence(F.lit(0), F.size(sequence) - window), lambda i: F.array_join(F.slice(sequence, i + 1, window), " "))
    ).alias("at", "words"))
    least = single.groupBy("words").agg(F.min("first").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    split = single.join(least, "words").where("least < first").groupBy("key", "code").agg(F.collect_set("at").alias("windows"))
    found = stage(windows.union(split), "earlier-windows")
    known = stage(distinct.select("key", "code", "first").join(found, ["key", "code"], "left"), "cut-results")
    placed = cuts.select("key", "code", "doc_id", "tid", "start", "count").join(known, ["key", "code"])
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("count") + window - 1).alias("b")))
    some = F.transform("windows", lambda w: F.struct((F.col("start") + w).alias("a"), (F.col("start") + w + window).alias("b")))
    spans = placed.select("doc_id", "tid", F.explode(F.when(F.col("doc_id") > F.col("first"), whole).otherwise(some)).alias("span"))
    return stage(spans.groupBy("doc_id", "tid").agg(F.collect_set("span").alias("spans")), "spans")


def without_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (its other words, one space between them).

    A word goes when a window of consecutive words that covers it also starts in a document with a
    smaller doc_id; windows are judged on the input. Words are cut at ASCII white space. Rows with
    a null doc_id neither lose words nor make others lose any; null and empty texts have no words.
    Rows that share a doc_id are one document: none of them makes another lose words. Other
    columns are not read. Parameters as in `repeated_spans`.
    """
    spans = repeated_spans(docs, **parameters)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tid"), "text")
    rows = rows.join(spans, ["doc_id", "tid"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
