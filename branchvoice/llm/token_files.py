"""Token ids in binary files of patched frame-of-reference blocks.

File: header (magic, documents, ids, blocks), document index (doc_id, ids), block index (minimum,
width, exceptions, start), then the blocks: values less the block's minimum packed at a width that
covers nine of ten of them, followed by places and values of the exceptions.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from branchvoice.llm import words
from branchvoice.llm.stages import CLEANUP, broadcast_if_small, partitions_for, ship, slices, stage

MAGIC = b"PFR1"
BLOCK = 256
SEGMENT = BLOCK * 4096
#: The width covers this share of a block's values.
COVERED = 0.9
#: Text bytes per partition, about, and per partition where cores would be idle; ids per file at most (a longer document has a file of its own).
PARTITION_BYTES, LEAST_BYTES, FILE_IDS = 512 << 20, 16 << 20, 4 << 20
MANIFEST = ["part", "number", "documents", "ids"]
FILES = "part long, number long, documents long, ids long, content binary"
PIECE = 2 << 20
#: Chunks that a worker remembers; then it starts anew.
REMEMBERED = 4_000_000
NO_ID = -(1 << 63)
#: Unicode white space. A chunk is a run of other characters with one space before it, or white space.
_W = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(f" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")


def pack(values: np.ndarray) -> bytes:
    """Blocks of unsigned 32-bit values: their index, then the payload. Worked off in segments of whole blocks."""
    parts = [_packed(values[k : k + SEGMENT]) for k in range(0, max(1, len(values)), SEGMENT)]
    least, width, exceptions, size, payload = zip(*parts)
    start = np.concatenate([[0], np.cumsum(np.concatenate(size))])
    index = [np.concatenate(x).astype(k).tobytes() for x, k in ((least, "<u4"), (width, "u1"), (exceptions, "<u2"))]
    return b"".join([*index, start.astype("<u8").tobytes(), *payload])


def _packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Minimum, width, exceptions and payload size of each block, and the payload."""
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[: len(values)] = values
    if blocks:
        padded[len(values) :] = values[-1]
    grid = padded.reshape(blocks, BLOCK)
    least = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = grid - least[:, None]
    bits = np.searchsorted(np.uint64(1) << np.arange(33, dtype=np.uint64), rest.astype(np.uint64), side="right").astype(np.uint8)
    place = int(np.ceil(COVERED * BLOCK)) - 1
    width = np.partition(bits, place, axis=1)[:, place] if blocks else np.zeros(0, np.uint8)
    patched = bits > width[:, None]
    exceptions = patched.sum(axis=1).astype(np.uint16)
    packed = width.astype(np.int64) * (BLOCK // 8)
    start = np.concatenate([[0], np.cumsum(packed + 5 * exceptions.astype(np.int64))]).astype(np.uint64)
    out = np.zeros(int(start[-1]), np.uint8)
    for w in np.unique(width):
        if not w:
            continue
        chosen = np.flatnonzero(width == w)
        for k in range(0, len(chosen), 1024):
            own = chosen[k : k + 1024]
            narrow = rest[own].astype("<u2" if w <= 16 else "<u4")  # values beyond the width are exceptions
            flags = np.unpackbits(narrow.view(np.uint8), axis=1, bitorder="little").reshape(len(own), BLOCK, -1)[:, :, :w]
            coded = np.packbits(flags.reshape(len(own), -1), axis=1, bitorder="little")
            out[start[own].astype(np.int64)[:, None] + np.arange(coded.shape[1])] = coded
    block, at = np.nonzero(patched)
    rank = np.arange(len(block)) - (np.cumsum(exceptions.astype(np.int64)) - exceptions)[block]
    base = start[:-1].astype(np.int64)[block] + packed[block]
    out[base + rank] = at
    tail = base + exceptions[block] + 4 * rank
    out[tail[:, None] + np.arange(4)] = rest[block, at].astype("<u4").view(np.uint8).reshape(-1, 4)
    return least, width, exceptions, np.diff(start.astype(np.int64)), out.tobytes()


def unpack(data: memoryview, blocks: int, n: int) -> np.ndarray:
    """The first `n` values of packed blocks."""
    at = 0

    def take(kind: str, size: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(data, kind, size, at)
        at += part.nbytes
        return part

    least, width, exceptions = take("<u4", blocks), take("u1", blocks), take("<u2", blocks).astype(np.int64)
    start = take("<u8", blocks + 1).astype(np.int64)
    payload = np.frombuffer(data, np.uint8, int(start[-1]) if blocks else 0, at)
    rest = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        chosen = np.flatnonzero(width == w)
        for k in range(0, len(chosen), 1024):
            own = chosen[k : k + 1024]
            coded = payload[start[own][:, None] + np.arange(int(w) * BLOCK // 8)]
            flags = np.unpackbits(coded, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            # Sums of powers of two below 2^24 are exact in 32-bit floats.
            scale = (1 << np.arange(w, dtype=np.int64)).astype(np.float32 if w <= 24 else np.float64)
            rest[own] = (flags.astype(scale.dtype) @ scale).astype(np.uint32)
    block = np.repeat(np.arange(blocks), exceptions)
    rank = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    base = start[:-1][block] + width.astype(np.int64)[block] * (BLOCK // 8)
    places = payload[base + rank]
    tail = base + exceptions[block] + 4 * rank
    rest[block, places] = payload[tail[:, None] + np.arange(4)].copy().view("<u4").ravel()
    return (rest + least[:, None]).ravel()[:n]


def encode_file(ids: list[int | None], counts: list[int], tokens: np.ndarray) -> bytes:
    body = pack(tokens)
    head = np.array([len(ids), len(tokens), -(-len(tokens) // BLOCK)], "<u8").tobytes()
    index = np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes() + np.array(counts, "<u8").tobytes()
    return MAGIC + head + index + body


def decode_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, ids per document, all ids of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a token file")
    documents, n, blocks = (int(x) for x in np.frombuffer(data, "<u8", 3, 4))
    ids = np.frombuffer(data, "<i8", documents, 28)
    counts = np.frombuffer(data, "<u8", documents, 28 + 8 * documents).astype(np.int64)
    return ids, counts, unpack(memoryview(data)[28 + 16 * documents :], blocks, n)


def _blank_bytes(data: np.ndarray) -> np.ndarray:
    """Positions where a white-space character outside ASCII starts."""
    one, two = np.append(data[1:], 0)[: len(data)], np.append(data[2:], [0, 0])[: len(data)]
    found = (data == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (data == 0xE1) & (one == 0x9A) & (two == 0x80)
    found |= (data == 0xE2) & ((one == 0x80) & ((two >= 0x80) & (two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)) | (one == 0x81) & (two == 0x9F))
    return np.flatnonzero(found | (data == 0xE3) & (one == 0x80) & (two == 0x80))


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the chunks that CHUNK finds in texts whose white space is ASCII.

    A run of white space gives its last character to the following word if that is a space, else
    keeps it apart; what is before it, and a run at the end of a text, is one chunk.
    """
    n = len(data)
    blank = (data == 0x20) | (data >= 9) & (data <= 13)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.ones(n, bool), np.ones(n, bool)  # of another kind, or of another text
    before[1:] = (blank[1:] != blank[:-1]) | edge[1:n]
    after[:-1] = before[1:]
    # The last white space before a word of the same text.
    last = blank & after & ~edge[1:]
    space = last & (data == 0x20)
    start = np.where(blank, before | last, before)
    start[1:] &= ~(space[:-1] & ~blank[1:])  # the word after its space
    begin = np.flatnonzero(start)
    return begin, np.append(begin[1:], n)


class Encoder:
    """Ids by a byte-level tokenizers file, chunk by chunk; chunks that repeat are remembered.

    Tokens never span two chunks, so the ids of a text are those of its chunks. Chunks are found,
    hashed and looked up for many texts at once; the library encodes those not seen before, and
    whole texts that hold a special string or white space outside ASCII.
    """

    SLOTS = 1 << 23

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that start with a space
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.entry = np.full(self.SLOTS, -1, np.int32)
        self.key, self.head = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)
        self.first, self.size = np.zeros(1024, np.uint32), np.zeros(1024, np.int32)
        self.tokens = np.zeros(4096, np.uint16 if len(self.opens) <= 1 << 16 else np.uint32)
        self.entries = self.used = 0

    def _store(self, ids: np.ndarray, size: np.ndarray, keys: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Store id lists, given one after the other; their entry numbers."""
        need, tokens = self.entries + len(size), self.used + len(ids)
        grown = lambda x: np.concatenate([x, np.zeros_like(x)])
        while len(self.size) < need:
            self.key, self.head, self.first, self.size = map(grown, (self.key, self.head, self.first, self.size))
        while len(self.tokens) < tokens:
            self.tokens = grown(self.tokens)
        new = slice(self.entries, need)
        self.key[new], self.head[new], self.size[new] = keys, heads, size
        self.first[new] = self.used + np.cumsum(size) - size
        self.tokens[self.used : tokens] = ids
        self.entries, self.used = need, tokens
        return np.arange(need - len(size), need)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entries of keys, -1 where unknown."""
        out = np.full(len(keys), -1, np.int32)
        rest, slot = np.arange(len(keys)), (keys >> np.uint64(41)).astype(np.int64)
        while len(rest):
            entry = self.entry[slot]
            same = (entry >= 0) & (self.key[np.maximum(entry, 0)] == keys[rest])
            out[rest[same]] = entry[same]
            on = (entry >= 0) & ~same
            rest, slot = rest[on], (slot[on] + 1) % self.SLOTS
        return out

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        """Put different new keys into free slots."""
        rest, slot = np.arange(len(keys)), (keys >> np.uint64(41)).astype(np.int64)
        while len(rest):
            free = self.entry[slot] < 0
            self.entry[slot[free]] = entries[rest[free]]
            on = self.entry[slot] != entries[rest]  # taken before, or by another of these
            rest, slot = rest[on], (slot[on] + 1) % self.SLOTS

    def _encode(self, texts: list[str]) -> list:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, keys: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Encode new chunks; their entry numbers.

        Words with a space before them are encoded in long runs, in which each opens with the only
        token that starts with a space; the others one by one.
        """
        after = data[np.minimum(begin + 1, len(data) - 1)]
        spaced = (data[begin] == 0x20) & (length > 1) & (after != 0x20) & ((after < 9) | (after > 13))
        run, ids, size = np.flatnonzero(spaced), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(run):
            own = length[run]
            place = np.cumsum(own) - own
            joined = data[np.repeat(begin[run] - place, own) + np.arange(own.sum())].tobytes()
            cuts = [*place[::500].tolist(), len(joined)]
            ids = np.concatenate([np.array(x, np.int64) for x in self._encode([joined[x:y].decode() for x, y in zip(cuts, cuts[1:])])])
            opening = np.flatnonzero(self.opens[ids])
            if len(opening) == len(run) and opening[0] == 0:
                size = np.diff(np.append(opening, len(ids)))
            else:
                run, ids = run[:0], ids[:0]
        alone = np.setdiff1d(np.arange(len(begin)), run)
        lists = self._encode([data[x : x + n].tobytes().decode("utf-8", "replace") for x, n in zip(begin[alone].tolist(), length[alone].tolist())])
        more = np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))
        order = np.concatenate([run, alone])
        entries = np.empty(len(begin), np.int32)
        entries[order] = self._store(
            np.concatenate([ids, more]), np.concatenate([size, np.array([len(x) for x in lists], np.int64)]), keys[order], heads[order]
        )
        return entries

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, `end` after each text, and how many each text has."""
        data, offsets = words.text_bytes(texts)
        begin, stop = chunks(data, offsets)
        length = stop - begin
        keys = words.mix(words.polynomial(data, begin, stop) + length.astype(np.uint64), 31)
        padded = np.append(data, np.zeros(8, np.uint8))
        head = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[begin]).view("<u8").ravel()
        head = head & np.where(length >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.minimum(length, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1))
        owner = np.searchsorted(offsets, begin, side="right") - 1

        raw = data.tobytes()
        whole = set((np.searchsorted(offsets, _blank_bytes(data), side="right") - 1).tolist())
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                whole.add(int(np.searchsorted(offsets, at, side="right")) - 1)
                at = raw.find(special, at + 1)

        known = self._find(keys)
        missing = np.flatnonzero(known < 0)
        if len(missing):
            unique, where, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            if self.entries + len(unique) > self.remembered:
                self._forget()
                missing = np.arange(len(keys))
                unique, where, back = np.unique(keys, return_index=True, return_inverse=True)
            at = missing[where]
            entries = self._learn(data, begin[at], length[at], unique, head[at])
            self._place(unique, entries)
            known[missing] = entries[back]
        # Two chunks with one hash: leave their texts to the library.
        whole |= set(owner[self.head[known] != head].tolist())

        kept, used = self.entries, self.used
        n = len(offsets) - 1
        slow = sorted(whole)
        lists = [self.tokenizer.encode(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace"), add_special_tokens=False).ids for i in slow]
        lists.append([end])
        none = np.zeros(len(lists), np.uint64)
        sizes = np.array([len(x) for x in lists], np.int64)
        extra = self._store(np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes, none, none)
        fast = np.ones(n, bool)
        fast[slow] = False
        own = fast[owner]
        order = np.concatenate([owner[own], np.array(slow, np.int64), np.arange(n)])
        entry = np.concatenate([known[own], extra[:-1], np.full(n, extra[-1])])
        # Stable: chunks stay in order, and the end comes after everything of its text.
        place = np.argsort(order, kind="stable")
        entry, order = entry[place], order[place]
        size = self.size[entry].astype(np.int64)
        total = int(size.sum())
        first = self.first[entry].astype(np.int64)
        out = self.tokens[np.repeat(first - np.cumsum(size) + size, size) + np.arange(total)].astype(np.uint32)
        self.entries, self.used = kept, used
        return out, np.bincount(order, weights=size, minlength=n).astype(np.int64)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_of(run: str, path: str) -> Encoder:
    """The worker's encoder in this run; chunks of earlier runs are dropped, so that each run encodes what it needs."""
    if (run, path) not in _encoders:
        _encoders.clear()
        _encoders[run, path] = Encoder(path)
    return _encoders[run, path]


def _written(path: str, end: int):
    this_run = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(this_run, path), TaskContext.get().partitionId()
        ids, counts, tokens, held, number = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, counts, tokens, held, number
            if ids:
                row = {"part": part, "number": number, "documents": len(ids), "ids": held, "content": encode_file(ids, counts, np.concatenate(tokens))}
                yield pa.RecordBatch.from_pylist([row], pa.schema([*((c, pa.int64()) for c in MANIFEST), ("content", pa.binary())]))
                number += 1
            ids, counts, tokens, held = [], [], [], 0

        for batch in slices("text", PIECE)(batches):
            some, n = encoder.ids(batch.column("text"), end)
            if held + len(some) > FILE_IDS:
                yield from flush()
            ids += batch.column("doc_id").to_pylist()
            counts += n.tolist()
            tokens.append(some)
            held += len(some)
        yield from flush()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = 0) -> DataFrame:
    """Write the ids of all texts to `folder` in ascending doc_id order; returns the manifest (part, number, documents, ids).

    `tokenizer` is a byte-level tokenizers file that every worker has, `folder` any place that Spark
    can write to. A token file is a row (its bytes in `content`) of a table that Spark writes, so that its
    commit takes care of tasks that fail or run twice; files follow each other by part and number, and a
    part holds 512 MB of text, or less where that would leave cores idle. Null text is empty; a null doc_id
    comes first; repeated doc_ids are ordered by text. An empty table writes no file. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    order = ["doc_id", F.xxhash64("text"), "text"]
    least = min(4 * spark.sparkContext.defaultParallelism, partitions_for(size, LEAST_BYTES))
    dealt = rows.repartitionByRange(partitions_for(size, PARTITION_BYTES, max(1, least)), *order[:2]).sortWithinPartitions(*order)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        dealt.mapInArrow(_written(tokenizer, end), FILES).write.option("compression", "none").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(FILES).parquet(folder).select(*MANIFEST)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, data in zip(batch.column("part").to_pylist(), batch.column("number").to_pylist(), batch.column("content")):
            ids, counts, tokens = decode_file(data.as_buffer().to_pybytes())
            raw, ends = tokens.astype("<u4").tobytes(), np.cumsum(counts)
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part)), pa.array(np.full(n, number)), pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                names=["part", "number", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document in the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""
    ship(spark)
    before = F.sum("ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    starts = stage(manifest.select("part", "number", F.coalesce(before, F.lit(0)).alias("before")), "token-starts")
    files = spark.read.schema(FILES).parquet(folder).select("part", "number", "content")
    rows = files.mapInArrow(_decoded, "part long, number long, doc_id long, within long, n_tokens long, ids_crc32 long")
    # A file holds so many ids that a row per file is small beside them.
    return rows.join(broadcast_if_small(starts, 40), ["part", "number"]).select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
