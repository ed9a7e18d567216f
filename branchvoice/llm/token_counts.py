"""Token counts with a digest cache.

Counts are stored by digest of the normalised content and digest of the tokenizer's version. Only
contents that the cache does not know are encoded, each once, and appended to it.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchvoice.llm.stages import broadcast_if_small, CLEANUP, ship, slices, stage

SCHEMA = "version string, digest binary, n_tokens long"
PIECE = 1 << 20
#: Pieces of text whose counts a worker remembers.
REMEMBERED = 1_000_000
LIMIT = 2048
#: ASCII white space; the tokenizer makes one space of any run of it, so no token spans it.
BLANK = r"[\x20\t\r\n]+"


def one_space(text: Column) -> Column:
    """Normal form for tokenizers that make one space of a run of white space."""
    return F.regexp_replace(text, BLANK, " ")


def version_of(path: str) -> str:
    """Digest of a tokenizer: its file and its library."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


class Counter:
    """Token counts of texts by a tokenizers file; with `by_word`, counts of words are remembered."""

    def __init__(self, path: str, by_word: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path).encode_batch_fast
        self.pieces = re.compile(r"[^\x20\t\r\n]+").findall if by_word else lambda text: [text] if text else []
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(t) for t in texts]
        new = list({p for pieces in cut for p in pieces} - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list({p for pieces in cut for p in pieces})
        for p, e in zip(new, self.encode(new, add_special_tokens=False)):
            self.known[p] = len(e.ids)
        get = self.known.__getitem__
        return [sum(map(get, pieces)) for pieces in cut]


_counters: dict[tuple[str, str, bool], Counter] = {}


def counter_of(run: str, path: str, by_word: bool) -> Counter:
    """The worker's counter in this run; pieces of earlier runs are dropped, so that each run encodes what it needs."""
    if (run, path, by_word) not in _counters:
        _counters.clear()
        _counters[run, path, by_word] = Counter(path, by_word)
    return _counters[run, path, by_word]


def _encoded(path: str, by_word: bool):
    this_run = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter_of(this_run, path, by_word).counts
        for batch in slices("text", PIECE)(batches):
            n = count([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    return run


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version in the cache; none where the folder does not exist yet."""
    try:
        rows = spark.read.schema(SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], SCHEMA)
    return rows.where(F.col("version") == version).select("digest", "n_tokens").dropDuplicates(["digest"])


def _append(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str, normalise: Callable[[Column], Column] | None = None, by_word: bool = False, limit: int = LIMIT
) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `tokenizer` is a file that every worker has at this path, `cache` a folder that all share.
    `normalise` may change texts only in ways that keep their token count; `by_word` says that no
    token spans ASCII white space and that white space has no tokens. Both hold for tokenizers that
    drop white space. Null text counts as empty. Repeated rows and copies are looked up, not
    encoded again; two runs that append the same content at once do no harm. Other columns are not
    read; an empty table gives no rows and appends nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    version = version_of(tokenizer)
    text = F.coalesce("text", F.lit(""))
    normal = normalise(text) if normalise else text
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(normal.cast("binary"), 256)).alias("digest"))
    digests = stage(rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    missing = digests.groupBy("digest").agg(F.min(first).alias("first")).join(stored_counts(spark, cache, version), "digest", "left_anti")
    missing = stage(missing, "misses")
    wanted = rows.withColumn("first", first).join(broadcast_if_small(missing, 64), ["digest", "first"], "left_semi")
    encoded = wanted.select("digest", "text").mapInArrow(_encoded(tokenizer, by_word), "digest binary, n_tokens long")
    _append(encoded.select(F.lit(version).alias("version"), "digest", "n_tokens"), cache)
    counts = stored_counts(spark, cache, version)
    return digests.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
