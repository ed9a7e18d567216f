"""Secrets in texts: fixed patterns, and strings that look random to two character models.

First-order Markov models are counted of random strings, over the pattern matches of all documents,
and of ordinary text, over a bounded sample of documents, in which long strings that might be
secrets are not labelled. Every string of 16 characters or more outside the matches, whatever it
is made of, is a secret when its log-likelihood ratio is high enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchvoice.llm.stages import ship, slices

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs are matched whole either way, so the length can stand in the pattern.
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
WORDS = ("password", "passwd", "secret", "token", "api")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
RUN = re.compile(r"[A-Za-z0-9]{16,}")

#: Documents that the model of ordinary text is counted over, about; chosen by content hash.
SAMPLE = 20_000
CHARACTERS = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "+/_.=-"
STATES = len(CHARACTERS) + 1
#: Weight, in counts, of what a state falls back on, and the count of a character never seen.
PRIOR_RANDOM, PRIOR_ORDINARY, LEAST_SEEN = 1400.0, 5.0, 0.05
#: Ordinary capitals follow each other as small letters do: so much of their counts is added.
CAPITALS = 0.1
#: Ordinary numbers, in counts of each pair of digits.
NUMBERS = 5.0
#: Nats that speak for random: in all, and per character.
LEAST_TOTAL, LEAST_EACH = 12.0, 0.6
PIECE = 4 << 20

_state = np.zeros(256, np.int64)
for _i, _c in enumerate(CHARACTERS):
    _state[ord(_c)] = _i + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches (kind, start, end) in code points, by start, then kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def unlabelled(value: str) -> bool:
    """Whether a long string may be a secret: it has letters, and digits too or 16 of both in a row. Digits alone are a number."""
    return bool(re.search("[A-Za-z]", value) and (RUN.search(value) or re.search("[0-9]", value)))


def _steps(text: str) -> np.ndarray:
    """State pairs of a text; everything outside the alphabet is one state."""
    states = _state[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    return states[:-1] * STATES + states[1:]


def _tally(counts: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["step", "n"])


def _random(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character pairs of the secret part of all pattern matches."""
    counts = np.zeros(STATES * STATES, np.int64)
    for batch in slices("text", PIECE)(batches):
        for text in batch.column("text").to_pylist():
            for _, start, end in base_spans(text):
                value = re.split(r"""[:=]\x20*["']?""", text[start:end], maxsplit=1)[-1]
                counts += np.bincount(_steps(f" {value} "), minlength=STATES * STATES)
    yield _tally(counts)


def _ordinary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character pairs of what is left of the texts without matches and unlabelled strings."""
    counts = np.zeros(STATES * STATES, np.int64)
    label = lambda m: " " if unlabelled(m[0]) else m[0]
    for batch in slices("text", PIECE)(batches):
        for text in batch.column("text").to_pylist():
            rest, last = [], 0
            for _, start, end in base_spans(text):
                rest.append(text[last:start])
                last = max(last, end)
            rest.append(text[last:])
            counts += np.bincount(_steps(f" {CANDIDATE.sub(label, ' '.join(rest))} "), minlength=STATES * STATES)
    yield _tally(counts)


def may_match(text: Column) -> Column:
    """False only where no pattern can match."""
    low = F.lower(text)
    found = F.contains(text, F.lit("AKIA")) | text.rlike(HEX.pattern)
    for word in WORDS:
        found = found | F.contains(low, F.lit(word))
    return found


def ratios(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Log-likelihood ratio, random against ordinary, of each pair of characters."""
    total = docs.count()
    share = min(1.0, sample / total) if total else 1.0
    texts = docs.where("text IS NOT NULL").select("text")
    chosen = texts.where(F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(float(1 << 53)) < share)
    labelled = [texts.where(may_match(F.col("text"))).mapInArrow(_random, "step long, n long"), chosen.mapInArrow(_ordinary, "step long, n long")]
    rows = labelled[0].withColumn("label", F.lit(0)).union(labelled[1].withColumn("label", F.lit(1)))
    counted = rows.groupBy("label", "step").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, STATES, STATES))
    for r in counted.collect():
        counts[r["label"], r["step"] // STATES, r["step"] % STATES] = r["n"]
    small, capital = ([CHARACTERS.index(c) + 1 for c in letters] for letters in (ascii_lowercase, ascii_uppercase))
    counts[1][np.ix_(capital, capital)] += CAPITALS * counts[1][np.ix_(small, small)]
    digit = [CHARACTERS.index(c) + 1 for c in digits]
    counts[1][np.ix_(digit, digit)] += NUMBERS
    # Random strings fall back on all characters alike, identifiers on how often a character is seen at all.
    alone = counts[1].sum(axis=0) + LEAST_SEEN
    alone /= alone.sum()
    random = (counts[0] + PRIOR_RANDOM / STATES) / (counts[0].sum(axis=1, keepdims=True) + PRIOR_RANDOM)
    ordinary = (counts[1] + PRIOR_ORDINARY * alone) / (counts[1].sum(axis=1, keepdims=True) + PRIOR_ORDINARY)
    return np.log(random) - np.log(ordinary)


def random_spans(text: str, ratio: np.ndarray, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Long strings outside the spans taken that the random model explains better."""
    out = []
    for m in CANDIDATE.finditer(text):
        value = m[0]
        if any(start < m.end() and m.start() < end for _, start, end in taken):
            continue
        steps = _steps(value)
        score = float(ratio.ravel()[steps].sum())
        if score >= LEAST_TOTAL and score >= LEAST_EACH * len(value):
            out.append(("random", *m.span()))
    return out


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scanned(ratio):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices("text", PIECE)(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                spans = base_spans(text)
                spans = sorted(spans + random_spans(text, ratio.value, spans), key=lambda s: (s[1], KINDS.index(s[0])))
                rows.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, SPANS)], names=["doc_id", "spans"])

    return run


def secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id and spans (kind, start, end), by start and kind, in code points.

    Kinds assign, access and hex are pattern matches; random spans are added by the models and
    never overlap those. All strings of 16 or more characters of base64, URLs and names are judged: digits
    alone never look random, as ordinary numbers do not either. Whole texts are scanned, of any length;
    null and empty texts have no spans. Repeated rows are scanned one by one; a null doc_id stays null; an
    empty table gives no rows; other columns are not read. `sample` bounds the documents (by content
    hash) behind the model of ordinary text.
    """
    ship(docs.sparkSession)
    ratio = docs.sparkSession.sparkContext.broadcast(ratios(docs.select("text"), sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scanned(ratio), "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
