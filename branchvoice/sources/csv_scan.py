"""Files of quoted, multi-line records, cut into records by as many tasks as they have splits.

A line end is a record end unless a quoted field is open there, so a line maps "open before" to
"open after", and so does a whole split: its map is found without knowing what came before. One
pass takes every split's map, its header and whether its bytes are UTF-8. The maps are chained in
file order, after which every task knows how its splits begin and cuts them for itself; only pieces
of records that run over a split's end meet in a shuffle.
"""

import csv
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchvoice.operators.storage import stored
from branchvoice.operators.workers import ship

CORRUPT = "_corrupt_record"
OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
SEPARATOR, QUOTE = b";", b'"'
BLANK = (b"", b"\r")


def open_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that begins inside one, or not.

    A quote opens a field only as its first character; a quote inside one ends it unless a second
    follows; what comes between the end and the separator is ordinary text.
    """
    text, quoted, fresh = range(3)  # in ordinary text, in a quoted field, at a field's start or behind a quote
    state = quoted if inside else fresh
    for part in line.split(QUOTE)[:-1]:
        if state == quoted:
            state = fresh
        elif part.endswith(SEPARATOR) or state == fresh and not part:
            state = quoted
        else:
            state = text
    return state == quoted


class Split(NamedTuple):
    """What one pass knows of a byte range: how it ends if it begins outside or inside a quoted
    field, whether a field open at its begin ends in it, whether all is UTF-8, the first record."""

    file: str
    key: int
    block: int
    outside: bool
    inside: bool
    ends: bool
    utf8: bool
    header: bytes | None


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of lines of one split."""
    keys = np.column_stack([batch.column(c).to_numpy() for c in ("file", "block")])
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
        if b > a:
            yield int(keys[a, 0]), int(keys[a, 1]), batch.slice(a, b - a)


def _quoted(lines: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def _surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[int, int], dict] = {}
    for batch in batches:
        for file, block, own in _pieces(batch):
            lines = own.column("value")
            s = known.setdefault((file, block), {"path": own.column("path")[0].as_py(), "o": False, "i": True, "ends": False, "utf8": True, "header": None, "held": []})
            s["utf8"] &= bool(pc.all(own.column("utf8")).as_py())
            if block == 0 and s["header"] is None:
                inside = bool(s["held"]) and open_after(b"\n".join(s["held"]), False)
                for line in lines.to_pylist():
                    if not s["held"] and line in BLANK:
                        continue
                    s["held"].append(line)
                    inside = open_after(line, inside)
                    if not inside:
                        s["header"] = b"\n".join(s["held"])
                        break
            for at in _quoted(lines).tolist():
                line = lines[at].as_py()
                s["o"], s["i"] = open_after(line, s["o"]), open_after(line, s["i"])
                s["ends"] |= not s["i"]
    rows = [(s["path"], file, block, s["o"], s["i"], s["ends"], s["utf8"], s["header"]) for (file, block), s in known.items()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(Split._fields))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    name = F.col("_metadata.file_path")
    return text.select(
        F.col("value").cast("binary").alias("value"), F.xxhash64(name).alias("file"), F.col("_metadata.file_block_start").alias("block"),
        name.alias("path"), F.is_valid_utf8("value").alias("utf8"),
    )


def survey(spark: SparkSession, path: str | list[str]) -> list[Split]:
    """One row per split that holds a line, in file order: as many as the driver plans for any scan."""
    ship(spark)
    schema = "file string, key long, block long, outside boolean, inside boolean, ends boolean, utf8 boolean, header binary"
    rows = _lines(spark, path).mapInArrow(_surveyed, schema).collect()
    return sorted((Split(*r) for r in rows), key=lambda s: (s.file, s.block))


def _cut(sent):
    """Whole records, and pieces of records that run over the end of a split (with the block where they began).

    `form` is the file's: 1 for the second encoding, 2 more for lines that end in CR LF.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = sent.value, ["file", "begun", "block", "form", "record"]
        at, inside, begun, form, held, skip = None, False, None, 0, [], False
        pieces: list[tuple[int, int, int, int, bytes]] = []

        def end() -> None:
            """The open record of a split that is over."""
            if held:
                pieces.append((at[0], at[1] if begun is None else begun, at[1], form, b"\n".join(held)))
                held.clear()

        for batch in batches:
            for file, block, own in _pieces(batch):
                lines = own.column("value")
                if (file, block) != at:
                    end()
                    at, skip = (file, block), block == 0
                    begun, form = known[file, block]
                    inside = begun is not None
                quoted = _quoted(lines).tolist()
                # Between lines with quotes nothing changes, so those decide how each run of lines is taken.
                runs, last = [], 0
                for k in [*quoted, len(lines)]:
                    runs.append((last, k, False))
                    runs.append((k, k + 1, True))
                    last = k + 1
                whole: list[pa.Array] = []
                single: list[bytes] = []
                for a, b, quotes in runs[:-1]:
                    if a == b:
                        continue
                    if not quotes and not inside:
                        rows = lines.slice(a, b - a)
                        rows = rows.filter(pc.invert(pc.is_in(rows, value_set=pa.array(BLANK, pa.binary()))))
                        if skip and len(rows):
                            rows, skip = rows.slice(1), False
                        whole += [pa.array(single, pa.binary()), rows]
                        single = []
                        continue
                    for line in lines.slice(a, b - a).to_pylist() if not quotes else [lines[a].as_py()]:
                        held.append(line)
                        if quotes:
                            inside = open_after(line, inside)
                        if inside:
                            continue
                        if begun is not None:
                            end()
                            begun = None
                        elif skip:
                            skip = False
                        else:
                            single.append(b"\n".join(held))
                        held.clear()
                records = pa.concat_arrays([*whole, pa.array(single, pa.binary())])
                none = pa.nulls(len(records), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(np.full(len(records), form)), records], names=names)
        end()
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([p[k] for p in pieces], pa.int64()) for k in range(4)), pa.array([p[4] for p in pieces], pa.binary())], names=names
        )

    return run


def _chained(splits: list[Split]) -> tuple[dict[tuple[int, int], int | None], bool]:
    """For each split the block where the record began that is open at its begin (None: none is); whether any record runs over an end."""
    begun, over, file, now = {}, False, None, None
    for s in splits:
        if s.file != file:
            file, now = s.file, None
        begun[s.key, s.block] = now
        if s.inside if now is not None else s.outside:
            now = now if now is not None and not s.ends else s.block
            over = True
        else:
            now = None
    return begun, over


def header_of(splits: list[Split], encoding_of) -> list[str]:
    """The one header of all files, byte-order marks left out."""
    found: dict[str, str] = {}
    for s in splits:
        if s.block == 0:
            if s.header is None:
                raise ValueError(f"the header of {s.file} does not end in its first split")
            found[s.file] = s.header.decode(encoding_of(s.file)).removeprefix("﻿").rstrip("\r")
    names = set(found.values())
    if len(names) > 1:
        raise ValueError(f"files with different headers: {sorted(names)}")
    fields = next(csv.reader(names, delimiter=";"), [])
    return [name or f"_c{k}" for k, name in enumerate(fields)]


def scan_records(spark: SparkSession, path: str | list[str], encodings: tuple[str, ...]) -> DataFrame:
    """All-text scan of ';'-separated files with one header; rows that do not fit it are tagged.

    Every file is read in the first of two encodings when that is UTF-8 and all its bytes are, in the second
    otherwise. The files are read twice, once for the survey; a third time only where a record runs
    over the end of a split. Blank lines outside quotes are no records.
    """
    splits = survey(spark, path)
    utf8: dict[str, bool] = {}
    for s in splits:
        utf8[s.file] = utf8.get(s.file, True) and s.utf8
    encoding_of = lambda file: encodings[0] if len(encodings) == 1 or utf8[file] else encodings[1]
    header = header_of(splits, encoding_of)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    if not header:
        return spark.createDataFrame([], schema)

    begun, over = _chained(splits)
    crlf = {s.key for s in splits if (s.header or b"").endswith(b"\r")}
    second = {s.key for s in splits if encoding_of(s.file) != encodings[0]}
    sent = spark.sparkContext.broadcast({(key, block): (b, (key in second) + 2 * (key in crlf)) for (key, block), b in begun.items()})
    lines = _lines(spark, path).select("value", "file", "block")
    cut = lines.mapInArrow(_cut(sent), "file long, begun long, block long, form long, record binary")
    records = cut.where("begun IS NULL").select("form", "record")
    if over:
        pieces = cut.where("begun IS NOT NULL").groupBy("file", "begun", "form").agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("pieces"))
        joined = F.aggregate("pieces", F.lit(None).cast("binary"), lambda all_, p: F.when(all_.isNull(), p["record"]).otherwise(F.concat(all_, F.lit(b"\n"), p["record"])))
        # Written, few as they are, so that no row of the scan itself moves.
        records = records.unionByName(stored(pieces.select("form", joined.alias("record")), "split-records"))

    def read(encoding: str) -> Column:
        return F.make_valid_utf8(F.col("record").cast("string")) if encoding.upper() in ("UTF-8", "UTF8") else F.decode("record", encoding)

    text = F.when(F.col("form") % 2 == 1, read(encodings[-1])).otherwise(read(encodings[0])) if second else read(encodings[0])
    line = F.regexp_replace(text, "\\r\\z", "")
    if crlf:
        # Line ends inside quotes follow those of the file.
        line = F.when(F.col("form") >= 2, F.replace(line, F.lit("\r\n"), F.lit("\n"))).otherwise(line)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    return records.select(F.from_csv(line, ddl, OPTIONS).alias("r")).select("r.*")
