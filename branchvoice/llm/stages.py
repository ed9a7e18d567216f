"""Written stages and checked broadcasts, shared by the operators of this subpackage."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchvoice.operators.storage import shared_folder
from branchvoice.operators.workers import ship as ship

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A side is broadcast only when its rows, counted first, stay below this many bytes; the hash table
#: built from them takes two to three times as much.
BROADCAST_BYTES = 16 << 20


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts the lineage for good: what was written survives lost executors. The shuffle files of
    the writing job are dropped as soon as it ends, so that the disk holds one stage at a time.
    """
    spark = df.sparkSession
    ship(spark)
    path = new_folder(spark, label)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows of a stage fit `limit`; a shuffle join otherwise.

    `df` should be a stage: counting it reads Parquet footers only.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def partitions_for(rows: int, rows_each: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / rows_each))


def slices(column: str, limit: int) -> Callable:
    """Cut record batches so that the texts of one piece stay near `limit` bytes (a row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size.astype(np.int64))
            start = 0
            while start < batch.num_rows:
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
                yield batch.slice(start, stop - start)
                start = stop

    return cut
