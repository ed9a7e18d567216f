"""Written intermediate tables.

Lineage is cut by writing Parquet below the shared checkpoint folder of the cluster,
so a lost executor never forces a recomputation past the written table, later readers
prune columns, and the optimizer sees real sizes.
"""

import re
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, else a folder below its warehouse, which is shared too.

    A warehouse on a local disk serves a local master only; a cluster must name a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = not re.match("[a-zA-Z][a-zA-Z0-9+.-]*:", warehouse) or warehouse.startswith("file:")
    if local and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse.rstrip("/") + "/_stages"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path; all stages of an application share a folder, to be dropped with it."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete everything that this application has staged; tables built on it can't be read afterwards."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str = "stage", *parts: str) -> DataFrame:
    """Write once, read back; in folders by the columns `parts`, the last ones of the table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    (df.write.partitionBy(*parts) if parts else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Text bytes, and a fixed cost per cell, of stages measured while they were written.
_MEASURED: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
CELL_BYTES = 16


def _row_bytes(df: DataFrame):
    cells = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long") + CELL_BYTES for c in df.columns]
    return sum(cells[1:], cells[0])


def measured(df: DataFrame, label: str = "dimension") -> DataFrame:
    """A stage whose size is taken by the job that writes it, for joins that have to know it."""
    seen = Observation()
    out = stored(df.observe(seen, F.sum(_row_bytes(df)).alias("bytes")), label)
    _MEASURED[out] = seen.get["bytes"] or 0
    return out


def bytes_of(df: DataFrame) -> int:
    """Size of a measured stage, without a job; anything else is measured by one."""
    known = _MEASURED.get(df)
    return known if known is not None else df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, path: str, order: list[str] | None = None) -> DataFrame:
    """Full-refresh table at a path, globally sorted when an order is given."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
