"""Row numbers that never put a whole group, or the whole table, into one task.

A plain window sorts one group in one task; a group of copies holding a third of all
rows would not survive that. Here rows are range-partitioned on (group, order), which
cuts large groups into several partitions, numbered inside their partition, and
shifted by the number of rows the same group has in earlier partitions. Only
partition-level counts (at most two rows per partition) are broadcast.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchvoice.operators.storage import stored

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _positions(df: DataFrame) -> DataFrame:
    """The table with stable _part (partition number) and _row (0-based row in it).

    Both are written, so the search for _row = 0 skips all but the first row group of
    every file.
    """
    tagged = df.withColumn("_id", F.monotonically_increasing_id())
    placed = tagged.select(
        *df.columns,
        F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )
    return stored(placed, "positions")


def _offsets(sizes: DataFrame, group: list[str]) -> DataFrame:
    """Rows of the group in earlier partitions, from one row per partition and group."""
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return sizes.select("_part", *group, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))


def is_narrow(df: DataFrame) -> bool:
    """Whether no row moves between partitions: then every run cuts the input in the same way."""
    return "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def number_as_read(df: DataFrame, out: str) -> DataFrame:
    """Dense 1-based number over the whole table, as it lies, for the caller to write.

    Rows are counted per partition first, a pass that stores a number for each, and numbered while they
    are written: no row is written twice. Where rows move between partitions their cut may differ
    from run to run, so such a table is written before it is numbered.
    """
    if not is_narrow(df):
        return number_rows(df, out)
    sizes = stored(df.groupBy(F.spark_partition_id().alias("_part")).agg(F.count("*").alias("_rows")), "split-rows")
    row = F.monotonically_increasing_id()
    placed = df.select(*df.columns, F.spark_partition_id().alias("_part"), row.bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"))
    numbered = placed.join(F.broadcast(_offsets(sizes, [])), "_part")
    return numbered.withColumn(out, F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")


def number_rows(df: DataFrame, out: str, order: list | None = None, parts: int | None = None) -> DataFrame:
    """Dense 1-based number over the whole table, in the given order or as it lies."""
    if order:
        ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
        df = ranged.sortWithinPartitions(*order)
    placed = _positions(df)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per partition of the job: safe to broadcast at any data size.
    numbered = placed.join(F.broadcast(_offsets(sizes, [])), "_part")
    return numbered.withColumn(out, F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")


#: Rows of a group that a window may sort in one task.
GROUP_ROWS = 100_000


def rank_rows(df: DataFrame, group: str, order: list[str], out: str, most: int = GROUP_ROWS) -> DataFrame:
    """row_number() over (partition by group order by order), for a stored table.

    Group sizes are counted first, combined before their shuffle. Groups of at most `most` rows
    are ranked by a plain window; only larger ones take the way over ranges, which cuts them.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    hot = stored(counts.select(group), "hot-groups")
    window = Window.partitionBy(group).orderBy(*order)
    if hot.isEmpty():
        return df.withColumn(out, F.row_number().over(window))
    cold = df.join(hot, group, "left_anti").withColumn(out, F.row_number().over(window))
    return cold.unionByName(rank_in_group(df.join(hot, group, "left_semi"), group, order, out).withColumn(out, F.col(out).cast("int")))


def rank_in_group(df: DataFrame, group: str, order: list[str], out: str, parts: int | None = None) -> DataFrame:
    """row_number() over (partition by group order by order).

    The group is not NULL and the order decides between any two rows of a group.
    """
    keys = [group, *order]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    placed = _positions(ranged.sortWithinPartitions(*keys))
    # A group can continue from an earlier partition only as the first of its partition.
    heads = placed.filter("_row = 0").select(group).distinct()
    sizes = (
        placed.join(F.broadcast(heads), group, "left_semi")
        .groupBy("_part", group)
        .agg(F.count("*").alias("_rows"))
    )
    shift = _offsets(sizes, [group]).filter("_before > 0")
    local = Window.partitionBy("_part", group).orderBy(*order)
    return (
        placed.withColumn("_local", F.row_number().over(local))
        .join(F.broadcast(shift), ["_part", group], "left")
        .withColumn(out, F.col("_local") + F.coalesce(F.col("_before"), F.lit(0)))
        .drop("_part", "_row", "_local", "_before")
    )


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of every key.

    The filter sits right on the window, so the optimizer keeps at most one row per
    key and map task before the shuffle: copies never travel.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
