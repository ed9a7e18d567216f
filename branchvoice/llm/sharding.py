"""Shards of nearly equal size by sampled splitters. DataFrame functions only.

Keys are sampled in proportion to record size, weighted quantiles of the sample become range
boundaries, exact range sizes are measured, and ranges that came out overfull are sampled again
and cut further. Consecutive ranges then fill the shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from branchvoice.llm.stages import broadcast_if_small, stage

#: Wanted size of a range, and the bound of their number (what is broadcast holds 48 bytes each).
RANGE_BYTES, MAX_RANGES = 256 << 20, 1 << 16
RANGES_PER_SHARD = 64
#: Keys drawn for each range.
OVERSAMPLING = 16
#: A range above this many times the mean is cut again, in so many rounds at most.
OVERFULL, ROUNDS = 2, 4
LEAST = -(1 << 63)
#: A group up to this share of a shard is never divided.
WHOLE = 0.35


def record_size(text: Column) -> Column:
    """UTF-8 bytes (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _key(group: str, within: str) -> Column:
    return F.struct(F.col(group).alias("g"), F.col(within).alias("d"))


def _key_at(group: str) -> Column:
    """The least key of a group."""
    return F.struct(F.col(group).alias("g"), F.lit(LEAST).alias("d"))


def _sizes(ranged: DataFrame) -> DataFrame:
    low, high = F.min(_key("g", "d")).alias("low"), F.max(_key("g", "d")).alias("high")
    return ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), low, high)


def _range_of(key: Column, splitters: Column) -> Column:
    """How many of the sorted splitters are at or below the key, by halving."""
    steps = F.sequence(F.lit(1), F.lit(MAX_RANGES.bit_length() + 3))
    start = F.struct(F.lit(0).alias("lo"), F.size(splitters).alias("hi"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["lo"] + at["hi"], 1)
        above = F.get(splitters, middle) <= key
        narrowed = F.struct(
            F.when(above, middle + 1).otherwise(at["lo"]).alias("lo"), F.when(above, at["hi"]).otherwise(middle).alias("hi")
        )
        return F.when(at["lo"] < at["hi"], narrowed).otherwise(at)

    return F.aggregate(steps, start, halve, lambda at: at["lo"])


def _ranged(rows: DataFrame, group: str, within: str, splitters: DataFrame) -> DataFrame:
    """`rows` with their `_range`; the one row of splitters is a scalar subquery, a literal to every task."""
    rows = rows.withColumn("_splitters", splitters.scalar())
    return rows.withColumn("_range", _range_of(_key(group, within), F.col("_splitters"))).drop("_splitters")


def _drawn(keys: DataFrame, rate: float, seed: int) -> DataFrame:
    """Keys kept with probability min(1, size * rate); `weight` makes up for sizes beyond 1 / rate."""
    chance = F.col("size") * F.lit(rate)
    draw = F.shiftrightunsigned(F.xxhash64("g", "d", "size", F.lit(seed)), 11) / F.lit(float(1 << 53))
    return keys.where(draw < chance).withColumn("weight", F.greatest(F.lit(1.0), chance))


def _as_row(splitters: DataFrame) -> DataFrame:
    return stage(splitters.agg(F.sort_array(F.collect_set("key")).alias("splitters")), "splitters")


def sharded(
    docs: DataFrame,
    shards: int = 16,
    group: Column | None = None,
    within: Column | None = None,
    size: Column | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The records with `size`, `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    Law: the sizes of the shards are near equal. Records are ordered by `group` (a hash of the text
    by default, so equal texts are neighbours) and `within` (doc_id). A group of up to 0.35 of a
    shard lies in one shard; only larger ones are cut where a shard ends. Groups that fill more than
    a range go to the shards in turn, by falling size; all other ranges fill the shards up in order, so
    sizes differ by about a range (a 64th of a shard or less) unless such groups make up most of the bytes.
    Null doc_ids come first. Rows with equal keys and sizes are interchangeable; a row
    larger than a range is a range of its own. An empty table gives no rows. Input columns named
    size, shard or slot are replaced.
    """
    text = F.col("text")
    group = F.xxhash64(text) if group is None else group
    within = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)) if within is None else within
    size = record_size(text) if size is None else size
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    keyed = docs.select(*[docs[c] for c in kept], size.alias("size"), group.alias("_g"), within.alias("_d"))
    keys = stage(docs.select(group.alias("g"), within.alias("d"), size.alias("size")), "shard-keys")
    whole = keys.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    if not whole["rows"]:
        return keyed.select(*kept, "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    total = whole["bytes"]
    wanted = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, -(-total // range_bytes)))
    each, rate = total / wanted, OVERSAMPLING * wanted / total

    sample = _drawn(keys, rate, 0)
    place = F.sum("weight").over(Window.orderBy("g", "d").rowsBetween(Window.unboundedPreceding, -1))
    cut = F.floor(F.coalesce(place, F.lit(0.0)) / OVERSAMPLING)
    splitters = _as_row(
        sample.select(cut.alias("cut"), "g").groupBy("cut").agg(F.min("g").alias("g"))
        .select(F.struct("g", F.lit(LEAST).alias("d")).alias("key"))
    )
    for turn in range(1, ROUNDS + 2):
        ranged = _ranged(keys, "g", "d", splitters).withColumnRenamed("_range", "range")
        sizes = stage(_sizes(ranged), "ranges")
        full = sizes.where((F.col("bytes") > OVERFULL * each) & (F.col("low") < F.col("high")))
        if turn > ROUNDS or full.isEmpty():
            break
        again = _drawn(ranged.join(F.broadcast(full.select("range")), "range", "left_semi"), rate, turn)
        place = F.sum("weight").over(Window.partitionBy("range").orderBy("g", "d").rowsBetween(Window.unboundedPreceding, -1))
        cut = F.floor(F.coalesce(place, F.lit(0.0)) / OVERSAMPLING)
        more = again.select("range", cut.alias("cut"), _key("g", "d").alias("key")).groupBy("range", "cut").agg(F.min("key").alias("key"))
        splitters = _as_row(splitters.select(F.explode("splitters").alias("key")).union(more.select("key")))

    # One row per range: the only windows without a key, over at most a few times MAX_RANGES rows.
    in_order = Window.orderBy("range")
    divided = sizes.withColumn("before", F.lag("high.g").over(in_order)).where(F.col("before") == F.col("low.g")).select(F.col("low.g").alias("g")).distinct()
    divided = stage(divided, "divided-groups")
    if not divided.isEmpty():
        # Cut at both ends of such a group too, so that its ranges hold nothing else.
        edges = [F.col("g"), F.try_add(F.col("g"), F.lit(1).cast("long"))] if dict(divided.dtypes)["g"] == "bigint" else [F.col("g")]
        more = divided.select(F.explode(F.array(*edges)).alias("g")).where("g IS NOT NULL").select(_key_at("g").alias("key"))
        splitters = _as_row(splitters.select(F.explode("splitters").alias("key")).union(more))
        sizes = stage(_sizes(_ranged(keys, "g", "d", splitters).withColumnRenamed("_range", "range")), "ranges")

    shard_bytes = total / shards
    alone = sizes.where(F.col("low.g") == F.col("high.g")).join(F.broadcast(divided.select(F.struct("g").alias("own"))), F.col("low.g") == F.col("own.g"))
    groups = alone.groupBy(F.col("own.g").alias("g")).agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= WHOLE * shard_bytes)
    rank = F.row_number().over(Window.orderBy(F.desc("bytes"), "g")) - 1
    turn, place = F.floor(rank / shards), rank % shards
    groups = stage(groups.select("g", "bytes", F.when(turn % 2 == 0, place).otherwise(shards - 1 - place).cast("int").alias("own_shard")), "whole-groups")
    taken = groups.groupBy("own_shard").agg(F.sum("bytes").alias("taken"))
    room = F.greatest(F.lit(0.0), F.lit(shard_bytes) - F.coalesce("taken", F.lit(0)))
    shelf = docs.sparkSession.range(shards).select(F.col("id").cast("int").alias("own_shard")).join(taken, "own_shard", "left").select("own_shard", room.alias("room"))
    ends = stage(shelf.select("own_shard", F.sum("room").over(Window.orderBy("own_shard")).alias("end")), "shard-ends").agg(F.sort_array(F.collect_list("end")).alias("ends"))

    owned = sizes.join(F.broadcast(groups.select(F.struct("g").alias("own"), "own_shard")), (F.col("low.g") == F.col("own.g")) & (F.col("high.g") == F.col("own.g")), "left")
    free = F.when(F.col("own_shard").isNull(), F.col("bytes")).otherwise(0)
    before = F.coalesce(F.sum(free).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole_free = F.greatest(F.sum(free).over(Window.partitionBy()), F.lit(1))
    spread = owned.withColumn("at", (before + free / 2) / whole_free).withColumn("ends", ends.scalar())
    passed = F.size(F.filter("ends", lambda e: e <= F.col("at") * F.element_at("ends", -1)))
    placed = spread.withColumn("shard", F.coalesce("own_shard", F.least(passed, F.lit(shards - 1))))
    ahead = F.sum("rows").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    placed = stage(placed.select(F.col("range").alias("_range"), "shard", F.coalesce(ahead, F.lit(0)).alias("_ahead")), "range-places")
    ranged = _ranged(keyed, "_g", "_d", splitters)
    number = F.row_number().over(Window.partitionBy("_range").orderBy("_g", "_d", "size"))
    return (
        ranged.join(broadcast_if_small(placed, 48), "_range")
        .withColumn("slot", F.col("_ahead") + number - 1)
        .select(*kept, "size", "shard", "slot")
    )
