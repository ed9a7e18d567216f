"""Mixing sources to target weights by pivotal dependent rounding.

Every document should be taken `target / source size` times, a number with a fraction. Fractions
of a source are paired; a random share of words moves from one document of a pair to the other
until one of them is whole. The words taken from the source are the same before and after each
move. Blocks of documents are rounded side by side; the single fraction that each leaves goes up a
reduction tree. At its root one block of documents that has waited takes up the last fractions,
largest document first, so a source misses its target by about its smallest documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from branchvoice.llm.stages import broadcast_if_small, ship, stage

WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST = 3
#: Documents per leaf of the reduction tree, and nodes joined at each higher level.
LEAF, FAN_IN = 1024, 64
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Target words per row (source, source_size): by weight, stopped at `most` times the size.

    Sources take the weights in turn, by code point, null last. Sorted by the level at which they
    stop, a source stops when its level is not above what is left for it and all later ones.
    The windows run over one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn.cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * most).withColumn("level", F.col("cap") / F.col("weight"))
    rank = Window.orderBy("level", F.col("source").asc_nulls_last())
    before, everything = rank.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("stops", F.col("level") <= left / weight_left)
    rest = F.sum("source_size").over(everything) - F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(everything)
    free = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("weight") * rest / free)
    return rows.select("source", "source_size", target.alias("target"))


def pivot(words: np.ndarray, chance: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Move words between pairs until at most one chance lies strictly between 0 and 1."""
    p = chance.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    while len(open_) > 1:
        even = len(open_) & ~1
        a, b = open_[0:even:2], open_[1:even:2]
        up = np.minimum((1 - p[a]) * words[a], p[b] * words[b])
        down = np.minimum(p[a] * words[a], (1 - p[b]) * words[b])
        rise = draw.random(len(a)) * (up + down) < down
        moved = np.where(rise, up, -down)
        p[a] += moved / words[a]
        p[b] -= moved / words[b]
        for x in (a, b):
            p[x] = np.where(p[x] < 1e-12, 0.0, np.where(p[x] > 1 - 1e-12, 1.0, p[x]))
        tail = open_[even:]
        open_ = np.concatenate([np.stack([a, b], 1).ravel(), tail])
        open_ = open_[(p[open_] > 0) & (p[open_] < 1)]
    return p


def sweep(words: np.ndarray, chance: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Round everything, largest document first: each trades its words with all smaller ones together.

    What is left over at the end is a smallest document's fraction, settled by a coin.
    """
    order = np.argsort(-words, kind="stable")
    w, p = words[order], chance[order].copy()
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        w_rest, p_rest = w[i + 1 :], p[i + 1 :]
        # All move along one direction, so that no document's chance is shifted on average.
        room = np.minimum(p_rest, 1 - p_rest)
        held = float(room @ w_rest)
        up, down = min((1 - p[i]) * w[i], held), min(p[i] * w[i], held)
        if not held > 0:
            p[i] = float(draw.random() < p[i])
        elif draw.random() * (up + down) < down:
            p_rest -= room * (up / held)
            p[i] = 1.0 if up < held else p[i] + up / w[i]
        else:
            p_rest += room * (down / held)
            p[i] = 0.0 if down < held else p[i] - down / w[i]
        p_rest[p_rest < 1e-12] = 0.0
        p_rest[p_rest > 1 - 1e-12] = 1.0
        if 0 < p[i] < 1:
            p[i] = float(draw.random() < p[i])
    out = np.empty_like(p)
    out[order] = p
    return out


def _rounded(seed: int, level: int, method):
    """One node of the tree: rounds its rows and names the parent of what is left."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["key", "id"], kind="stable", ignore_index=True)
        draw = np.random.default_rng([seed, level, int(block["source_id"].iloc[0]), int(block["block"].iloc[0])])
        p = method(block["words"].to_numpy(np.float64), block["chance"].to_numpy(np.float64), draw)
        return block.assign(chance=p, block=(block["block"] - 1) // FAN_IN + 1)

    return run


def _key() -> list:
    """What makes two rows the same document."""
    return [F.xxhash64("doc_id", "source", "text").alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id")]


def _settled():
    return (F.col("chance") == 0) | (F.col("chance") == 1)


def decided(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = 0, leaf: int = LEAF) -> DataFrame:
    """Copies of each distinct row: key, id, size, source_size, target, copies."""
    ship(docs.sparkSession)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    units = docs.select(*_key(), "source", size.alias("size"))
    units = stage(units.groupBy("key", "id", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("units"))
    sums = stage(sums, "source-sums")
    wanted = targets(sums.select("source", "source_size"), weights, most)
    wanted = wanted.withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    wanted = wanted.alias("w").join(sums.alias("s"), F.col("w.source").eqNullSafe(F.col("s.source"))).select("w.*", "s.units")
    wanted = stage(wanted, "source-targets")

    times = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    whole = F.floor(times + F.lit(1e-12))
    chance = F.greatest(times - whole, F.lit(0.0))
    coin = F.shiftrightunsigned(F.xxhash64("key", "id", F.lit(seed)), 11) / F.lit(float(1 << 53))
    plan = units.alias("u").join(broadcast_if_small(wanted, 200).alias("w"), F.col("u.source").eqNullSafe(F.col("w.source")))
    plan = plan.select(
        "key", "id", "size", "source_size", "target", "source_id", (F.col("size") * F.col("n")).cast("double").alias("words"),
        whole.cast("int").alias("whole"), F.when(F.col("size") > 0, chance).otherwise((coin < chance).cast("double")).alias("chance"),
        F.pmod("key", F.greatest(F.ceil(F.col("units") / leaf), F.lit(1))).alias("block"),
    )
    plan = stage(plan, "mix-plan")
    blocks = plan.agg(F.max("block")).first()[0] or 0
    result = ["key", "id", "size", "source_size", "target", (F.col("whole") + F.col("chance")).cast("int").alias("copies")]
    done, rest, level = plan.where(_settled()), plan.where(~_settled()), 0
    # Block 0 of each source waits: its documents take up what the last large documents leave.
    waiting, rest = rest.where("block = 0"), rest.where("block > 0")
    while blocks:
        rounded = stage(rest.groupBy("source_id", "block").applyInPandas(_rounded(seed, level, pivot), plan.schema), "mix-level")
        done, rest = done.union(rounded.where(_settled())), rounded.where(~_settled())
        if blocks <= FAN_IN:
            break
        blocks, level = (blocks - 1) // FAN_IN + 1, level + 1
    last = waiting.union(rest).withColumn("block", F.lit(0).cast("long")).groupBy("source_id")
    return done.union(stage(last.applyInPandas(_rounded(seed, 255, sweep), plan.schema), "mix-root")).select(*result)


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The documents with size (words), source_size, target (of the source), copies and taken (size * copies).

    Reruns agree whatever the partitioning: blocks and draws follow from row contents. Null or
    empty texts have size 0 and are copied by a coin of their own. Equal rows (doc_id, source and
    text) are decided together; a null source is a source, a null doc_id a value. Input columns
    named like those added are replaced. An empty table gives no rows. Parameters as in `decided`.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    plan = decided(docs, **parameters)
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(*[k.alias(f"_{n}") for k, n in zip(_key(), ("key", "id"))], *[docs[c] for c in kept])
    found = rows.join(plan, (rows["_key"] == plan["key"]) & (rows["_id"] == plan["id"]))
    return found.select(
        *[rows[c] for c in kept], *[plan[c] for c in added[:4]], (plan["size"] * plan["copies"]).alias("taken")
    )


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns unchanged."""
    plan = decided(docs, **parameters).where("copies > 0")
    rows = docs.select(*[k.alias(f"_{n}") for k, n in zip(_key(), ("key", "id"))], F.struct("*").alias("_row"))
    found = rows.join(plan, (rows["_key"] == plan["key"]) & (rows["_id"] == plan["id"]))
    return found.select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")
