"""From raw documents to a sharded training mix, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchvoice.llm import decontamination, language, minhash, mixing, sharding
from branchvoice.llm.stages import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones.

    Null texts and texts without a letter go; very long ones are parsed whole; repeated rows are judged
    alike and all stay or go; a null lang only takes a row out of the labelled ones, a null doc_id
    changes nothing. An empty table stays empty. Columns are those of `docs`.
    """
    return language.in_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8).

    The smallest doc_id of a group stays, one row of it. Null and empty texts are in no group and stay;
    rows with a null doc_id all stay; whole texts are compared. An empty table stays empty.
    """
    return minhash.deduplicated(docs, shingle=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any test item.

    Null and wordless texts hold none, and null items are in none; repeated rows go or stay together; rows
    with a null doc_id stay. Without items or documents nothing goes.
    """
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for.

    A null source is a source of its own, the last; null and wordless texts have size 0 and are copied by a
    coin of their own; equal rows are decided together, a null doc_id is a value. An empty table stays empty.
    """
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """16 shards of nearly equal size.

    Every row gets a shard and a slot, null texts and null doc_ids too; equal texts share a shard
    unless they fill 0.35 of one. An empty table stays empty.
    """
    return sharding.sharded(docs, shards=16)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination_stage),
    ("mixing", mix),
    ("sharding", shard),
]

#: Models, signatures and draws are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
