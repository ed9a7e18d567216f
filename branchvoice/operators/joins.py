"""Joins: broadcast behind a measured size, another way beyond it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchvoice.operators.storage import bytes_of

MAX_BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table may be broadcast; costs no job for a stage that was measured when written."""
    return bytes_of(df) <= max_bytes


def lookup_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left",
                max_bytes: int = MAX_BROADCAST_BYTES, columns: list[str] | None = None) -> DataFrame:
    """Join facts to a stored dimension (or some of its columns) on equal columns.

    A dimension that measures small is broadcast. A larger one is joined by a shuffle, and
    adaptive execution splits the partition of a key that holds many facts into as many
    tasks as its size asks for; cold keys cost nothing extra.
    """
    small = is_small(dim, max_bytes)
    dim = dim.select(*columns) if columns else dim
    return facts.join(F.broadcast(dim) if small else dim.hint("merge"), on, how)


def lookup_key(facts: DataFrame, dim: DataFrame, on: list[str], key: str,
               max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Surrogate key of the matching dimension row, -1 without one."""
    joined = lookup_join(facts, dim, on, "left", max_bytes, [*on, key])
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(-1)).cast("long"))


def attach_topics(reviews: DataFrame, topics: DataFrame, default: str, probability: bool = False) -> DataFrame:
    """Topic name per review id, the default label without one. Both sides are large.

    `probability` carries topic_probability along, so that nobody has to join for it again.
    """
    named = topics.select("id", F.col("topic_name").alias("topic"), *["topic_probability"] * probability)
    return reviews.join(named, "id", "left").withColumn("topic", F.coalesce("topic", F.lit(default)))


def topic_of(reviews: DataFrame, topics: DataFrame) -> DataFrame:
    """One topic name per review id, whatever the number of topic rows of that id."""
    one = topics.groupBy("id").agg(F.min("topic_name").alias("topic_name"))
    return reviews.join(one, "id", "left")
