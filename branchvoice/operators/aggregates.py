"""Profiles, top values and unions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row count and NULLs of every column in one pass."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[(F.count("*") - F.count(c)).alias(f"{c}_nulls") for c in cols],
    )


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def top_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The k most frequent non-NULL values; equal counts by value."""
    counts = count_by(df.filter(F.col(col).isNotNull()), col)
    return counts.orderBy(F.desc("n"), col).limit(k)


def distinct_of(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows of the columns, the first of which must be present."""
    return df.filter(F.col(cols[0]).isNotNull()).select(*cols).distinct()


def sample_rows(df: DataFrame, n: int = 3, chars: int = 50) -> DataFrame:
    """First n rows by id with a text excerpt."""
    return (
        df.select("id", "banque", "ville", F.left("avis", F.lit(chars)).alias("avis_extrait"))
        .orderBy("id")
        .limit(n)
    )


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in the given order, to look at."""
    return df.orderBy(*order).limit(n)


def by_language(df: DataFrame, lang: str) -> DataFrame:
    return df.filter(F.col("langue") == lang)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_total_row(df: DataFrame, key: str, label: str, *sums: Column) -> DataFrame:
    """Sums per key and one row over all rows, by one aggregation with grouping sets.

    `sums` are aggregates with aliases. A missing key is a key; without rows there is no total.
    """
    is_total = F.grouping(key)
    grouped = df.rollup(key).agg(is_total.alias("_total"), *sums)
    return grouped.withColumn(key, F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(key))).drop("_total")
