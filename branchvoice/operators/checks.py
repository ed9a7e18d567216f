"""Data-quality checks: the failing rows, or one summary row per check."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchvoice.operators.storage import stored


def not_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")


def not_unique_text(df: DataFrame, keys: list[str], body: str) -> DataFrame:
    """Combinations of keys and a long text that occur more than once.

    Groups are formed by a digest of the text; texts are fetched for the failures only.
    """
    digest = F.unhex(F.sha2(F.col(body), 256)).alias("_digest")
    groups = df.groupBy(*keys, digest).agg(F.count("*").alias("n"), F.min("id").alias("_first")).filter("n > 1")
    failures = stored(groups.select(F.col("_first").alias("id"), "n"), "failures")
    return df.select("id", *keys, body).join(failures, "id").drop("id")


def missing(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def not_accepted(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    return df.filter(~F.col(col).isin(values)).groupBy(col).agg(F.count("*").alias("n"))


def violates(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is false; unknown passes."""
    return df.filter(~rule)


def rule_summary(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with its number of violations, all rules in one pass."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return _with_status(counts.unpivot([], list(rules), "check_name", "failures"))


def _with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def summary(name: str, failing: DataFrame) -> DataFrame:
    counts = failing.agg(F.count("*").alias("failures"))
    return _with_status(counts.select(F.lit(name).alias("check_name"), "failures"))


def freshness(df: DataFrame, col: str, as_of: str, warn_days: int = 1, error_days: int = 7) -> DataFrame:
    """Age of the newest row against as_of: pass, warn or error."""
    age = F.unix_timestamp(F.to_timestamp(F.lit(as_of))) - F.unix_timestamp("newest")
    return (
        df.agg(F.max(col).alias("newest"))
        .withColumn("age_hours", F.floor(age / 3600).cast("long"))
        .withColumn(
            "status",
            F.when(age > error_days * 86400, "error").when(age > warn_days * 86400, "warn").otherwise("pass"),
        )
    )
