"""Reading and storing review tables."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchvoice.functions import rules
from branchvoice.operators.ranking import number_as_read, top_per_key
from branchvoice.operators.storage import as_table, stored
from branchvoice.sources.csv_scan import CORRUPT as _CORRUPT
from branchvoice.sources.csv_scan import scan_records

CSV_COLUMNS = {
    "Banque": "banque",
    "Ville": "ville",
    "Nom Agence": "nom_agence",
    "Localisation": "localisation",
    "Note": "note",
    "Avis": "avis",
    "Date Avis": "date_avis",
}
REVIEW_COLUMNS = list(CSV_COLUMNS.values())


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def select_as(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def require_columns(df: DataFrame, cols) -> DataFrame:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns {absent}; found {df.columns}")
    return df


def _csv(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """All-text scan; the header decides the columns, rows that do not fit are tagged."""
    options = {"sep": ";", "header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": encoding}
    header = spark.read.options(**options).csv(paths).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    return spark.read.options(
        **options, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, enforceSchema=False
    ).schema(schema).csv(paths)


#: Encodings in which quotes, separators and line ends are single ASCII bytes.
_SINGLE_BYTES = re.compile(r"(utf-?8|us-ascii|iso-8859-\d+|latin-?1|windows-125\d|cp125\d)\Z", re.IGNORECASE)


def read_reviews_csv(spark: SparkSession, path: str, encodings=("UTF-8", "ISO-8859-1")) -> DataFrame:
    """';'-separated reviews, header and byte-order mark handled by the scan.

    With two encodings, files that are not UTF-8 are read in the second one, the others in the
    first; every file is judged by its own bytes. One file is read by as many tasks as it has
    splits, whatever its quoted line breaks. Encodings of wider units are read one task per file.
    """
    if all(_SINGLE_BYTES.match(e) for e in encodings):
        return scan_records(spark, path, tuple(encodings))
    if len(encodings) > 1:
        raise ValueError(f"only encodings of single bytes can be told apart: {encodings}")
    return _csv(spark, path, encodings[0])


def as_raw_strings(df: DataFrame) -> DataFrame:
    """Seven text columns under their table names; missing-value tokens become NULL."""
    require_columns(df, CSV_COLUMNS)
    good = df.filter(F.col(_CORRUPT).isNull()) if _CORRUPT in df.columns else df
    named = select_as(good, CSV_COLUMNS)
    return named.select(
        *[F.when(~F.col(c).isin(rules.MISSING_TOKENS), F.col(c)).alias(c) for c in named.columns]
    )


def skipped_rows(df: DataFrame) -> DataFrame:
    """Number of rows that fit the header, and of those that did not and are left out."""
    # Every column is read: with fewer, a scan would not see which rows do not fit.
    whole = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns])) >= 0
    return df.agg(F.count_if(whole & F.col(_CORRUPT).isNull()).alias("loaded"), F.count(_CORRUPT).alias("skipped"))


def load_raw(df: DataFrame, path: str, loaded_at: str) -> DataFrame:
    """Full refresh of the raw table: new ids 1..n, one load time. The texts are written once."""
    numbered = number_as_read(df, "id").withColumn("created_at", F.to_timestamp(F.lit(loaded_at)))
    return as_table(numbered.select("id", *REVIEW_COLUMNS, "created_at"), path)


def write_reviews_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mark: bool = False) -> None:
    """';'-separated text with header; one part file per partition, each with a byte-order mark if asked for."""
    named = df.select(*[F.col(new).alias(old) for old, new in CSV_COLUMNS.items()])
    if mark:
        named = named.withColumnRenamed(named.columns[0], "\ufeff" + named.columns[0])
    named.write.mode("overwrite").options(
        sep=";", header=True, quote='"', escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, encoding=encoding,
    ).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """One comma-separated file with header; for reports, which are small by nature."""
    df.coalesce(1).write.mode("overwrite").options(header=True, escape='"').csv(path)


#: Columns a fact is looked up by, and bytes of a row group: the unit that a look-up opens or skips.
FACT_KEYS = ["review_year", "bank_key", "location_key"]
ROW_GROUP_BYTES = 16 << 20


def write_fact(df: DataFrame, path: str, row_group: int = ROW_GROUP_BYTES) -> None:
    """Fact for look-up by year, bank, location and review.

    Rebalancing keeps a bank's year together, joins small pieces and splits a large one over
    several tasks. Files are sorted by bank and location, so the bounds of a row group tell readers
    of a bank, or of a bank's location, which ones to open. Locations alone and review ids are
    spread over all row groups; dictionaries and Bloom filters tell those without them.
    """
    balanced = df.hint("rebalance", F.col("review_year"), F.col("bank_key"))
    options = {"parquet.block.size": row_group, "parquet.bloom.filter.enabled#review_id": True, "parquet.bloom.filter.enabled#location_key": True}
    (
        balanced.sortWithinPartitions(*FACT_KEYS)
        .write.mode("overwrite").options(**options)
        .partitionBy("review_year")
        .parquet(path)
    )


def find_facts(spark: SparkSession, path: str, **keys) -> DataFrame:
    """Rows of a written fact with these key values; filters that the scan decides by folder and row group."""
    fact = spark.read.parquet(path)
    require_columns(fact, keys)
    for column, value in keys.items():
        fact = fact.filter(F.col(column) == F.lit(value))
    return fact


def upsert_topics(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per id, the newer one where both have it."""
    both = old.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
    return top_per_key(both, ["id"], ["_age"], 1).drop("_age")


#: Folders of a topic table; a row's folder follows from its id.
TOPIC_BUCKETS = 64


def _in_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))


def write_topics(topics: DataFrame, path: str, buckets: int = TOPIC_BUCKETS) -> None:
    """Topic table in `buckets` folders by id, to be upserted in parts."""
    _write_buckets(_in_bucket(topics, buckets), path, "static")


def _write_buckets(rows: DataFrame, path: str, mode: str) -> None:
    spread = rows.hint("rebalance", F.col("bucket"))
    spread.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(path)


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def upsert_topic_table(spark: SparkSession, path: str, new: DataFrame, buckets: int = TOPIC_BUCKETS) -> int:
    """Upsert rows into a written topic table; returns the number of buckets that were rewritten.

    Only folders that an id of `new` falls into are read, merged and replaced; the files of all others
    stay as they are. What is merged is written before it replaces anything. `buckets` must be
    that of the table.
    """
    placed = stored(_in_bucket(new, buckets), "topic-changes")
    touched = [r["bucket"] for r in placed.select("bucket").distinct().collect()]  # at most `buckets`
    if not touched:
        return 0
    old = spark.read.parquet(path).filter(F.col("bucket").isin(touched)).select(*placed.columns)
    _write_buckets(stored(upsert_topics(old, placed), "topic-merge"), path, "dynamic")
    return len(touched)
