"""Star schema over the enriched mart."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchvoice.functions import dates, names, rules
from branchvoice.operators.aggregates import distinct_of
from branchvoice.operators.joins import lookup_join, lookup_key
from branchvoice.operators.ranking import number_rows
from branchvoice.operators.storage import measured


def _stamped(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("created_at", F.to_timestamp(F.lit(as_of)))


def dim_bank(mart: DataFrame, as_of: str) -> DataFrame:
    banks = distinct_of(mart.withColumnRenamed("banque", "bank_name"), "bank_name")
    keyed = number_rows(banks, "bank_key", ["bank_name"])
    name = F.col("bank_name")
    return _stamped(
        keyed.select(
            "bank_key", "bank_name", names.bank_type(name).alias("bank_type"), names.founded_year(name).alias("founded_year")
        ),
        as_of,
    )


def dim_branch(mart: DataFrame, as_of: str) -> DataFrame:
    named = mart.select(
        F.col("nom_agence").alias("branch_name"), F.col("banque").alias("bank_name"), F.col("ville").alias("city")
    )
    branches = distinct_of(named, "branch_name", "bank_name", "city")
    keyed = number_rows(branches, "branch_key", ["bank_name", "city", "branch_name"])
    name = F.col("branch_name")
    return _stamped(
        keyed.select(
            "branch_key",
            "branch_name",
            "bank_name",
            "city",
            names.branch_type(name).alias("branch_type"),
            names.branch_services(name).alias("services"),
        ),
        as_of,
    )


def dim_location(mart: DataFrame, as_of: str, keep_address: bool = False) -> DataFrame:
    """One row per city and address. The address is part of the grain, not of the output,
    unless a full-grain join needs it."""
    named = mart.select(F.col("ville").alias("city"), F.col("localisation").alias("address"))
    keyed = number_rows(distinct_of(named, "city", "address"), "location_key", ["city", "address"])
    city = F.col("city")
    return _stamped(
        keyed.select(
            "location_key",
            "city",
            *(["address"] if keep_address else []),
            names.city_region(city).alias("region"),
            names.city_centre(city).alias("coordinates"),
            names.city_size(city).alias("city_size"),
        ),
        as_of,
    )


def dim_sentiment(spark: SparkSession, as_of: str) -> DataFrame:
    fields = ("sentiment_key", "sentiment", "score_range", "description")
    values = [F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, row)]) for row in rules.SENTIMENTS]
    fixed = spark.range(1).select(F.inline(F.array(*values)))
    return _stamped(fixed, as_of)


def dim_topic(mart: DataFrame, as_of: str) -> DataFrame:
    topics = distinct_of(mart.withColumnRenamed("topic", "topic_name"), "topic_name")
    keyed = number_rows(topics, "topic_key", ["topic_name"])
    name = F.col("topic_name")
    return _stamped(
        keyed.select(
            "topic_key",
            "topic_name",
            names.topic_category(name).alias("category"),
            names.topic_description(name).alias("description"),
        ),
        as_of,
    )


@dataclass
class Star:
    """The mart table and its dimensions, whose keys are written once."""

    mart: DataFrame
    bank: DataFrame
    branch: DataFrame
    location: DataFrame
    sentiment: DataFrame
    topic: DataFrame
    as_of: str


def star_schema(mart: DataFrame, as_of: str) -> Star:
    """Dimensions of a written mart, which is read once per dimension and for the fact.

    Each dimension is written once, with its size, so that joins neither measure nor build it again.
    """
    builders = {"bank": dim_bank, "branch": dim_branch, "location": _full_location, "topic": dim_topic}
    # Independent small jobs: submitted together, so they share the cluster.
    with ThreadPoolExecutor(len(builders)) as pool:
        running = {name: pool.submit(lambda b=build, n=name: measured(b(mart, as_of), f"dim-{n}")) for name, build in builders.items()}
        dims = {name: job.result() for name, job in running.items()}
    return Star(mart=mart, sentiment=measured(dim_sentiment(mart.sparkSession, as_of), "dim-sentiment"), as_of=as_of, **dims)


def _full_location(mart: DataFrame, as_of: str) -> DataFrame:
    return dim_location(mart, as_of, keep_address=True)


def _reviews(mart: DataFrame) -> DataFrame:
    return mart.select(
        F.col("id").alias("review_id"),
        F.col("note").alias("rating"),
        F.col("avis").alias("review_text"),
        F.col("langue").alias("language"),
        "date_avis",
        "sentiment",
        F.col("topic").alias("topic_name"),
        F.col("banque").alias("bank_name"),
        F.col("nom_agence").alias("branch_name"),
        F.col("ville").alias("city"),
        F.col("localisation").alias("address"),
    )


def fact_flags(df: DataFrame) -> DataFrame:
    """0/1 flags; a missing rating is 0.0 and therefore counts as negative."""
    flags = {
        "is_positive_rating": F.col("rating") >= 4,
        "is_negative_rating": F.col("rating") <= 2,
        "is_positive_sentiment": F.col("sentiment") == "Positif",
        "is_negative_sentiment": F.col("sentiment") == "Negatif",
    }
    return df.withColumns({name: F.coalesce(test, F.lit(False)).cast("int") for name, test in flags.items()})


def date_parts(df: DataFrame, as_of: str) -> DataFrame:
    """Date, year and month of the date label; as_of's year and month when it is unknown."""
    dated = df.withColumn("review_date", dates.review_date(F.col("date_avis")))
    day = F.col("review_date")
    return dated.withColumns(
        {"review_year": dates.review_year(day, as_of), "review_month": dates.review_month(day, as_of)}
    )


def fact_reviews(star: Star) -> DataFrame:
    """One row per review: every dimension is joined on its full grain."""
    keyed = _reviews(star.mart)
    for dim, on, key in (
        (star.bank, ["bank_name"], "bank_key"),
        (star.branch, ["branch_name", "bank_name", "city"], "branch_key"),
        (star.location, ["city", "address"], "location_key"),
        (star.sentiment, ["sentiment"], "sentiment_key"),
        (star.topic, ["topic_name"], "topic_key"),
    ):
        keyed = lookup_key(keyed, dim, on, key)
    return _fact_columns(_stamped(fact_flags(date_parts(keyed, star.as_of)), star.as_of))


def _fact_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "review_id", "bank_key", "branch_key", "location_key", "sentiment_key", "topic_key", "rating",
        "review_text", "language", "review_date", "created_at", "is_positive_rating", "is_negative_rating",
        "is_positive_sentiment", "is_negative_sentiment", F.length("review_text").alias("review_length"),
        "review_year", "review_month",
    )


def fact_fanout(star: Star) -> DataFrame:
    """How many fact rows every review has when joined as first specified.

    That specification joins branches without the city and locations on the city alone,
    so a review meets every branch of the same name and bank and every address of its
    city. The number of rows follows from counts per join key; the pairs themselves are
    never produced. Counting reports over that fact are sums of fact_rows.
    """
    branches = measured(star.branch.groupBy("branch_name", "bank_name").agg(F.count("*").alias("branch_matches")))
    places = measured(star.location.groupBy("city").agg(F.count("*").alias("location_matches")))
    counted = lookup_join(_reviews(star.mart), branches, ["branch_name", "bank_name"])
    counted = lookup_join(counted, places, ["city"])
    matches = {c: F.coalesce(c, F.lit(0)) for c in ("branch_matches", "location_matches")}
    # A left join keeps a review without any match as one row.
    rows = F.greatest("branch_matches", F.lit(1)) * F.greatest("location_matches", F.lit(1))
    dated = date_parts(counted.withColumns(matches).withColumn("fact_rows", rows), star.as_of)
    return dated.select(
        "review_id", "bank_name", "branch_matches", "location_matches", "fact_rows", "review_year", "review_month"
    )
