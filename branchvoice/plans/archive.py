"""Archived variants: staging, normalised reviews, clean mart, bank and topic marts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchvoice.functions import dates, names, scores, text
from branchvoice.operators.joins import lookup_join
from branchvoice.operators.ranking import number_rows
from branchvoice.operators.storage import measured, stored
from branchvoice.plans.reviews import EXACT_KEYS, filter_valid, int_reviews_deduplicated, with_quality


def stg_raw_reviews_archived(raw: DataFrame, min_len: int = 5, max_len: int = 2000) -> DataFrame:
    """Defaults without trimming; ratings stripped to digits and dots."""
    named = raw.select(
        "id",
        *[text.handle_missing(F.col(c), "Unknown").alias(c) for c in [*EXACT_KEYS, "localisation"]],
        scores.strip_rating(F.col("note")).alias("note_raw"),
        text.handle_missing(F.col("avis")).alias("avis_raw"),
        text.handle_missing(F.col("date_avis")).alias("date_avis_raw"),
        "created_at",
    )
    return filter_valid(named, min_len, max_len)


def int_reviews_cleaned_archived(stg: DataFrame) -> DataFrame:
    """Adds the normalised text and the parsed date to the cleaning step."""
    cleaned = stg.select(
        "id",
        *EXACT_KEYS,
        "localisation",
        scores.parse_rating(F.col("note_raw")).alias("note_numeric"),
        F.col("avis_raw").alias("avis_original"),
        text.clean_text(F.col("avis_raw")).alias("avis_cleaned"),
        text.normalize_text(F.col("avis_raw")).alias("avis_normalized"),
        F.length("avis_raw").alias("avis_length_original"),
        text.detect_language(F.col("avis_raw")).alias("langue_detected"),
        "date_avis_raw",
        dates.parse_date_basic(F.col("date_avis_raw")).alias("date_avis_parsed"),
        "created_at",
    )
    return with_quality(cleaned.withColumn("avis_length_cleaned", F.length("avis_cleaned")))


def staging_variant(raw: DataFrame) -> DataFrame:
    return int_reviews_cleaned_archived(stg_raw_reviews_archived(raw))


def int_reviews_normalized(raw: DataFrame) -> DataFrame:
    """Kept reviews with normal names, rating bin and month."""
    flagged = int_reviews_deduplicated(staging_variant(raw), body="avis_normalized")
    kept = flagged.filter("should_keep").drop("duplicate_rank", "similar_rank")
    return kept.withColumns(
        {
            "banque_normalized": names.normalize_bank(F.col("banque")),
            "ville_normalized": names.normalize_city(F.col("ville")),
            "note_category": scores.rating_bin(F.col("note_numeric")),
            "review_period": dates.review_period(F.col("date_avis_parsed")),
        }
    )


def with_city_stats(df: DataFrame) -> DataFrame:
    """Number, mean rating and positive ratings of the row's bank and city.

    The statistics are aggregated first (combined before the shuffle) and looked up, so
    no window gathers all rows of a large bank in one task.
    """
    stats = measured(
        df.groupBy("banque", "ville").agg(
            F.count("*").alias("total_reviews_in_city"),
            scores.mean(F.sum("note"), F.count("note")).alias("avg_rating_in_city"),
            F.count_if(F.col("note") >= 4).alias("positive_reviews_in_city"),
        )
    )
    return lookup_join(df, stats, ["banque", "ville"])


def mart_reviews_clean(normalized: DataFrame, as_of: str) -> DataFrame:
    clean = normalized.select(
        "id", "content_hash", F.col("banque_normalized").alias("banque"), F.col("ville_normalized").alias("ville"),
        "nom_agence", "localisation", "avis_original", "avis_cleaned", "avis_normalized",
        F.col("langue_detected").alias("langue"), F.col("note_numeric").alias("note"), "note_category",
        "avis_length_original", "avis_length_cleaned", "text_length_category", "text_quality_score",
        F.col("date_avis_parsed").alias("date_avis"), "review_period", "created_at",
        (F.col("text_quality_score") >= 0.8).alias("is_high_quality"),
        F.col("langue_detected").isin("fr", "ar").alias("is_valid_language"),
        (F.col("note_numeric") > 0).alias("has_rating"),
        F.to_timestamp(F.lit(as_of)).alias("processed_at"),
    )
    # The statistics read four narrow columns of what is stored already.
    return with_city_stats(clean)


def review_scores(mart: DataFrame) -> DataFrame:
    """Input of the two marts below, whose source table was never defined: the enriched
    mart and a score of 60 % rating and 40 % sentiment.

    Topic category and confidence come with a mart that carries topic and probability; the
    bank metrics need neither.
    """
    positive, negative = F.col("sentiment") == "Positif", F.col("sentiment") == "Negatif"
    feeling = F.when(positive, F.lit("0.4")).when(negative, F.lit("0.0")).otherwise("0.2").cast("decimal(2,1)")
    topic = (
        [names.topic_category(F.col("topic")).alias("topic_category"), F.col("topic_probability").alias("topic_confidence")]
        if "topic_probability" in mart.columns else []
    )
    return mart.select(
        "banque",
        "ville",
        "nom_agence",
        F.col("note").alias("rating"),
        (F.col("note") * F.lit("0.12").cast("decimal(3,2)") + feeling).cast("decimal(5,3)").alias("composite_score"),
        positive.cast("int").alias("is_positive"),
        negative.cast("int").alias("is_negative"),
        (F.col("sentiment") == "Neutre").cast("int").alias("is_neutral"),
        dates.review_date(F.col("date_avis")).alias("review_date"),
        F.col("langue").alias("language"),
        *topic,
    )


def mart_banks_performance(scored: DataFrame, as_of: str) -> DataFrame:
    """Metrics per bank and city, ranked inside the city and overall."""
    rows = F.count("*")
    metrics = scored.groupBy(F.col("banque").alias("bank_name"), F.col("ville").alias("city")).agg(
        rows.alias("total_reviews"),
        F.count_distinct("nom_agence").alias("total_agencies"),
        scores.mean(F.sum("rating"), rows).alias("avg_rating"),
        scores.mean(F.sum("composite_score"), rows).alias("avg_composite_score"),
        F.sum("is_positive").alias("positive_reviews"),
        F.sum("is_negative").alias("negative_reviews"),
        F.sum("is_neutral").alias("neutral_reviews"),
        scores.pct(F.sum("is_positive"), rows).alias("positive_percentage"),
        scores.pct(F.sum("is_negative"), rows).alias("negative_percentage"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
        F.count_if(F.col("language") == "fr").alias("french_reviews"),
        F.count_if(F.col("language") == "ar").alias("arabic_reviews"),
    )
    best_first = [F.desc("avg_composite_score"), F.asc("bank_name"), F.asc("city")]
    ranked = number_rows(metrics, "global_rank", best_first)
    # One row per bank and city is left, so a window holds the banks of one city.
    in_city = Window.partitionBy("city").orderBy(*best_first)
    return ranked.withColumn("city_rank", F.row_number().over(in_city)).withColumn(
        "calculated_at", F.to_timestamp(F.lit(as_of))
    )


def mart_topic_analysis(scored: DataFrame) -> DataFrame:
    """Metrics per topic category and bank with the category's positive rate as benchmark."""
    rows = F.count("*")
    analysis = stored(
        scored.groupBy("topic_category", F.col("banque").alias("bank_name")).agg(
            rows.alias("review_count"),
            scores.mean(F.sum("rating"), rows).alias("avg_rating"),
            scores.mean(F.sum("topic_confidence"), F.count("topic_confidence")).alias("avg_confidence"),
            F.sum("is_positive").alias("positive_count"),
            F.sum("is_negative").alias("negative_count"),
            F.sum("is_neutral").alias("neutral_count"),
            scores.pct(F.sum("is_positive"), rows).alias("positive_rate"),
            scores.pct(F.sum("is_negative"), rows).alias("negative_rate"),
            F.count_if(F.col("language") == "fr").alias("french_count"),
            F.count_if(F.col("language") == "ar").alias("arabic_count"),
        )
    )
    benchmark = topic_summary(analysis).select("topic_category", F.col("overall_positive_rate").alias("topic_benchmark"))
    return lookup_join(analysis, measured(benchmark), ["topic_category"])


def topic_summary(analysis: DataFrame) -> DataFrame:
    """Second aggregation level; the overall rating is the mean of the banks' means.

    Those are taken in whole billionths, so that their sum does not depend on its order.
    """
    tenths = F.round(F.col("avg_rating") * F.col("review_count") * 10).cast("long")
    billionths = scores.whole_ratio(tenths, F.col("review_count") * 10, 9)
    return analysis.groupBy("topic_category").agg(
        F.sum("review_count").alias("total_reviews"),
        (F.sum(billionths).cast("double") / F.count("*") / 1e9).alias("overall_avg_rating"),
        F.sum("positive_count").alias("total_positive"),
        F.sum("negative_count").alias("total_negative"),
        scores.pct(F.sum("positive_count"), F.sum("review_count")).alias("overall_positive_rate"),
    )
