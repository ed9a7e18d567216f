"""From raw reviews to the enriched mart."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchvoice.functions import dates, names, rules, scores, text
from branchvoice.operators.joins import attach_topics
from branchvoice.operators.ranking import first_per_key, rank_in_group, rank_rows
from branchvoice.operators.storage import stored

EXACT_KEYS = ["banque", "ville", "nom_agence"]
# What the topic corpus and the mart read of a kept review; the original text is not in it.
KEPT_COLUMNS = [
    "id", *EXACT_KEYS, "localisation", "note_numeric", "avis_cleaned", "langue_detected", "date_avis_raw",
]


def filter_valid(df: DataFrame, min_len: int = 5, max_len: int = 2000) -> DataFrame:
    return df.filter(
        (F.col("avis_raw") != "")
        & F.length("avis_raw").between(min_len, max_len)
        & (F.col("banque") != "Unknown")
    )


def stg_raw_reviews(raw: DataFrame) -> DataFrame:
    """Trimmed columns with defaults, valid reviews only."""
    named = raw.select(
        "id",
        *[text.blank_to(F.col(c), "Unknown").alias(c) for c in [*EXACT_KEYS, "localisation"]],
        text.blank_to(F.col("note"), "0").alias("note_raw"),
        text.blank_to(F.col("avis"), "").alias("avis_raw"),
        text.blank_to(F.col("date_avis"), "").alias("date_avis_raw"),
        "created_at",
    )
    return filter_valid(named)


def with_quality(df: DataFrame) -> DataFrame:
    size, lang = F.col("avis_length_cleaned"), F.col("langue_detected")
    return df.withColumns(
        {"text_quality_score": scores.text_quality(size, lang), "text_length_category": scores.length_bin(size)}
    )


def int_reviews_cleaned(stg: DataFrame) -> DataFrame:
    """Rating, clean text, language, quality."""
    cleaned = stg.select(
        "id",
        *EXACT_KEYS,
        "localisation",
        scores.parse_rating(F.col("note_raw")).alias("note_numeric"),
        F.col("avis_raw").alias("avis_original"),
        text.clean_text(F.col("avis_raw")).alias("avis_cleaned"),
        F.length("avis_raw").alias("avis_length_original"),
        text.detect_language(F.col("avis_raw")).alias("langue_detected"),
        "date_avis_raw",
        "created_at",
    )
    return with_quality(cleaned.withColumn("avis_length_cleaned", F.length("avis_cleaned")))


def _group_id(kind: str, *cols: str) -> Column:
    """Digest of several non-NULL texts; lengths in front keep their borders apart."""
    sized = [part for c in cols for part in (F.length(c).cast("string"), F.col(c))]
    return F.unhex(F.sha2(F.concat_ws(":", F.lit(kind), *sized), 256))


def with_group_ids(cleaned: DataFrame, body: str = "avis_cleaned") -> DataFrame:
    """Adds the group of exact copies, and of near copies (same bank, city and first 100
    characters)."""
    headed = cleaned.withColumn("_head", F.left(body, F.lit(100)))
    return headed.withColumns(
        {
            "exact_group": _group_id("exact", *EXACT_KEYS, body),
            "similar_group": _group_id("similar", "banque", "ville", "_head"),
        }
    ).drop("_head")


def duplicate_keys(tagged: DataFrame) -> DataFrame:
    """Two narrow rows per review, one for each of its groups."""
    pairs = [F.struct(F.lit(k).alias("kind"), F.col(f"{k}_group").alias("copies")) for k in ("exact", "similar")]
    return tagged.select("id", "created_at", F.inline(F.array(*pairs)))


def duplicate_ranks(keys: DataFrame, parts: int | None = None) -> DataFrame:
    """Rank of every review in its groups, earliest first.

    Works on narrow rows, both kinds in one pass: only digests, load time and id are
    sorted and shuffled.
    """
    order = ["created_at", "id"]
    ranked = rank_in_group(keys, "copies", order, "rank", parts) if parts else rank_rows(keys, "copies", order, "rank")
    rank = {kind: F.max(F.when(F.col("kind") == kind, F.col("rank"))) for kind in ("exact", "similar")}
    return ranked.groupBy("id").agg(
        rank["exact"].alias("duplicate_rank"), rank["similar"].alias("similar_rank")
    )


def dedup_decision(ranked: DataFrame, drop_similar: bool = False) -> DataFrame:
    """Duplicate flags, confidence and the keep decision from both ranks.

    Near copies are flagged and kept, unless `drop_similar`.
    """
    first, alone = F.col("duplicate_rank") == 1, F.col("similar_rank") == 1
    score = (
        F.when(first & alone, 1.0)
        .when(first, 0.8)
        .when(F.col("text_quality_score") > 0.8, 0.6)
        .otherwise(0.3)
    )
    return ranked.withColumns(
        {"is_exact_duplicate": ~first, "is_similar_duplicate": ~alone, "keep_confidence_score": score}
    ).withColumn(
        "should_keep",
        (~F.col("is_exact_duplicate") | (F.col("keep_confidence_score") >= 0.8)) & (alone if drop_similar else F.lit(True)),
    )


def int_reviews_deduplicated(
    cleaned: DataFrame, body: str = "avis_cleaned", parts: int | None = None, drop_similar: bool = False
) -> DataFrame:
    """All reviews with content hash, both ranks, flags and decision; drops nothing."""
    # Written once: the ranking (and its sampling pass) reads only ids, times and digests.
    tagged = stored(with_group_ids(cleaned, body), "cleaned")
    ranks = duplicate_ranks(duplicate_keys(tagged), parts)
    ranked = tagged.drop("exact_group", "similar_group").join(ranks, "id")
    hashed = ranked.withColumn("content_hash", F.md5(F.concat(*EXACT_KEYS, body)))
    return dedup_decision(hashed, drop_similar)


def kept_reviews(cleaned: DataFrame, body: str = "avis_cleaned") -> DataFrame:
    """The reviews the decision keeps, without ranking the rest.

    A review is kept exactly when it is the first of its copies: a later copy never
    reaches the 0.8 of the second condition. The digest in front makes the sort compare
    eight bytes instead of whole texts.
    """
    keys = [*EXACT_KEYS, body]
    return first_per_key(cleaned, [F.xxhash64(*keys), *keys], ["created_at", "id"])


def topic_corpus(kept: DataFrame) -> DataFrame:
    """Kept reviews long enough for the topic model."""
    body = F.col("avis_cleaned")
    return kept.filter(body.isNotNull() & (F.trim(body) != "") & (F.length(body) >= 10)).select(
        "id", body.alias("avis"), F.col("langue_detected").alias("langue"), "banque", "ville"
    )


def keyword_topics(corpus: DataFrame, fold: bool = False) -> DataFrame:
    """Topic table by keyword instead of a fitted model: same columns, exact results, and the language.

    Reviews without a keyword and reviews in neither language get no row; the
    probability is a fixed function of the id. With `fold` accents make no difference.
    """
    label = names.keyword_topic(F.col("avis"), fold)
    ids = F.lit(None).cast("int")
    for i, (_, value) in reversed(list(enumerate(rules.TOPIC_KEYWORDS))):
        ids = F.when(F.col("topic_name") == value, i).otherwise(ids)
    share = (F.pmod("id", F.lit(1000)) + 1).cast("decimal(10,0)") / 1000
    return (
        corpus.filter(F.col("langue").isin("fr", "ar"))
        .select("id", "langue", label.alias("topic_name"), share.cast("decimal(4,3)").alias("topic_probability"))
        .filter(F.col("topic_name").isNotNull())
        .select("id", ids.alias("topic_id"), "topic_name", "topic_probability", "langue")
    )


def filter_final(df: DataFrame) -> DataFrame:
    body = F.trim("avis")
    return df.filter(
        F.col("avis").isNotNull() & (body != "") & (F.length(body) >= 5) & F.col("banque").isNotNull()
    )


def reviews_enriched(kept: DataFrame, as_of: str) -> DataFrame:
    """Kept reviews with normal names, date label and sentiment; all of the mart but its topic."""
    base = kept.select(
        "id",
        names.normalize_bank(F.col("banque")).alias("banque"),
        names.normalize_city(F.col("ville")).alias("ville"),
        "nom_agence",
        "localisation",
        F.round("note_numeric", 1).cast("decimal(2,1)").alias("note"),
        F.col("avis_cleaned").alias("avis"),
        F.col("langue_detected").alias("langue"),
        F.coalesce(dates.format_date_dmy(F.col("date_avis_raw"), as_of), F.lit(dates.UNKNOWN_DATE)).alias("date_avis"),
        text.analyze_sentiment(F.col("avis_cleaned")).alias("sentiment"),
    )
    return filter_final(base)


def mart_reviews_enriched(kept: DataFrame, topics: DataFrame, as_of: str, probability: bool = False) -> DataFrame:
    """The enriched reviews with their topic, and with its probability if asked for."""
    return attach_topics(reviews_enriched(kept, as_of), topics, rules.DEFAULT_TOPIC, probability)
