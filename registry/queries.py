"""Registered queries: every operator over the whole driver tables."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchvoice.functions import dates, names, rules, scores, sql, text
from branchvoice.operators import aggregates, checks
from branchvoice.operators.joins import attach_topics, lookup_join, topic_of
from branchvoice.operators.ranking import rank_rows
from branchvoice.operators.storage import as_table, as_view, new_path, shared_folder, stored
from branchvoice.plans import archive, reports, reviews, star, topics
from branchvoice.sources import crawl, documents, tables

AS_OF = "2025-06-30"
LOADED_AT = "2025-06-29 12:00:00"


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as long and decimals as double, for comparison across engines."""
    kinds = {T.IntegerType: "long", T.ShortType: "long"}

    def cast(field):
        kind = "double" if isinstance(field.dataType, T.DecimalType) else kinds.get(type(field.dataType))
        c = F.col(f"`{field.name}`")
        return c.cast(kind).alias(field.name) if kind else c

    return df.select(*[cast(f) for f in df.schema.fields])


class Build:
    """The models of one run over one folder of tables, each built at most once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return tables.source(self.spark, self.folder, name)

    @cached_property
    def pages(self) -> DataFrame:
        return documents.branch_pages(self.table("documents").select("doc_id", "n_chars", "text"))

    @cached_property
    def raw(self) -> DataFrame:
        return documents.raw_reviews(self.table("documents").select("doc_id", "n_chars", "text"))

    @cached_property
    def stg(self) -> DataFrame:
        return reviews.stg_raw_reviews(self.raw)

    @cached_property
    def cleaned(self) -> DataFrame:
        return reviews.int_reviews_cleaned(self.stg)

    @cached_property
    def dedup(self) -> DataFrame:
        return reviews.int_reviews_deduplicated(self.cleaned)

    @cached_property
    def kept(self) -> DataFrame:
        # Feeds the topic table and the mart.
        return stored(reviews.kept_reviews(self.cleaned).select(*reviews.KEPT_COLUMNS), "kept")

    @cached_property
    def corpus(self) -> DataFrame:
        return reviews.topic_corpus(self.kept)

    @cached_property
    def topics(self) -> DataFrame:
        return reviews.keyword_topics(self.corpus)

    @cached_property
    def enriched(self) -> DataFrame:
        """The mart before its topics."""
        return reviews.reviews_enriched(self.kept, AS_OF)

    @cached_property
    def models(self) -> list:
        """Topic models of this corpus, fitted once per application; a changed table gets models of its own."""
        return topics.saved_topic_models(self.corpus, f"{shared_folder(self.spark)}/{self.spark.sparkContext.applicationId}/topic-models")

    @cached_property
    def fitted(self) -> DataFrame:
        return topics.assigned(self.models, self.spark)

    @cached_property
    def mart(self) -> DataFrame:
        return reviews.mart_reviews_enriched(self.kept, self.topics, AS_OF)

    @cached_property
    def mart_table(self) -> DataFrame:
        """The mart as a table, for consumers that read it more than once."""
        return stored(self.mart, "mart")

    @cached_property
    def star(self) -> star.Star:
        return star.star_schema(self.mart_table, AS_OF)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_reviews(self.star)

    @cached_property
    def scored(self) -> DataFrame:
        return archive.review_scores(reviews.mart_reviews_enriched(self.kept, self.topics, AS_OF, probability=True))

    @cached_property
    def strict_years(self) -> DataFrame:
        """Bank and year of every review, counted once."""
        dated = star.date_parts(self.enriched.withColumnRenamed("banque", "bank_name"), AS_OF)
        return dated.select("bank_name", "review_year", F.lit(1).cast("long").alias("fact_rows"))


QUERIES = {}


def query(build):
    QUERIES[build.__name__] = lambda spark, folder: plain(build(Build(spark, folder)))
    return build


# --- flagship --------------------------------------------------------------------

@query
def bank_sentiment(b):
    """Kept reviews per bank and sentiment with the bank's share."""
    tagged = reviews.kept_reviews(b.cleaned)
    labelled = tagged.select(
        names.normalize_bank(F.col("banque")).alias("banque"),
        text.analyze_sentiment(F.col("avis_cleaned")).alias("sentiment"),
    )
    return labelled.groupBy("banque").agg(
        F.count("*").alias("reviews"),
        F.count_if(F.col("sentiment") == "Positif").alias("positive"),
        F.count_if(F.col("sentiment") == "Negatif").alias("negative"),
        scores.pct(F.count_if(F.col("sentiment") == "Positif"), F.count("*")).alias("satisfaction"),
    )


# --- staging and sources ---------------------------------------------------------

@query
def stg_raw_reviews(b):
    return b.stg


@query
def missing_value_default(b):
    return b.raw.select("id", text.handle_missing(F.col("nom_agence"), "Unknown").alias("nom_agence"),
                        text.handle_missing(F.col("ville"), "Unknown").alias("ville"))


@query
def null_profile(b):
    return aggregates.null_profile(b.raw, tables.REVIEW_COLUMNS)


@query
def top_banks(b):
    return aggregates.top_values(b.raw, "banque")


@query
def top_cities(b):
    return aggregates.top_values(b.raw, "ville")


@query
def review_sample(b):
    return aggregates.sample_rows(b.raw)


@query
def flatten_reviews(b):
    return crawl.flatten_reviews(b.pages)


def _page_parts(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id",
        F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("nom"),
        F.regexp_extract("url", "^https?://[^/]+/([a-z][a-z])/", 1).alias("localisation"),
        F.regexp_extract("url", "page=([0-5])", 1).alias("note"),
    )


@query
def page_defaults(b):
    return crawl.fill_page_defaults(_page_parts(b.table("pages")))


@query
def crawl_grid(b):
    banks = b.raw.filter(F.trim("banque") != "").select(F.trim("banque").alias("banque")).distinct()
    return crawl.crawl_grid(banks)


def _links(pages: DataFrame) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return pages.select("page_id", F.regexp_extract("html", 'lang="([a-z]*)"', 1).alias("lang"), F.explode(found).alias("url"))


@query
def unseen_links(b):
    links = _links(b.table("pages"))
    seen = links.filter(F.col("lang") == "fr")
    return crawl.unseen_links(links.filter(F.col("lang") != "fr"), seen, "page_id")


# --- round trips -----------------------------------------------------------------

def _raw_text(b) -> DataFrame:
    return b.raw.select(*tables.REVIEW_COLUMNS)


@query
def csv_reviews_scan(b):
    path = new_path(b.spark, "csv")
    tables.write_reviews_csv(_raw_text(b), path)
    return tables.as_raw_strings(tables.read_reviews_csv(b.spark, path))


@query
def csv_reviews_sink(b):
    path = new_path(b.spark, "csv")
    tables.write_reviews_csv(_raw_text(b), path)
    return tables.read_reviews_csv(b.spark, path, ["UTF-8"]).drop("_corrupt_record")


def _mixed_folder(b) -> str:
    """Reviews in UTF-8, those that fit it in Latin-1, marked ones with U+FFFD, and lines of the wrong width."""
    path, rows = new_path(b.spark, "mixed"), _raw_text(b)
    tables.write_reviews_csv(rows, f"{path}/utf8")
    latin = rows.filter(~F.coalesce(F.col("avis"), F.lit("")).rlike(r"[^\x{00}-\x{FF}]"))
    tables.write_reviews_csv(latin, f"{path}/latin1", "ISO-8859-1")
    tables.write_reviews_csv(rows.withColumn("avis", F.concat("avis", F.lit("\ufffd"))), f"{path}/marked")
    return path


@query
def csv_mixed_encodings(b):
    """Every file of a folder is decoded by what its own bytes are."""
    return tables.as_raw_strings(tables.read_reviews_csv(b.spark, _mixed_folder(b)))


@query
def csv_skipped_rows(b):
    """A line of two fields for every document among the reviews: left out, and counted."""
    path = new_path(b.spark, "bad")
    tables.write_reviews_csv(_raw_text(b), f"{path}/good")
    short = b.table("documents").select(F.lit("Banque;Ville").alias("value"))
    header = ";".join(tables.CSV_COLUMNS)
    b.spark.range(1).select(F.lit(header).alias("value")).union(short).coalesce(1).write.text(f"{path}/bad")
    return tables.skipped_rows(tables.read_reviews_csv(b.spark, path))


@query
def raw_full_refresh(b):
    loaded = tables.load_raw(_raw_text(b), new_path(b.spark, "raw"), LOADED_AT)
    return loaded.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("id").alias("ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.sum(F.length("avis")).alias("characters"),
        F.min("created_at").alias("created_at"),
    )


@query
def partitioned_fact(b):
    path = new_path(b.spark, "fact")
    tables.write_fact(b.fact, path)
    return (
        b.spark.read.parquet(path)
        .filter("review_year = 2024")
        .select("review_id", "bank_key", "location_key", "review_date", "review_year", "rating")
    )


@query
def fact_lookup(b):
    """Reviews of 2025 of bank 9 at its three first locations, and all reviews there: look-ups in the stored fact."""
    path = new_path(b.spark, "fact")
    tables.write_fact(b.fact, path)
    of_bank = tables.find_facts(b.spark, path, review_year=2025, bank_key=9)
    places = [r[0] for r in of_bank.filter("location_key > 0").select("location_key").distinct().orderBy("location_key").limit(3).collect()]
    found = [tables.find_facts(b.spark, path, location_key=place).withColumn("asked", F.lit("place")) for place in places]
    found += [of_bank.filter(F.col("location_key") == place).withColumn("asked", F.lit("bank and place")) for place in places]
    columns = ("asked", "review_id", "bank_key", "location_key", "review_date", "review_year", "rating")
    return aggregates.union_all(of_bank.limit(0).withColumn("asked", F.lit("")), *found).select(*columns)


@query
def csv_profile(b):
    """The profile of a CSV frame before it is loaded: missing-value tokens and rows that do not fit are not in it."""
    path = new_path(b.spark, "csv")
    tables.write_reviews_csv(_raw_text(b), path, mark=True)
    return aggregates.null_profile(tables.as_raw_strings(tables.read_reviews_csv(b.spark, path)), tables.REVIEW_COLUMNS)


@query
def report_csv(b):
    report = reports.report_bank_topic(b.mart)
    path = new_path(b.spark, "report")
    tables.write_report(report, path)
    return b.spark.read.options(header=True, escape='"').schema(report.schema).csv(path)


# --- cleaning ----------------------------------------------------------------------

def _from_raw(b, **cols):
    return b.raw.select("id", *[c.alias(name) for name, c in cols.items()])


@query
def clean_text(b):
    return _from_raw(b, avis_cleaned=text.clean_text(F.col("avis")))


@query
def normalize_text(b):
    return _from_raw(b, avis_normalized=text.normalize_text(F.col("avis")))


@query
def detect_language(b):
    return _from_raw(b, langue=text.detect_language(F.col("avis")))


@query
def detect_arabic(b):
    return _from_raw(b, langue=text.detect_arabic_any(F.col("avis")))


@query
def parse_rating(b):
    return _from_raw(b, note=scores.parse_rating(F.col("note")))


@query
def strip_rating(b):
    return _from_raw(b, note=scores.strip_rating(F.col("note")))


@query
def text_quality(b):
    return b.cleaned.select("id", "text_quality_score")


@query
def length_bin(b):
    return b.cleaned.select("id", "text_length_category")


@query
def int_reviews_cleaned(b):
    return b.cleaned


# --- dates -------------------------------------------------------------------------

@query
def format_date_dmy(b):
    label = dates.format_date_dmy(F.col("date_avis"), AS_OF)
    return _from_raw(b, date_avis=F.coalesce(label, F.lit(dates.UNKNOWN_DATE)))


@query
def parse_date_basic(b):
    return _from_raw(b, date_avis=dates.parse_date_basic(F.col("date_avis")))


@query
def date_parts(b):
    label = dates.format_date_dmy(F.col("date_avis"), AS_OF)
    return star.date_parts(_from_raw(b, date_avis=F.coalesce(label, F.lit(dates.UNKNOWN_DATE))), AS_OF)


@query
def review_period(b):
    return _from_raw(b, review_period=dates.review_period(dates.parse_date_basic(F.col("date_avis"))))


# --- duplicates ----------------------------------------------------------------------

@query
def content_hash(b):
    return b.cleaned.select("id", F.md5(F.concat(*reviews.EXACT_KEYS, "avis_cleaned")).alias("content_hash"))


def _one_rank(b, group: str, out: str) -> DataFrame:
    keys = stored(reviews.with_group_ids(b.cleaned).select("id", "created_at", group), "keys")
    return rank_rows(keys, group, ["created_at", "id"], out).select("id", out)


@query
def exact_duplicates(b):
    return _one_rank(b, "exact_group", "duplicate_rank")


@query
def similar_duplicates(b):
    return _one_rank(b, "similar_group", "similar_rank")


@query
def dedup_decision(b):
    return b.dedup.select("id", "is_exact_duplicate", "is_similar_duplicate", "keep_confidence_score", "should_keep")


@query
def int_reviews_deduplicated(b):
    return b.dedup


@query
def kept_reviews(b):
    return reviews.kept_reviews(b.cleaned).select("id", "banque", "ville", "nom_agence", "avis_cleaned")


# --- enrichment ----------------------------------------------------------------------

@query
def attach_topic_names(b):
    return attach_topics(b.kept.select("id", "banque"), b.topics, rules.DEFAULT_TOPIC)


@query
def topic_scalar_lookup(b):
    return topic_of(b.kept.select("id"), b.topics)


@query
def normalize_bank(b):
    return b.stg.select("id", names.normalize_bank(F.col("banque")).alias("banque"))


@query
def normalize_city(b):
    return b.stg.select("id", names.normalize_city(F.col("ville")).alias("ville"))


@query
def sentiment(b):
    return b.cleaned.select("id", text.analyze_sentiment(F.col("avis_cleaned")).alias("sentiment"))


@query
def sentiment_raw_text(b):
    return _from_raw(b, sentiment=text.analyze_sentiment(F.col("avis")))


@query
def mart_reviews_enriched(b):
    return b.mart


# --- star ----------------------------------------------------------------------------

@query
def mart_sorted_table(b):
    """The mart as a stored table sorted by id."""
    table = as_table(b.mart, new_path(b.spark, "mart"), order=["id"])
    return table.select("id", "banque", "note", "sentiment", "topic")


@query
def dim_bank(b):
    return star.dim_bank(b.mart, AS_OF)


@query
def dim_branch(b):
    return star.dim_branch(b.mart, AS_OF)


@query
def dim_location(b):
    return star.dim_location(b.mart, AS_OF)


@query
def dim_topic(b):
    return star.dim_topic(b.mart, AS_OF)


@query
def dim_sentiment(b):
    """The constant dimension with the number of reviews behind each row."""
    counts = stored(aggregates.count_by(b.mart, "sentiment", out="reviews"))
    return lookup_join(star.dim_sentiment(b.spark, AS_OF), counts, ["sentiment"]).na.fill(0, ["reviews"])


@query
def fact_reviews(b):
    return b.fact


@query
def fact_fanout(b):
    return star.fact_fanout(b.star)


# --- archived marts --------------------------------------------------------------------

@query
def staging_variant(b):
    return archive.staging_variant(b.raw)


@query
def reviews_normalized(b):
    return archive.int_reviews_normalized(b.raw)


@query
def reviews_clean(b):
    return archive.mart_reviews_clean(archive.int_reviews_normalized(b.raw), AS_OF)


@query
def banks_performance(b):
    return archive.mart_banks_performance(archive.review_scores(b.enriched), AS_OF)


@query
def topic_analysis(b):
    return archive.mart_topic_analysis(b.scored)


@query
def topic_summary(b):
    return archive.topic_summary(archive.mart_topic_analysis(b.scored))


# --- reports -----------------------------------------------------------------------------

@query
def report_bank_topic(b):
    return reports.report_bank_topic(b.mart)


@query
def report_topic_distribution(b):
    return reports.report_topic_distribution(b.mart)


@query
def report_topic_detail(b):
    return reports.report_topic_detail(b.mart_table)


@query
def report_category_insights(b):
    return reports.report_category_insights(b.mart)


@query
def branch_estimates(b):
    """Branch names and addresses per bank, estimated from the sketches of the topic cube: whether the
    estimates lie within their band of the exact numbers, which are counted beside them."""
    sketched = ("nom_agence", "localisation")
    estimated = reports.distinct_counts(reports.topic_cube(b.mart_table, sketched), "banque")
    exact = b.mart_table.groupBy("banque").agg(*[F.count_distinct(c).alias(c) for c in sketched])
    close = {f"{c}_close": F.abs(F.col(f"{c}_distinct") - F.col(c)) <= reports.SKETCH_BAND * F.col(c) for c in sketched}
    return exact.join(estimated, "banque").withColumns(close).select("banque", *sketched, *close)


@query
def report_bank_year(b):
    return reports.report_bank_year(b.strict_years)


@query
def report_bank_year_fanout(b):
    return reports.report_bank_year(star.fact_fanout(b.star))


@query
def report_bank_summary(b):
    return reports.report_bank_summary(reports.report_bank_year(b.strict_years))


@query
def report_bank_year_pivot(b):
    return reports.report_bank_year_pivot(reports.report_bank_year(b.strict_years))


# --- text preparation -----------------------------------------------------------------------

def _words(b, step):
    """A token step on both languages in one pass, words joined by spaces."""
    words = text.by_language(step, F.col("avis"), F.col("langue"), topics.LANGUAGES)
    return b.corpus.filter(F.col("langue").isin(topics.LANGUAGES)).select("id", F.array_join(words, " ").alias("words"))


@query
def prep_text(b):
    return _from_raw(b, prepared=text.prep_text(F.col("avis")))


@query
def tokens(b):
    return _words(b, lambda c, lang: text.filter_tokens(text.tokens(c)))


@query
def stopwords(b):
    return _words(b, lambda c, lang: text.drop_stopwords(text.tokens(c), lang))


@query
def stems(b):
    return _words(b, text.topic_words)


@query
def topic_corpus(b):
    return b.corpus


@query
def eligible_languages(b):
    return topics.eligible_languages(b.corpus)


# --- topic model ---------------------------------------------------------------------------

@query
def topic_vectors(b):
    """TF-IDF weights of every review of both languages."""
    frames = [
        topics.weights(m.tfidf(), m.known).select("id", F.lit(m.lang).alias("langue"), "term", F.round("weight", 6).alias("weight"))
        for m in topics.language_documents(b.corpus)
    ]
    return aggregates.union_all(*frames)


@query
def topic_vocabulary(b):
    """Terms of both languages that the models may use."""
    frames = [
        m.vocabulary.withColumn("langue", F.lit(m.lang)) for m in topics.language_documents(b.corpus)
    ]
    return aggregates.union_all(*frames)


@query
def topic_names_of_terms(b):
    """Names of topics whose strong terms are given: the vocabulary's first 40, five to a topic."""
    frames = []
    for m in topics.language_documents(b.corpus):
        first = m.vocabulary.orderBy(F.desc("occurrences"), "term").limit(topics.TOPICS * 5)
        rank = F.row_number().over(Window.orderBy(F.desc("occurrences"), "term")) - 1  # 40 rows
        strong = first.select("term", F.floor(rank / 5).cast("int").alias("topic_id"), (rank % 5).alias("place"))
        frames.append(topics.name_topics(strong, m.lang).withColumn("langue", F.lit(m.lang)))
    return aggregates.union_all(*frames)


@query
def topic_assignments(b):
    return b.fitted.drop("langue")


@query
def topic_names(b):
    return aggregates.union_all(*[m.names.withColumn("langue", F.lit(m.lang)) for m in b.models])


@query
def topic_sizes(b):
    return topics.topic_sizes(b.fitted)


@query
def topic_model_checks(b):
    """What holds for any fit: every document of a language has one topic of eight, with a probability."""
    frames = []
    for m in b.models:
        result, known = m.assignments(), m.documents.select("id", F.lit(1).alias("known"))
        joined = result.join(known, "id", "full")
        frames.append(joined.agg(
            F.count("known").alias("documents"),
            F.count("topic_id").alias("assigned"),
            F.count_if(F.col("known").isNull()).alias("unknown_ids"),
            F.count_if(~F.col("topic_id").between(0, topics.TOPICS - 1)).alias("bad_topics"),
            F.count_if(~((F.col("topic_probability") > 0) & (F.col("topic_probability") <= 1))).alias("bad_probabilities"),
            F.count_if(F.col("topic_name").isNull() & F.col("topic_id").isNotNull()).alias("unnamed"),
        ).withColumns({"langue": F.lit(m.lang), "names": F.lit(m.names.count())}))
    return aggregates.union_all(*frames)


@query
def mart_lda_checks(b):
    """The whole chain, fit to dimension: what does not depend on the fit."""
    table = stored(tables.upsert_topics(b.topics.drop("langue"), b.fitted.drop("langue")), "topics")
    mart = stored(reviews.mart_reviews_enriched(b.kept, table, AS_OF).select("id", "topic"), "lda-mart")
    dim = star.dim_topic(mart, AS_OF).select(F.col("topic_name").alias("topic"), F.lit(1).alias("in_dim"))
    used = mart.select("topic").distinct().withColumn("in_mart", F.lit(1)).join(dim, "topic", "full")
    fresh = mart.join(table.select("id", F.lit(1).alias("has_topic")), "id", "left").agg(
        F.count("*").alias("mart_rows"),
        F.count_if(F.col("has_topic").isNull()).alias("without_topic"),
        F.count_if(F.col("has_topic").isNull() & (F.col("topic") != rules.DEFAULT_TOPIC)).alias("wrong_default"),
        F.count_if(F.col("topic").isNull()).alias("unnamed"),
    )
    gaps = used.agg(F.count_if(F.col("in_dim").isNull() | F.col("in_mart").isNull()).alias("dimension_gaps"))
    sizes = table.agg(F.count("*").alias("topic_rows"))
    one = [x.withColumn("_one", F.lit(1)) for x in (fresh, gaps, sizes)]  # one row each
    return one[0].join(one[1], "_one").join(one[2], "_one").drop("_one")


@query
def topic_sizes_keyword(b):
    return topics.topic_sizes(b.topics)


@query
def topic_upsert(b):
    """New topic rows for rated documents replace the keyword rows of the same id."""
    rated = b.table("labels").select(documents.line_id(F.col("doc_id"), 0).alias("id"), F.col("quality").alias("topic_id"))
    new = rated.withColumns({"topic_name": F.lit("Service client"), "topic_probability": F.lit("0.500").cast("decimal(4,3)")})
    path = new_path(b.spark, "topic-table")
    tables.write_topics(b.topics.drop("langue"), path, buckets=16)
    tables.upsert_topic_table(b.spark, path, new, buckets=16)
    return tables.read_topics(b.spark, path)


# --- data quality ----------------------------------------------------------------------------

@query
def check_unique(b):
    return checks.summary("unique id", checks.not_unique(b.raw, "id"))


@query
def check_not_null(b):
    return checks.rule_summary(b.raw, {f"not null {c}": F.col(c).isNotNull() for c in ("id", "banque", "avis")})


@query
def check_accepted_values(b):
    return checks.not_accepted(b.mart, "banque", rules.ACCEPTED_BANKS)


@query
def check_expression(b):
    return checks.rule_summary(
        b.cleaned,
        {
            "note between 0 and 5": F.col("note_numeric").between(0, 5),
            "quality between 0 and 1": F.col("text_quality_score").between(0, 1),
        },
    )


@query
def check_unique_combination(b):
    return checks.not_unique_text(b.cleaned, reviews.EXACT_KEYS, "avis_cleaned")


@query
def check_freshness(b):
    return aggregates.union_all(
        checks.freshness(b.raw, "created_at", AS_OF).withColumn("table_name", F.lit("raw_reviews")),
        checks.freshness(b.table("events"), "ts", AS_OF).withColumn("table_name", F.lit("events")),
    )


@query
def load_verification(b):
    # The profile needs NULLs, the sample an excerpt: no whole text is stored.
    raw = stored(b.raw.withColumn("avis", F.left("avis", F.lit(50))), "raw")
    profile = aggregates.null_profile(raw, tables.REVIEW_COLUMNS)
    counts = profile.unpivot([], profile.columns, "item", "n").withColumn("section", F.lit("profile"))
    tops = [
        aggregates.top_values(raw, c).select(F.lit(c).alias("section"), F.col(c).alias("item"), "n")
        for c in ("banque", "ville")
    ]
    sample = aggregates.sample_rows(raw).select(
        F.lit("sample").alias("section"), F.col("avis_extrait").alias("item"), F.col("id").alias("n")
    )
    return aggregates.union_all(counts, *tops, sample)


# --- rest ------------------------------------------------------------------------------------

@query
def union_all(b):
    """Staged and kept reviews in one table."""
    return aggregates.union_all(
        b.stg.select("id", "banque", F.lit("staged").alias("origin")), b.kept.select("id", "banque", F.lit("kept").alias("origin"))
    )


@query
def preview_reviews(b):
    return aggregates.preview(b.stg.select("id", "banque", "ville", "note_raw"), 5, "id")


# --- options that the defaults leave off ---------------------------------------------------------

@query
def drop_similar(b):
    """Near copies dropped as well."""
    return reviews.int_reviews_deduplicated(b.cleaned, drop_similar=True).select("id", "is_similar_duplicate", "should_keep")


@query
def parse_rating_comma(b):
    return _from_raw(b, note=scores.parse_rating(F.col("note"), decimal_comma=True))


@query
def sentiment_whole_words(b):
    return b.cleaned.select("id", text.analyze_sentiment(F.col("avis_cleaned"), whole_words=True).alias("sentiment"))


@query
def format_date_exact(b):
    label = dates.format_date_dmy(F.col("date_avis"), AS_OF, exact_relative=True)
    return _from_raw(b, date_avis=F.coalesce(label, F.lit(dates.UNKNOWN_DATE)))


@query
def keyword_topics_folded(b):
    return reviews.keyword_topics(b.corpus, fold=True).select("id", "topic_id", "topic_name")


@query
def sql_functions(b):
    as_view(reviews.kept_reviews(b.cleaned), "kept_reviews")
    as_view(stored(b.topics.drop("langue"), "topics"), "review_topics")
    sql.register(b.spark, "review_topics")
    return b.spark.sql(f"""
        SELECT id, clean_text(avis_original) AS cleaned, normalize_text(avis_original) AS normalized,
               detect_language(avis_original) AS langue, handle_missing_values(nom_agence, 'Unknown') AS nom_agence,
               analyze_sentiment(avis_cleaned) AS sentiment,
               format_date_dmy(date_avis_raw, DATE'{AS_OF}') AS date_avis, get_lda_topic(id) AS topic
        FROM kept_reviews""")
