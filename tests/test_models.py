"""The model chain on small hand-made tables and on the smallest driver tables."""

from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import functions as F

from branchvoice.operators import checks
from branchvoice.plans import archive, reports, reviews, star
from registry.queries import Build

AS_OF = "2025-06-30"
T0 = datetime(2025, 1, 1)
RAW = "id long, banque string, ville string, nom_agence string, localisation string, note string, avis string, date_avis string, created_at timestamp"


def raw_row(i, avis, banque="CIH", ville="casa", agence="Agence Centre", lieu="1 rue", note="4", date="2024-03-05", at=T0):
    return (i, banque, ville, agence, lieu, note, avis, date, at)


@pytest.fixture(scope="module")
def small(spark):
    head = "le guichet est toujours ouvert le matin et les conseillers sont disponibles pour tous les clients du quartier "
    rows = [
        raw_row(1, "Excellent accueil"),
        raw_row(2, "excellent  accueil!"),  # same clean text as 1, same load time
        raw_row(3, "Excellent accueil", agence="Agence Mall"),  # other branch: only similar
        raw_row(4, head + "fin un"),
        raw_row(5, head + "fin deux"),  # same first 100 characters as 4
        raw_row(6, "abc"),  # too short
        raw_row(7, "bon service", banque="  "),  # unknown bank
        raw_row(8, "x" * 2001),  # too long
        raw_row(9, "attente longue", lieu="2 rue", date="hier", note="3,4"),
        raw_row(10, "guichet calme", ville="Rabat", lieu="9 rue"),
        raw_row(11, "?????!", ville="Rabat"),  # nothing left after cleaning
    ]
    return spark.createDataFrame(rows, RAW)


@pytest.fixture(scope="module")
def cleaned(small):
    return reviews.int_reviews_cleaned(reviews.stg_raw_reviews(small))


@pytest.fixture(scope="module")
def mart(cleaned):
    kept = reviews.kept_reviews(cleaned)
    return reviews.mart_reviews_enriched(kept, reviews.keyword_topics(reviews.topic_corpus(kept)), AS_OF)


def test_validity_filter(cleaned):
    assert {r["id"] for r in cleaned.select("id").collect()} == {1, 2, 3, 4, 5, 9, 10, 11}


@pytest.mark.parametrize("parts", [None, 5])
def test_duplicate_flags(cleaned, parts):
    got = {r["id"]: (r["duplicate_rank"], r["similar_rank"], r["keep_confidence_score"], r["should_keep"])
           for r in reviews.int_reviews_deduplicated(cleaned, parts=parts).collect()}
    assert got[1] == (1, 1, 1.0, True)
    assert got[2] == (2, 2, 0.3, False)  # clean text shorter than 20 characters
    assert got[3] == (1, 3, 0.8, True)
    assert got[4] == (1, 1, 1.0, True) and got[5] == (1, 2, 0.8, True)


def test_kept_equals_the_full_decision(cleaned):
    full = reviews.int_reviews_deduplicated(cleaned).filter("should_keep").select("id")
    kept = reviews.kept_reviews(cleaned).select("id")
    assert full.exceptAll(kept).isEmpty() and kept.exceptAll(full).isEmpty()


def test_mart(mart):
    rows = {r["id"]: r for r in mart.collect()}
    assert set(rows) == {1, 3, 4, 5, 9, 10}
    assert rows[1]["banque"] == "CIH Bank" and rows[1]["ville"] == "Casablanca"
    # 'excellent' contains 'lent', whose rule precedes 'accueil'.
    assert rows[1]["sentiment"] == "Positif" and rows[1]["topic"] == "Temps d'attente"
    assert rows[9]["date_avis"] == "Date inconnue" and rows[9]["sentiment"] == "Negatif" and float(rows[9]["note"]) == 0.0
    assert rows[10]["topic"] == "Expérience générale"


def test_fact_grain_and_fanout(mart):
    built = star.star_schema(mart, AS_OF)
    fact = {r["review_id"]: r for r in star.fact_reviews(built).collect()}
    assert set(fact) == {1, 3, 4, 5, 9, 10}
    assert all(r[k] > 0 for r in fact.values() for k in ("bank_key", "branch_key", "location_key", "sentiment_key", "topic_key"))
    assert (fact[9]["review_year"], fact[9]["review_month"], fact[9]["review_date"]) == (2025, 6, None)
    assert fact[9]["is_negative_rating"] == 1  # unrated counts as negative
    fan = {r["review_id"]: (r["branch_matches"], r["location_matches"], r["fact_rows"]) for r in star.fact_fanout(built).collect()}
    # The branch name exists in two cities, Casablanca has two addresses.
    assert fan[1] == (2, 2, 4) and fan[10] == (2, 1, 2) and fan[3] == (1, 2, 2)


def test_fanout_equals_the_join_it_counts(mart):
    """Brute force on the small fixture: the joins as specified, row by row."""
    built = star.star_schema(mart, AS_OF)
    joined = (
        built.mart.join(built.branch, (F.col("nom_agence") == F.col("branch_name")) & (F.col("banque") == F.col("bank_name")), "left")
        .drop("city").join(built.location, F.col("ville") == F.col("city"), "left")
    )
    want = {r["id"]: r["count"] for r in joined.groupBy("id").count().collect()}
    assert {r["review_id"]: r["fact_rows"] for r in star.fact_fanout(built).collect()} == want


def test_year_reports_reproduce_published_rows(spark):
    """One bank with everything in 2025, as in the published tables."""
    counted = spark.createDataFrame(
        [("A", 2025, 101420), ("B", 2025, 4172), ("B", 2018, 9)], "bank_name string, review_year int, fact_rows long"
    )
    grid = reports.report_bank_year(counted)
    rows = {(r["banque"], r["year"]): r for r in grid.collect()}
    assert len(rows) == 14
    assert rows["A", 2019]["rang_annee_banque"] == 2 and rows["A", 2025]["rang_annee_banque"] == 1
    assert rows["A", 2025]["moyenne_annuelle_banque"] == 14488.6 and rows["A", 2025]["pourcentage_annee"] == 100.0
    summary = {r["banque"]: r for r in reports.report_bank_summary(grid).collect()}
    a = summary["A"]
    assert (a["annees_actives"], a["meilleure_annee"], a["pire_annee"], a["ecart_max_min"]) == (1, 2025, 2019, 101420)
    assert (a["tendance_generale"], a["regularite"], a["rang_volume_total"]) == ("Croissante", "Variable", 1)
    pivot = {r["index"]: r for r in reports.report_bank_year_pivot(grid).collect()}
    assert pivot["TOTAL_TOUTES_BANQUES"]["TOTAL"] == 105592.0 and pivot["B"]["MOYENNE"] == 596.0


def test_checks(spark, small):
    assert checks.summary("id", checks.not_unique(small, "id")).first()["status"] == "pass"
    assert checks.not_unique(small, "ville").count() == 2
    assert checks.missing(small, "id").isEmpty()
    assert {r["banque"] for r in checks.not_accepted(small, "banque", ["CIH"]).collect()} == {"  "}
    assert checks.violates(small, F.col("id") <= 10).count() == 1
    ages = [("2025-01-01", "pass"), ("2025-01-03", "warn"), ("2025-01-09", "error")]
    assert [checks.freshness(small, "created_at", d).first()["status"] for d, _ in ages] == [s for _, s in ages]


@pytest.fixture(scope="module")
def built(spark):
    return Build(spark, "/root/testdata/sf0.001")


def test_one_kept_row_per_copy_group(built):
    groups = built.dedup.groupBy("content_hash", *reviews.EXACT_KEYS).agg(F.count_if("should_keep").alias("k"))
    assert groups.filter("k <> 1").isEmpty()


def test_strict_fact_keeps_the_grain(built):
    assert built.fact.count() == built.mart.count() == built.fact.select("review_id").distinct().count()


def test_distribution_shares_add_up(built):
    report = reports.report_topic_distribution(built.mart)
    total, reviews_ = report.agg(F.sum("pourcentage_total"), F.sum("nombre_avis")).first()
    assert abs(total - 100) < 0.05 and reviews_ == built.mart.count()
    assert len(report.columns) == 34


def test_year_totals_match_the_grid(built):
    grid = reports.report_bank_year(built.strict_years)
    assert grid.groupBy("banque").agg(F.sum("nombre_avis").alias("s"), F.first("total_avis_banque").alias("t")).filter("s <> t").isEmpty()


def test_archived_variant_agrees_on_clean_text(built):
    variant = archive.staging_variant(built.raw)
    assert variant.filter("avis_cleaned <> avis_normalized").isEmpty()
