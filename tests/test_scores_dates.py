from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from branchvoice.functions import dates, scores

AS_OF = "2025-06-30"


def test_parse_rating(apply):
    cases = {"5": "5.0", "4.0": "4.0", "5.9": "5.9", "3,4": "0.0", "6": "0.0", "": "0.0", "4\n": "0.0"}
    assert apply(scores.parse_rating, list(cases)) == [Decimal(v) for v in cases.values()]


def test_strip_rating(apply):
    cases = {None: "0", " ": "0", "4.5": "4.5", "3,4": "34", "note 4/5": "45", "abc": ""}
    assert apply(scores.strip_rating, list(cases)) == list(cases.values())


def test_format_date(apply):
    cases = {
        "2024-03-05": "05/03/2024",
        "5/3/2024": "05/03/2024",
        "31/13/2024": None,
        "2024-13-45": None,
        "1-2-2024": "01/02/2024",
        "le 1-2-2024": "01/02/2024",
        "il y a 3 jours": "29/06/2025",
        "Il Y A\n3 jours": "29/06/2025",
        "il y a une semaine": "23/06/2025",
        "il y a 2 mois": "30/05/2025",
        "il y a 2 ans": None,
        "hier": None,
        "": None,
        None: None,
    }
    assert apply(lambda c: dates.format_date_dmy(c, AS_OF), list(cases)) == list(cases.values())


def test_month_end_is_clamped(apply):
    assert apply(lambda c: dates.format_date_dmy(c, "2025-03-31"), ["il y a un mois"]) == ["28/02/2025"]


def test_basic_date_and_period(apply):
    got = apply(lambda c: dates.review_period(dates.parse_date_basic(c)), ["2024-03-05", "5/3/2023", "05-03-2022", "30/2/2024"])
    assert got == ["2024-03", "2023-03", None, None]


def test_unknown_date_takes_as_of(apply):
    year = apply(lambda c: dates.review_year(dates.review_date(c), AS_OF), ["Date inconnue", "05/03/2022"])
    month = apply(lambda c: dates.review_month(dates.review_date(c), AS_OF), ["Date inconnue", "05/03/2022"])
    assert (year, month) == ([2025, 2022], [6, 3])


@pytest.mark.parametrize("size,label,quality", [(4, "tres_court", 0.3), (5, "tres_court", 0.6), (10, "tres_court", 0.8),
                                                (20, "court", 1.0), (51, "moyen", 1.0), (151, "long", 1.0), (301, "tres_long", 1.0)])
def test_bins(spark, size, label, quality):
    row = spark.range(1).select(scores.length_bin(F.lit(size)), scores.text_quality(F.lit(size), F.lit("fr"))).first()
    assert tuple(row) == (label, quality)


def test_rates_agree_with_published_reports(spark):
    """Numbers of the report rows: counts -> rate."""
    rows = [(103, 459, 22.44), (151, 459, 32.9), (954, 3585, 26.61), (1240, 3585, 34.59), (3585, 4260, 84.15), (30, 138, 21.74)]
    df = spark.createDataFrame(rows, "n long, d long, want double")
    assert df.filter(scores.pct(F.col("n"), F.col("d")) != F.col("want")).isEmpty()
    assert spark.range(1).select(scores.ratio(F.lit(101420), F.lit(7), 1)).first()[0] == 14488.6


def test_ratio_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(41, 4000, 1.03), (1, 32, 3.13), (0, 5, 0.0)], "n long, d long, want double")
    assert df.filter(scores.pct(F.col("n"), F.col("d")) != F.col("want")).isEmpty()
