"""Raw reviews derived from a table of documents.

A document stands for a branch page and every line of its whole text for one review.
Bank, city, branch and address hang on the page; about a third of all pages belong to
one bank. The same derivation is written in SQL in registry/oracle.py.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchvoice.functions import rules
from branchvoice.sources.crawl import flatten_reviews

CITIES = [
    "Casablanca", "Rabat", "Marrakech", "Fès", "Tanger", "Agadir", "Oujda", "Meknès",
    "Tétouan", "Kenitra", "Safi", "Settat", "Nador", "casa", "Marrakesh", None,
]
BRANCHES = ["Agence Centre", "Agence Mall", "Agence Aéroport", "Agence Campus", "Agence", None, "nan"]
NOTES = ["5", "4.0", "3,4", "2", "1.5", None, "", "5.9", "abc"]
PHRASES = [
    "",
    "Très bon service. ",
    "Mauvais accueil, attente!! ",
    "خدمة ممتازة وسريعة جدا في هذه الوكالة والموظفون محترمون ",
    "https://x.example/a?b=1 ",
    "Note 5 étoiles ",
    "Guichet fermé, compte et carte ",
    "Parking proche... prix?? ",
]
DATES = [
    "2024-03-05", "5/3/2024", "05/03/2023", "31/13/2024", "05-03-2022", "il y a 3 jours",
    "il y a une semaine", "il y a 2 mois", "il y a un an", "", None, "hier",
]
DIRTY_BANKS = ["  attijariwafa  ", None, "   "]
LOADED_AT = 1735689600  # 2025-01-01 00:00 UTC


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


# An array has fewer than 2^31 elements, so lines of two texts never share an id; a doc_id of
# 2^32 or more fails the job instead of wrapping round.
LINES = 1 << 31


def line_id(doc_id: Column, pos: Column | int) -> Column:
    return doc_id * LINES + pos + 1


def branch_pages(documents: DataFrame) -> DataFrame:
    """One branch page per document with the array of its reviews."""
    n, slot = F.col("n_chars"), (F.col("n_chars") % 20).cast("int")
    banks = F.array(*[F.lit(b) for b in rules.CRAWLED_BANKS])
    return documents.select(
        "doc_id",
        F.when(slot <= 5, rules.CRAWLED_BANKS[0])
        .when(slot <= 18, F.get(banks, slot - 5))
        .otherwise(_pick(DIRTY_BANKS, F.col("doc_id")))
        .alias("banque"),
        _pick(CITIES, F.floor(n / 20)).alias("ville"),
        _pick(BRANCHES, F.floor(n / 7)).alias("nom_agence"),
        F.when(n % 13 == 0, "")
        .otherwise(F.concat((n % 5).cast("string"), F.lit(" rue "), (n % 11).cast("string")))
        .alias("localisation"),
        F.split("text", "\n", -1).alias("reviews"),
    )


def raw_reviews(documents: DataFrame) -> DataFrame:
    """The raw review table: id, seven text columns, created_at."""
    lines = flatten_reviews(branch_pages(documents))
    place = F.col("doc_id") + F.col("pos")
    return lines.select(
        line_id(F.col("doc_id"), F.col("pos")).alias("id"),
        "banque",
        "ville",
        "nom_agence",
        "localisation",
        _pick(NOTES, place).alias("note"),
        F.concat(_pick(PHRASES, F.length("avis")), F.col("avis")).alias("avis"),
        _pick(DATES, place).alias("date_avis"),
        F.timestamp_seconds(F.lit(LOADED_AT) + (F.col("doc_id") % 50) * 60).alias("created_at"),
    )
