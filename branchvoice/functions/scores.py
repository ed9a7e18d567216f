"""Ratings, quality scores, bins and exact rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from branchvoice.functions import rules


def parse_rating(c: Column, decimal_comma: bool = False) -> Column:
    """Text like '4' or '4.0' (with `decimal_comma` also '4,0') as decimal(2,1); everything else 0.0."""
    c = F.translate(c, ",", ".") if decimal_comma else c
    return F.when(c.rlike(rules.RATING), c).otherwise("0").cast("decimal(2,1)")


def strip_rating(c: Column) -> Column:
    """Keep a valid rating text, else keep only its digits and dots; blank gives '0'."""
    return (
        F.when(c.isNull() | (F.trim(c) == ""), F.lit("0"))
        .when(c.rlike(rules.RATING), c)
        .otherwise(F.regexp_replace(c, "[^0-9.]", ""))
    )


def text_quality(size: Column, lang: Column) -> Column:
    known, chain = lang.isin("fr", "ar"), F
    for least, needs_language, score in rules.TEXT_QUALITY:
        chain = chain.when((size >= least) & known if needs_language else size >= least, score)
    return chain.otherwise(rules.LOW_QUALITY)


def length_bin(size: Column) -> Column:
    chain = F
    for most, label in rules.LENGTH_BINS:
        chain = chain.when(size <= most, label)
    return chain.otherwise(rules.LONGEST_BIN)


def rating_bin(note: Column) -> Column:
    return threshold_label(note, rules.RATING_BINS, rules.UNRATED)


def threshold_label(value: Column, levels, lowest: str) -> Column:
    chain = F
    for bound, label in levels:
        chain = chain.when(value >= bound, label)
    return chain.otherwise(lowest)


def ratio(num: Column, den: Column, digits: int) -> Column:
    """num / den of whole non-negative numbers, rounded half up without float error; 0 / 0 is NULL."""
    return whole_ratio(num, den, digits).cast("double") / 10**digits


def whole_ratio(num: Column, den: Column, digits: int) -> Column:
    """The same ratio as a whole number of units in its last digit."""
    num, den = num.cast("decimal(38,0)"), den.cast("decimal(38,0)")
    return F.when(den > 0, F.floor((num * (2 * 10**digits) + den) / (den * 2)))


def pct(num: Column, den: Column) -> Column:
    """Percentage with two decimals."""
    return ratio(num * 100, den, 2)


def mean(total: Column, rows: Column) -> Column:
    """Mean of exact decimals: both operands are exact, so the quotient is stable."""
    return total.cast("double") / rows
