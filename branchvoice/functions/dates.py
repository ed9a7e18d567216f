"""Dates written as text. Every clock read is the as_of argument ('YYYY-MM-DD')."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from branchvoice.functions import rules

AGO = r"il y a (\d{1,4}|une?) (jour|semaine|mois|an)"
UNKNOWN_DATE = rules.UNKNOWN_DATE


def as_date(as_of: str) -> Column:
    return F.to_date(F.lit(as_of))


def parse_date_basic(c: Column) -> Column:
    """ISO or D/M/Y text as a date; NULL for other text and impossible dates."""
    return F.when(c.rlike(rules.ISO_DATE), F.try_to_date(c, "yyyy-MM-dd")).when(
        c.rlike(rules.DMY_SLASH_DATE), F.try_to_date(c, "d/M/yyyy")
    )


def format_date_dmy(c: Column, as_of: str, exact_relative: bool = False) -> Column:
    """ISO, D/M/Y, relative French and D-M-Y text as DD/MM/YYYY, else NULL.

    Relative dates go back one day, one week or one month, whatever their number; with
    `exact_relative` as many days, weeks, months or years as they say where they say it.
    """
    now, low = as_date(as_of), F.lower(c)
    found = parse_date_basic(c)
    if exact_relative:
        number, unit = (F.regexp_extract(low, AGO, k) for k in (1, 2))
        n = F.when(number.startswith("un"), 1).otherwise(number.try_cast("int"))
        found = (
            found.when(unit == "jour", F.date_sub(now, n))
            .when(unit == "semaine", F.date_sub(now, n * 7))
            .when(unit == "mois", F.add_months(now, -n))
            .when(unit == "an", F.add_months(now, n * -12))
        )
    for pattern, unit, back in rules.RELATIVE_DATES:
        found = found.when(low.rlike(pattern), F.date_sub(now, back) if unit == "days" else F.add_months(now, -back))
    found = found.otherwise(F.try_to_date(F.regexp_extract(c, rules.DMY_DASH_DATE, 0), "d-M-yyyy"))
    return F.date_format(found, "dd/MM/yyyy")


def review_date(dmy: Column) -> Column:
    """Date behind a DD/MM/YYYY label; NULL for the unknown-date label."""
    return F.when(dmy.rlike(rules.DMY_SLASH_DATE), F.try_to_date(dmy, "d/M/yyyy"))


def review_year(date: Column, as_of: str) -> Column:
    return F.year(F.coalesce(date, as_date(as_of)))


def review_month(date: Column, as_of: str) -> Column:
    return F.month(F.coalesce(date, as_date(as_of)))


def review_period(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
