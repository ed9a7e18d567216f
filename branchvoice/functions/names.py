"""Name normalisation and the attributes hung on dimension rows."""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from branchvoice.functions import rules
from branchvoice.functions.text import first_match


def _lookup(c: Column, pairs, default=None) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    found = F.try_element_at(table, c)
    return found if default is None else F.coalesce(found, default)


def _member(c: Column, table, default: str) -> Column:
    return _lookup(c, [(n, value) for names, value in table for n in names], F.lit(default))


def normalize_bank(c: Column) -> Column:
    return first_match(F.lower(c), rules.BANK_NAMES, c)


def normalize_city(c: Column) -> Column:
    return first_match(F.lower(c), rules.CITY_NAMES, c)


def bank_type(name: Column) -> Column:
    return _lookup(name, [(n, t) for n, t, _ in rules.BANK_ATTRIBUTES], F.lit(rules.OTHER_BANK_TYPE))


def founded_year(name: Column) -> Column:
    return _lookup(name, [(n, y) for n, _, y in rules.BANK_ATTRIBUTES])


def branch_type(name: Column) -> Column:
    return first_match(F.lower(name), rules.BRANCH_TYPES, F.lit(rules.STANDARD_BRANCH_TYPE))


def branch_services(name: Column) -> Column:
    return first_match(F.lower(name), rules.BRANCH_SERVICES, F.lit(rules.STANDARD_SERVICES))


def city_region(city: Column) -> Column:
    return _member(city, rules.CITY_REGIONS, rules.OTHER_REGION)


def city_centre(city: Column) -> Column:
    return _lookup(city, rules.CITY_CENTRES)


def city_size(city: Column) -> Column:
    return _member(city, rules.CITY_SIZES, rules.SMALL_CITY)


def topic_category(name: Column) -> Column:
    return first_match(name, rules.TOPIC_CATEGORIES, F.lit(rules.OTHER_TOPIC_CATEGORY))


def topic_description(name: Column) -> Column:
    return _lookup(name, rules.TOPIC_DESCRIPTIONS, name)


def keyword_topic(text: Column, fold: bool = False) -> Column:
    """Topic label of the first keyword found in a term or text, NULL without one; `fold` ignores accents."""
    table = rules.TOPIC_KEYWORDS
    if fold:
        text = F.translate(text, *rules.FOLDED)
        bare = str.maketrans(*rules.FOLDED)
        table = [([n.translate(bare) for n in needles], label) for needles, label in table]
    return first_match(text, table, F.lit(None).cast("string"))
