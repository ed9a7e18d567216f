"""Data rules of the review crawl: search grid, seen links, page defaults, flattening."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchvoice.functions import rules


def crawl_grid(banks: DataFrame, cities: list[str] = rules.CRAWLED_CITIES) -> DataFrame:
    """Every bank once per searched city; the city list is fixed, so rows just explode."""
    return banks.select("banque", F.explode(F.array(*[F.lit(c) for c in cities])).alias("ville"))


def unseen_links(links: DataFrame, seen: DataFrame, order: str) -> DataFrame:
    """First occurrence of each url that was not seen before.

    The first row is picked by an aggregate, so repeats collapse before the shuffle.
    """
    rest = [c for c in links.columns if c not in ("url", order)]
    first = links.groupBy("url").agg(
        F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in rest]
    )
    return first.join(seen.select("url").distinct(), "url", "left_anti")


def fill_page_defaults(df: DataFrame) -> DataFrame:
    """Default name, address and rating of branch pages that lack them."""
    blank = {c: F.nullif(F.trim(c), F.lit("")) for c in rules.PAGE_DEFAULTS}
    return df.withColumns(blank).na.fill(rules.PAGE_DEFAULTS)


def flatten_reviews(pages: DataFrame, reviews: str = "reviews") -> DataFrame:
    """One row per review of a branch page, with its place in the page."""
    rest = [c for c in pages.columns if c != reviews]
    return pages.select(*rest, F.posexplode(reviews).alias("pos", "avis"))
