"""The text rules as SQL functions of the session."""

from pyspark.sql import SparkSession

from branchvoice.functions import rules, text


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _contains_any(words: list[str]) -> str:
    return " OR ".join(f"contains(lower(s), {_quote(w)})" for w in words)


def function_bodies() -> dict[str, str]:
    """Name and parameters -> RETURN expression."""
    stars = " ".join(f"WHEN s RLIKE {_quote('(?s)' + p)} THEN {_quote(v)}" for p, v in rules.STAR_RULES)
    ago = " ".join(
        f"WHEN lower(s) RLIKE {_quote(p)} THEN " + (f"date_sub(as_of, {n})" if unit == "days" else f"add_months(as_of, -{n})")
        for p, unit, n in rules.RELATIVE_DATES
    )
    return {
        "clean_text(s STRING)": f"trim(regexp_replace(regexp_replace(lower(s), {_quote(text.URL)}, ''), "
        f"{_quote(text.DROPPED_CHARS)}, ' '))",
        "normalize_text(s STRING)": "trim(regexp_replace(regexp_replace(regexp_replace(clean_text(s), "
        f"{_quote('[.]{2,}')}, '.'), {_quote('!{2,}')}, '!'), {_quote('[?]{2,}')}, '?'))",
        "detect_language(s STRING)": f"CASE WHEN regexp_count(s, {_quote(text.ARABIC_CHAR)}) * 10 > length(s) * 3 THEN 'ar' "
        f"WHEN length(translate(s, '{rules.FRENCH_LETTERS}', '')) * 2 < length(s) THEN 'fr' ELSE 'mixed' END",
        "handle_missing_values(s STRING, d STRING)": "CASE WHEN s IS NULL OR trim(s) IN ('', 'nan', 'null') THEN d ELSE s END",
        "analyze_sentiment(s STRING)": f"CASE WHEN {_contains_any(rules.POSITIVE_WORDS)} THEN 'Positif' "
        f"WHEN {_contains_any(rules.NEGATIVE_WORDS)} THEN 'Negatif' {stars} ELSE 'Neutre' END",
        "format_date_dmy(s STRING, as_of DATE)": f"date_format(CASE "
        f"WHEN s RLIKE {_quote(rules.ISO_DATE)} THEN try_to_date(s, 'yyyy-MM-dd') "
        f"WHEN s RLIKE {_quote(rules.DMY_SLASH_DATE)} THEN try_to_date(s, 'd/M/yyyy') {ago} "
        f"ELSE try_to_date(regexp_extract(s, {_quote(rules.DMY_DASH_DATE)}, 0), 'd-M-yyyy') END, 'dd/MM/yyyy')",
    }


def register(spark: SparkSession, topics_view: str | None = None) -> None:
    """Create the functions; get_lda_topic needs a view with id and topic_name."""
    bodies = function_bodies()
    if topics_view:
        bodies["get_lda_topic(review_id BIGINT)"] = (
            f"(SELECT min(t.topic_name) FROM {topics_view} t WHERE t.id = review_id)"
        )
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
