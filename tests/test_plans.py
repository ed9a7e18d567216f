"""Plans of registered queries: no all-pairs joins, no Python rows, pruned scans."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from branchvoice.plans import archive
from registry.oracle import ORACLE
from registry.queries import QUERIES, Build

FOLDER = "/root/testdata/sf0.001"
# Values that depend on the generator of the fit; topic_model_checks and mart_lda_checks hold for any fit.
ROWS_ONLY = {"topic_assignments", "topic_names", "topic_sizes"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["bank_sentiment", "int_reviews_deduplicated", "mart_reviews_enriched", "fact_reviews", "fact_fanout", "reviews_clean",
     "banks_performance", "topic_analysis", "crawl_grid", "unseen_links", "report_bank_year", "report_topic_distribution", "stems"],
)
def test_no_all_pairs_and_no_python(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in text


def test_scan_is_pruned(spark):
    """The flagship reads three of five columns and neither load dates nor ratings."""
    text = plan(entry(spark))
    assert "ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>" in text
    assert "il y a un an" not in text


def test_every_query_has_sql_or_is_a_model():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


def test_fact_is_one_scan_with_broadcast_lookups(spark):
    text = plan(queries()["fact_reviews"](spark, FOLDER))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 5


def joins(text: str) -> int:
    return text.count("SortMergeJoin") + text.count("BroadcastHashJoin") + text.count("ShuffledHashJoin")


def test_yearly_reports_and_bank_metrics_do_not_join_topics(spark):
    assert joins(plan(queries()["report_bank_year"](spark, FOLDER))) == 0
    build = Build(spark, FOLDER)
    metrics = archive.review_scores(build.enriched)
    assert joins(plan(metrics)) == 0
    assert joins(plan(build.scored)) == 1


@pytest.mark.parametrize("name", ["tokens", "stopwords", "stems"])
def test_token_queries_read_once(spark, name):
    assert plan(queries()[name](spark, FOLDER)).count("FileScan parquet") == 1


def test_reviews_clean_reads_narrow_columns_for_its_statistics(spark):
    """Ratings and names only: the statistics never see a text."""
    build = Build(spark, FOLDER)
    normalized = archive.int_reviews_normalized(build.raw)
    stats = normalized.groupBy("banque_normalized", "ville_normalized").agg(F.count("*"), F.sum("note_numeric"))
    reads = [line for line in plan(stats).split("\n") if "FileScan" in line]
    assert reads and not any("avis_cleaned" in r.split("ReadSchema")[1] for r in reads)


def test_decimals_keep_their_types(spark):
    build = Build(spark, FOLDER)
    kinds = dict(build.mart.dtypes) | dict(build.topics.dtypes) | dict(build.scored.dtypes) | dict(build.fact.dtypes)
    assert kinds["note"] == "decimal(2,1)" and kinds["topic_probability"] == "decimal(4,3)" and kinds["composite_score"] == "decimal(5,3)"
