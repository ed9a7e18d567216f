"""Nothing dropped from the reports, and shared staging."""

import uuid

import pytest
from pyspark.sql import functions as F

from branchvoice.operators import storage
from branchvoice.operators.joins import lookup_join, lookup_key
from branchvoice.plans import reports


def test_a_bank_outside_the_years_has_zeros(spark):
    rows = spark.createDataFrame([("A", 2020, 3), ("A", 2021, 1), ("B", 2018, 4)], "bank_name string, review_year int, fact_rows long")
    grid = reports.report_bank_year(rows)
    got = {(r["banque"], r["year"]): r["nombre_avis"] for r in grid.collect()}
    assert len(got) == 14 and got["A", 2020] == 3 and all(got["B", y] == 0 for y in range(2019, 2026))
    assert grid.filter("banque = 'B' AND pourcentage_annee IS NOT NULL").isEmpty()
    summary = {r["banque"]: r for r in reports.report_bank_summary(grid).collect()}
    assert summary["B"]["total_avis_2019_2025"] == 0 and summary["B"]["annees_actives"] == 0 and summary["B"]["regularite"] == "Régulière"
    assert summary["A"]["regularite"] == "Variable"


def test_groups_of_one_stay_and_the_deviation_is_exact(spark):
    rows = [("A", "T", "p", 4.0), ("A", "T", "n", 5.0), ("A", "U", "p", 3.5)]
    mart = spark.createDataFrame([(b, t, s, n, "txt", "c") for b, t, s, n in rows], "banque string, topic string, sentiment string, note double, avis string, ville string")
    mart = mart.withColumn("note", F.col("note").cast("decimal(2,1)"))
    got = {r["topic_name"]: r for r in reports.report_bank_topic(mart).collect()}
    assert got["U"]["nombre_avis"] == 1 and got["U"]["note_ecart_type"] is None and got["T"]["note_ecart_type"] == 0.71


def test_a_large_dimension_is_joined_without_copies(spark):
    facts, dim = spark.range(100).withColumn("k", F.col("id") % 3), spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = lookup_join(facts, dim, ["k"], max_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Generate" not in plan and joined.filter("v = 'x'").count() == 100


def jobs(spark, run):
    """Number of jobs that a call starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup(uuid.uuid4().hex, "")


def test_a_measured_dimension_costs_the_join_no_job(spark):
    dim = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    stage = storage.measured(dim)
    facts = spark.range(100).withColumn("k", F.col("id") % 50)
    assert storage.bytes_of(stage) == storage.bytes_of(dim) > 40 * 32
    assert jobs(spark, lambda: lookup_join(facts, stage, ["k"])) == 0 < jobs(spark, lambda: lookup_join(facts, dim, ["k"]))
    assert jobs(spark, lambda: lookup_key(facts, stage, ["k"], "v")) == 0
    assert storage.bytes_of(storage.measured(dim.limit(0))) == 0


def cube_mart(spark, names):
    return spark.range(names).select(
        "id", F.concat(F.lit("bank "), F.format_string("%06d", "id")).alias("banque"), F.lit("Service client").alias("topic"), F.lit("Fès").alias("ville"),
        F.lit("Positif").alias("sentiment"), F.lit("4.0").cast("decimal(2,1)").alias("note"), F.lit("ok").alias("avis"),
        F.concat(F.lit("branch "), (F.col("id") % 3000).cast("string")).alias("nom_agence"))


def test_more_names_than_a_cell_holds_go_on_in_further_rows(spark):
    rows = reports.report_topic_detail(cube_mart(spark, 250), most=100).collect()
    listed = sorted((r["banques_mentionnant"].split(", ") for r in rows))
    assert sorted(map(len, listed)) == [50, 100, 100] and sum(listed, []) == [f"bank {i:06d}" for i in range(250)]
    assert [r["total_avis"] for r in rows if r["total_avis"]] == [250]
    many = reports.name_lists(reports.topic_cube(cube_mart(spark, 120_000)), "topic_name", "banque", "names")
    assert many.select(F.sum(F.size(F.split("names", ", "))), F.count("*"), F.max(F.size(F.split("names", ", ")))).first()[:] == (120_000, 12, 10_000)


def test_sketches_are_merged_within_their_band(spark):
    cube = reports.topic_cube(cube_mart(spark, 30_000).withColumn("banque", F.col("id") % 2), ("nom_agence",))
    for keys, exact in ((("topic_name",), 3000), (("banque",), 1500), (("banque", "ville"), 1500)):
        assert all(abs(r["nom_agence_distinct"] - exact) <= reports.SKETCH_BAND * exact for r in reports.distinct_counts(cube, *keys).collect())
    assert "avis" not in reports.distinct_counts(cube, "banque")._jdf.queryExecution().executedPlan().toString()


def test_the_total_row_takes_one_scan(spark, tmp_path):
    rows = spark.createDataFrame([("A", 2020, 3), ("A", 2021, 1), (None, 2020, 4)], "banque string, year int, nombre_avis long")
    rows.write.parquet(str(tmp_path / "years"))
    pivot = reports.report_bank_year_pivot(spark.read.parquet(str(tmp_path / "years")))
    plan = pivot._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = {r["index"]: (r["2020"], r["2021"], r["TOTAL"]) for r in pivot.select("index", "2020", "2021", F.coalesce("2020", F.lit(0)).alias("TOTAL")).collect()}
    assert got["A"][:2] == (3.0, 1.0) and got[None][0] == 4.0 and got[reports.TOTAL_LABEL][:2] == (7.0, 1.0)


def test_stages_are_dropped_and_local_folders_refused(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Cluster:
        """Only what shared_folder asks a session for."""

        conf = type("Conf", (), {"get": staticmethod(lambda key, *rest: None if key == "spark.checkpoint.dir" else warehouse)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})

    for warehouse in ("file:/tmp/w", "/tmp/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.shared_folder(Cluster)
    warehouse = "hdfs://store/w"
    assert storage.shared_folder(Cluster) == "hdfs://store/w/_stages"
