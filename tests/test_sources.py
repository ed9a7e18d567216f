import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from branchvoice.operators import ranking
from branchvoice.sources import crawl, csv_scan, tables

HEADER = "Banque;Ville;Nom Agence;Localisation;Note;Avis;Date Avis"
BODY = 'CIH;Fès;Agence;1 rue;5;"Très bon; ""vraiment""\nmerci";hier\n;nan;A;;NULL;ok ok;\n'


@pytest.mark.parametrize("encoding,mark", [("utf-8", "﻿"), ("utf-8", ""), ("latin-1", "")])
def test_csv_scan(spark, tmp_path, encoding, mark):
    path = tmp_path / "r.csv"
    path.write_bytes((mark + HEADER + "\n" + BODY).encode(encoding))
    rows = tables.as_raw_strings(tables.read_reviews_csv(spark, str(path))).collect()
    assert rows[0]["ville"] == "Fès" and rows[0]["avis"] == 'Très bon; "vraiment"\nmerci'
    assert rows[1].asDict() == {"banque": None, "ville": None, "nom_agence": "A", "localisation": None,
                                "note": None, "avis": "ok ok", "date_avis": None}


def test_every_file_is_decoded_by_its_own_bytes(spark, tmp_path):
    """A Latin-1 file and one with U+FFFD in valid UTF-8 leave their neighbours alone."""
    line = "CIH;Fès;A;B;5;{};hier\n"
    for name, word, encoding in (("a b", "é", "utf-8"), ("latin", "è", "latin-1"), ("marked", "é\ufffd", "utf-8")):
        (tmp_path / f"{name}.csv").write_bytes((HEADER + "\n" + line.format(word)).encode(encoding))
    rows = tables.as_raw_strings(tables.read_reviews_csv(spark, str(tmp_path))).collect()
    assert sorted(r["avis"] for r in rows) == ["è", "é", "é\ufffd"] and {r["ville"] for r in rows} == {"Fès"}


def csv_field(draw, stray: bool) -> str:
    """A field as written by many hands: plain, quoted over several lines, or with quotes that open nothing."""
    kind = draw.random()
    if kind < 0.4:
        return draw.choice(["a", "", "bé", "x y", " z", "nan", " "])
    if kind < 0.9:
        return '"' + "".join(draw.choice(["a", ";", "\n", '""', "é", " ", "\n\n", "\r\n" if stray else "b"]) for _ in range(draw.randint(0, 8))) + '"'
    return draw.choice(['5" tv', 'a"b"c', "it's"]) if stray else "q"


def csv_rows(df):
    return Counter(tuple(r) for r in df.select(*tables.CSV_COLUMNS, F.col("_corrupt_record").isNull()).collect())


@pytest.mark.parametrize("seed", range(4))
def test_one_file_is_cut_by_many_tasks(spark, tmp_path, seed):
    """Splits of a few bytes end inside quotes, records, even headers' lines: the rows are those of one task per file."""
    draw = random.Random(seed)
    by_encoding = {"UTF-8": [], "ISO-8859-1": []}
    for k in range(draw.randint(1, 3)):
        end = draw.choice(["\n", "\n", "\r\n"])
        lines = [";".join(csv_field(draw, seed % 2 == 1) for _ in range(7 if draw.random() < 0.95 else draw.randint(1, 9))) for _ in range(draw.randint(1, 150))]
        body, encoding = end.join([HEADER, *lines]) + draw.choice([end, ""]), draw.choice(list(by_encoding))
        path = tmp_path / f"f{k}.csv"
        path.write_bytes(body.encode(encoding))
        try:
            path.read_bytes().decode()
            encoding = "UTF-8"
        except UnicodeDecodeError:
            pass
        by_encoding[encoding].append(str(path))
    want = sum((csv_rows(tables._csv(spark, files, e)) for e, files in by_encoding.items() if files), Counter())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", draw.choice(["100", "300"]))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scanned = tables.read_reviews_csv(spark, str(tmp_path))
        assert scanned.rdd.getNumPartitions() > len(sum(by_encoding.values(), []))
        assert csv_rows(scanned) == want
        loaded = tables.load_raw(tables.as_raw_strings(scanned), str(tmp_path / "raw"), "2025-01-01 00:00:00")
        assert sorted(r["id"] for r in loaded.collect()) == list(range(1, sum(n for r, n in want.items() if r[-1]) + 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_quote_states():
    for line, inside, open_ in [(b"a;b", False, False), (b'a;"b', False, True), (b'a;"b""', False, True), (b'a;"b"', False, False), (b'5" tv;x', False, False),
                                (b'"a"b"c;"d', False, True), (b'x";y', True, False), (b"x;y", True, True), (b'x"";y', True, True), (b'""', False, False), (b'"""', False, True)]:
        assert csv_scan.open_after(line, inside) == open_, line


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n")
    (tmp_path / "b.csv").write_text("Banque;Ville\n")
    with pytest.raises(ValueError, match="headers"):
        tables.read_reviews_csv(spark, str(tmp_path))


def test_missing_column_is_refused(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("Banque;Ville\nCIH;Fès\n")
    with pytest.raises(ValueError, match="Avis"):
        tables.as_raw_strings(tables.read_reviews_csv(spark, str(path)))


def test_bad_rows_are_skipped_and_counted(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(HEADER + "\na;b;c;d;5;bon;hier\na;b\n")
    df = tables.read_reviews_csv(spark, str(path)).cache()
    assert tuple(tables.skipped_rows(df).first()) == (1, 1)
    assert tuple(tables.skipped_rows(tables.read_reviews_csv(spark, str(path))).first()) == (1, 1)
    assert tables.as_raw_strings(df).count() == 1


def test_round_trip(spark, tmp_path):
    cols = tables.REVIEW_COLUMNS
    row = ("a", " b ", "c;d", 'e"f', None, "x\ny", "z")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols))
    tables.write_reviews_csv(df, str(tmp_path / "marked"), mark=True)
    part = next(p for p in (tmp_path / "marked").iterdir() if p.suffix == ".csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfBanque")
    assert tuple(tables.as_raw_strings(tables.read_reviews_csv(spark, str(tmp_path / "marked"))).first()) == row
    tables.write_reviews_csv(df, str(tmp_path / "out"))
    assert tuple(tables.as_raw_strings(tables.read_reviews_csv(spark, str(tmp_path / "out"))).first()) == row


def test_full_refresh_restarts_ids(spark, tmp_path):
    df = spark.range(10).select(*[F.col("id").cast("string").alias(c) for c in tables.REVIEW_COLUMNS])
    for rows in (10, 4):
        loaded = tables.load_raw(df.limit(rows), str(tmp_path / "raw"), "2025-01-01 00:00:00")
        assert sorted(r["id"] for r in loaded.collect()) == list(range(1, rows + 1))


def test_texts_are_written_once_with_their_ids(spark, tmp_path):
    """Without a shuffle below, numbering stores row counts only; with one, the table is written first."""
    df = spark.range(0, 90, 1, 5).select(*[F.col("id").cast("string").alias(c) for c in tables.REVIEW_COLUMNS])
    staged = lambda frame: {p.split("/")[-2].split("-")[0] for p in ranking.number_as_read(frame, "id").inputFiles()}
    assert staged(df) == {"split"} and staged(df.repartition(3)) == {"positions"}
    for frame in (df, df.repartition(3), df.filter("avis % 7 = 0")):
        loaded = tables.load_raw(frame, str(tmp_path / "raw"), "2025-01-01 00:00:00")
        assert sorted(r["id"] for r in loaded.collect()) == list(range(1, frame.count() + 1))


def rows_read(df):
    """Rows that the scans of a query handed on, after folders and row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves, total = plan.collectLeaves(), 0
    for k in range(leaves.size()):
        metric = leaves.apply(k).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_look_ups_open_few_row_groups(spark, tmp_path):
    df = spark.range(200_000).select(
        F.xxhash64("id").alias("review_id"), (2024 + F.col("id") % 2).cast("int").alias("review_year"),
        F.floor(F.sqrt(F.col("id"))).cast("long").alias("bank_key"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4000)).alias("location_key"))
    tables.write_fact(df, str(tmp_path / "fact"), row_group=64 << 10)
    groups = sum(pq.ParquetFile(p).num_row_groups for p in (tmp_path / "fact").rglob("*.parquet"))
    assert groups > 20
    one = df.filter("bank_key = 300").first()
    full = rows_read(spark.read.parquet(str(tmp_path / "fact")).select("review_id"))
    for keys in ({"bank_key": 300}, {"review_year": one["review_year"], "bank_key": 300, "location_key": one["location_key"]}, {"review_id": one["review_id"]}):
        found = tables.find_facts(spark, str(tmp_path / "fact"), **keys)
        want = df.filter(" AND ".join(f"{k} = {v}" for k, v in keys.items()))
        assert sorted(r["review_id"] for r in found.collect()) == sorted(r["review_id"] for r in want.collect())
        assert rows_read(found) < full / 8, keys
    with pytest.raises(ValueError, match="branch"):
        tables.find_facts(spark, str(tmp_path / "fact"), branch=1)


def test_fact_file_layout(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id").alias("review_id"), F.when(F.col("id") < 900, 2025).otherwise(2024).alias("review_year"),
        (F.col("id") % 9).alias("bank_key"), (F.col("id") % 4).alias("location_key"))
    tables.write_fact(df, str(tmp_path / "fact"))
    back = spark.read.parquet(str(tmp_path / "fact"))
    plan = back.filter("review_year = 2024")._jdf.queryExecution().executedPlan().toString()
    written = df.hint("rebalance", F.col("review_year"))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in written
    assert back.count() == 1000 and "PartitionFilters: [isnotnull(review_year" in plan


def test_upsert_takes_the_new_row(spark):
    schema = "id long, topic_id int, topic_name string, topic_probability double"
    old = spark.createDataFrame([(1, 1, "a", 0.1), (2, 1, "b", 0.2)], schema)
    new = spark.createDataFrame([(2, 5, "c", 0.9), (3, 6, "d", 0.3)], schema)
    assert {r["id"]: r["topic_name"] for r in tables.upsert_topics(old, new).collect()} == {1: "a", 2: "c", 3: "d"}


def test_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    schema, path = "id long, topic_id int, topic_name string, topic_probability double", str(tmp_path / "topics")
    tables.write_topics(spark.range(500).select("id", F.lit(1).alias("topic_id"), F.lit("a").alias("topic_name"), F.lit(0.1).alias("topic_probability")), path, buckets=16)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "topics").rglob("*.parquet")}
    before = files()
    new = spark.createDataFrame([(7, 5, "c", 0.9), (9000, 6, "d", 0.3)], schema)
    touched = tables.upsert_topic_table(spark, path, new, buckets=16)
    after = files()
    folders = lambda paths: {p.parent.name for p in paths}
    changed = folders(set(after.items()) ^ set(before.items()) and [p for p, _ in set(after.items()) ^ set(before.items())])
    assert 1 <= touched <= 2 and len(changed) == touched
    assert all(after[p] == t for p, t in before.items() if p.parent.name not in changed)
    got = {r["id"]: r["topic_name"] for r in tables.read_topics(spark, path).collect()}
    assert len(got) == 501 and got[7] == "c" and got[9000] == "d" and got[8] == "a"
    assert tables.upsert_topic_table(spark, path, new.limit(0), buckets=16) == 0 and files() == after


def test_crawl_rules(spark):
    links = spark.createDataFrame([(1, "u"), (2, "u"), (3, "v"), (4, "w")], "n long, url string")
    seen = spark.createDataFrame([("w",)], "url string")
    assert {(r["n"], r["url"]) for r in crawl.unseen_links(links, seen, "n").collect()} == {(1, "u"), (3, "v")}
    page = spark.createDataFrame([(None, " ", "4")], "nom string, localisation string, note string")
    assert tuple(crawl.fill_page_defaults(page).first()) == ("Nom inconnu", "Localisation inconnue", "4")
    banks = spark.createDataFrame([("A",), ("B",)], "banque string")
    assert crawl.crawl_grid(banks).count() == 64
    flat = crawl.flatten_reviews(spark.createDataFrame([(1, ["x", "y"])], "p long, reviews array<string>"))
    assert [(r["p"], r["pos"], r["avis"]) for r in flat.collect()] == [(1, 0, "x"), (1, 1, "y")]


def test_table_order(spark, tmp_path):
    from branchvoice.operators.storage import as_table

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id")).repartition(6)
    files = as_table(df, str(tmp_path / "t"), ["id"]).groupBy(F.input_file_name().alias("f")).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    # Sorted files do not overlap.
    assert files.filter("hi - lo + 1 <> n").isEmpty()
