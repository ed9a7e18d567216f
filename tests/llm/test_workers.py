"""Operators called as library functions by a driver whose path the workers lack."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import public_tokenizers
from branchvoice.llm import decontamination, language, lexical, minhash, mixing, packing, secret_scan, sharding, substrings, token_counts, token_files, vector_codes, vectors
docs = spark.createDataFrame([(i, "the words of a text number %d and some more of them to fill it" % (i % 3), "en", "s") for i in range(9)], "doc_id long, text string, lang string, source string")
items = spark.createDataFrame([(1, "words of a text number")], "item_id long, text string")
rows = spark.createDataFrame([(i, [float(i % 3), 1.0] * 8, 0) for i in range(20)], "vec_id long, embedding array<double>, label int")
path = public_tokenizers.path
manifest = token_files.write_tokens(docs, path("byte_bpe_50k.json"), {folder!r} + "/tokens")
results = [
    secret_scan.secrets(docs), token_counts.token_counts(docs, path("word_bpe_49k.json"), {folder!r} + "/cache"), mixing.mix(docs), language.identified(docs),
    token_files.read_tokens(spark, {folder!r} + "/tokens", manifest), substrings.without_repeats(docs), vectors.near_vectors(rows),
    decontamination.contaminated(docs, items), minhash.near_duplicates(docs), lexical.search(docs, items), vector_codes.coded_vectors(rows),
    packing.packed(docs, path("byte_bpe_50k.json")), sharding.sharded(docs),
]
print("rows", [r.count() for r in results])
from branchvoice.sources import tables
open({folder!r} + "/r.csv", "w").write("Banque;Ville;Nom Agence;Localisation;Note;Avis;Date Avis\\na;b;c;d;5;e;f\\n")
print("csv", tables.read_reviews_csv(spark, {folder!r} + "/r.csv").count())
"""


def test_the_package_reaches_the_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=str(ROOT), folder=str(tmp_path / "shared"))
    (tmp_path / "shared").mkdir()
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    assert "rows [9, 9, 9, 9, 9, 9, 20, 9, 9, 9, 20, 9, 9]" in run.stdout and "csv 1" in run.stdout, run.stdout
