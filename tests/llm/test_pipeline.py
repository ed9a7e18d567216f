import corpus_pipeline
from branchvoice.llm import minhash

SF = "/root/testdata/sf0.001"


def test_stages_and_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = set(texts)
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        docs = function(spark, docs, SF)
        if k < 4:
            assert docs.columns == columns, name
        rows = docs.collect()
        assert rows and all(r.text == texts[r.doc_id] for r in rows), name
        assert {r.doc_id for r in rows} <= seen
        seen = {r.doc_id for r in rows}
        if name == "near_dedup":
            assert all(r.kept for r in minhash.near_duplicates(docs, shingle=5).collect())
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(i in r.text for r in rows for i in items)
        docs = spark.createDataFrame(rows, docs.schema)
    assert {r.shard for r in rows} == set(range(16))


def test_odd_documents_pass_all_stages(spark, odd, empty):
    for docs in (odd, empty):
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, SF)
        docs.collect()


def test_run_is_the_chain(spark):
    assert corpus_pipeline.run(spark, SF).columns[-3:] == ["size", "shard", "slot"] and corpus_pipeline.ORACLE_SQL is None
