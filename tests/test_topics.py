import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from branchvoice.functions import dates, sql, text
from branchvoice.plans import topics
from registry.queries import AS_OF, QUERIES, Build


@pytest.fixture(scope="module")
def corpus(spark):
    return Build(spark, "/root/testdata/sf0.001").corpus


@pytest.fixture(scope="module")
def assigned(corpus):
    return topics.review_topics(corpus).cache()


def test_invariants(assigned, corpus):
    assert assigned.columns == ["id", "topic_id", "topic_name", "topic_probability"]
    assert assigned.count() == assigned.select("id").distinct().count() > 0
    assert assigned.filter("topic_id not between 0 and 7 or topic_probability <= 0 or topic_probability > 1").isEmpty()
    assert assigned.join(corpus, "id", "left_anti").isEmpty()
    sizes = topics.topic_sizes(assigned.join(corpus.select("id", "langue"), "id"))
    assert sizes.agg(F.sum("n")).first()[0] == assigned.count()


def test_same_seed_same_topics(assigned, corpus):
    again = topics.review_topics(corpus)
    assert again.exceptAll(assigned).isEmpty()


def test_size_gates(spark):
    few = spark.createDataFrame([(i, "accueil rapide guichet", "fr", "b", "v") for i in range(19)],
                                "id long, avis string, langue string, banque string, ville string")
    assert topics.eligible_languages(few).isEmpty()
    assert topics.review_topics(few).isEmpty()


def test_vocabulary_bounds(spark):
    docs = spark.createDataFrame([(i, ["tout", "seul"] if i == 0 else ["tout", "deux"][: 1 + i % 2]) for i in range(10)],
                                 "id long, words array<string>")
    got = {r["term"]: (r["documents"], r["occurrences"]) for r in topics.vocabulary(docs, 10).collect()}
    # 'tout' is in every document, 'seul' in one only.
    assert got == {"deux": (5, 5), "tout deux": (5, 5)}


def test_topic_names(spark):
    terms = spark.createDataFrame(
        [(0, 0, "zz"), (0, 1, "frais bancair"), (0, 2, "attent"), (1, 0, "aa"), (1, 1, "bb"), (1, 2, "cc"), (1, 3, "dd")],
        "topic_id int, place int, term string")
    fr = {r["topic_id"]: r["topic_name"] for r in topics.name_topics(terms, "fr").collect()}
    assert fr == {0: "Tarifs", 1: "Topic 2: aa, bb, cc"}
    assert topics.name_topics(terms, "ar").filter("topic_id = 1").first()["topic_name"] == "موضوع 2: aa, bb, cc"


def test_sql_functions_agree_with_columns(spark, corpus):
    sql.register(spark)
    corpus.select("avis").createOrReplaceTempView("texts")
    both = spark.sql(f"SELECT avis, clean_text(avis) c, detect_language(avis) l, analyze_sentiment(avis) s, "
                     f"format_date_dmy(avis, DATE'{AS_OF}') d FROM texts")
    a = F.col("avis")
    assert both.filter((F.col("c") != text.clean_text(a)) | (F.col("l") != text.detect_language(a))
                       | (F.col("s") != text.analyze_sentiment(a))).isEmpty()
    dates_ = Build(spark, "/root/testdata/sf0.001").raw.select("date_avis").distinct()
    dates_.createOrReplaceTempView("raw_dates")
    dated = spark.sql(f"SELECT date_avis, format_date_dmy(date_avis, DATE'{AS_OF}') d FROM raw_dates")
    assert dated.filter(~F.col("d").eqNullSafe(dates.format_date_dmy(F.col("date_avis"), AS_OF))).isEmpty()


def test_french_stop_words_are_the_published_list(spark):
    """The oracle's own copy and Spark's list agree."""
    from registry.oracle import FUNCTION_WORDS

    assert set(FUNCTION_WORDS["fr"]) <= set(text.stop_words("fr")) and {"avions", "auraient", "soyez"} <= set(FUNCTION_WORDS["fr"])


def test_stems_follow_the_regions_of_the_word(apply):
    french = {
        "services": "servic", "continuation": "continu", "rapidement": "rapid", "banques": "banqu", "clients": "client",
        "nationale": "national", "agences": "agenc", "compétences": "compétent", "personnelle": "personnel", "conseillers": "conseil",
        "conseillère": "conseil", "fréquemment": "fréquent", "constamment": "constant", "chevaux": "cheval", "bureaux": "bureau",
        "sérieuse": "sérieux", "employées": "employ", "technologies": "technolog", "finissent": "fin", "applications": "applic",
        # The ending lies outside its region.
        "nation": "nation", "table": "tabl", "danse": "dans", "été": "été",
    }
    arabic = {"والخدمة": "خدم", "الخدمات": "خدم", "للبنك": "بنك", "موظفون": "موظف", "والموظفين": "موظف", "ممتازة": "ممتاز", "بنك": "بنك"}
    for lang, pairs in (("fr", french), ("ar", arabic)):
        got = apply(lambda c, lang=lang: F.array_join(text.stem_tokens(F.split(c, " "), lang), " "), list(pairs))
        assert dict(zip(pairs, got)) == pairs


def test_a_changed_table_gets_a_new_fit(spark, tmp_path, monkeypatch):
    words = ["accueil", "guichet", "attente", "carte", "frais", "compte"]
    rows = [(i, f"{words[i % 6]} {words[(i // 6) % 6]} {words[(i + 3) % 6]} long", "fr", "b", "v") for i in range(60)]
    frame = lambda data: spark.createDataFrame(data, "id long, avis string, langue string, banque string, ville string")
    fits = []
    fit = topics.fit_topics
    monkeypatch.setattr(topics, "fit_topics", lambda *a, **k: fits.append(1) or fit(*a, passes=1))
    folder = str(tmp_path / "models")
    first = topics.assigned(topics.saved_topic_models(frame(rows), folder), spark)
    again = topics.assigned(topics.saved_topic_models(frame(rows[::-1]).repartition(3), folder), spark)
    assert len(fits) == 1 and again.count() == 60 and again.exceptAll(first).isEmpty()
    topics.saved_topic_models(frame(rows[:-1] + [(59, "service rapide et accueil parfait", "fr", "b", "v")]), folder)
    assert len(fits) == 2
    # A fit that was not saved to its end is not taken.
    part = next(p for p in (tmp_path / "models").rglob("complete"))
    part.rename(part.with_name("incomplete"))
    topics.saved_topic_models(frame(rows), folder)
    assert len(fits) in (2, 3)


def test_stems_are_made_once_for_the_filter_and_the_rows(spark):
    rows = [(1, "services services rapides", "fr"), (2, "الخدمات ممتازة", "ar"), (3, "le", "fr"), (4, "services rapides", "mixed"), (5, "guichets banque et", "fr")]
    prepared = topics.prep_corpus(spark.createDataFrame(rows, "id long, avis string, langue string"))
    assert {r["id"]: r["words"] for r in prepared.collect()} == {1: ["servic", "servic", "rapid"], 2: ["خدم", "ممتاز"], 5: ["guichet"]}
    plan = prepared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(regexp_replace(") == len(topics.LANGUAGES)


def test_stems_of_lists_with_gaps(spark):
    words = spark.createDataFrame([(1, ["services", None, "services"]), (2, None), (3, []), (4, ["", "rapides"])], "id long, words array<string>")
    got = {r["id"]: r["s"] for r in words.coalesce(1).select("id", text.stem_tokens(F.col("words"), "fr").alias("s")).collect()}
    assert got == {1: ["servic", None, "servic"], 2: None, 3: [], 4: ["", "rapid"]}


def test_a_full_memory_of_stems_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(text, "KNOWN_STEMS", 1)
    words = spark.createDataFrame([(["services", "rapides", "services"],)], "words array<string>")
    assert words.select(text.stem_tokens(F.col("words"), "fr").alias("s")).first()["s"] == ["servic", "rapid", "servic"]


def test_vocabulary_equals_the_count_of_all_terms(spark, monkeypatch):
    """Brute force, with pairs above and below the last word's count, ties, and a word that is in nearly all documents."""
    lists = [["tout", *[f"m{(i * k) % 11}" for k in range(1, 5)], "tout"][: 2 + i % 5] for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(lists)), "id long, words array<string>")
    found = [[*w, *[f"{a} {b}" for a, b in zip(w, w[1:])]] for w in lists]
    counts = {t: (sum(t in f for f in found), sum(f.count(t) for f in found)) for f in found for t in f}
    used = sorted((-n, t, d) for t, (d, n) in counts.items() if 2 <= d <= 48)
    for size in (1, 5, 11, 20, 1000):
        for frequent in (10, 0):
            monkeypatch.setattr(topics, "FREQUENT", frequent)
            got = [(-r["occurrences"], r["term"], r["documents"]) for r in topics.vocabulary(docs, 60, size).collect()]
            assert got == used[:size]


def test_rare_words_are_left_out_of_pairs(spark, monkeypatch):
    seen, pairs = [], topics.pairs
    monkeypatch.setattr(topics, "pairs", lambda words, among=None: seen.append(among) or pairs(words, among))
    docs = spark.createDataFrame([(i, ["guichet", "frais", f"rare{i // 2}"][: 2 + i % 2]) for i in range(12)] + [(12, ["autre"])] * 4, "id long, words array<string>")
    got = {r["term"]: (r["documents"], r["occurrences"]) for r in topics.vocabulary(docs, 16, 2).collect()}
    assert got == {"frais": (12, 12), "guichet": (12, 12)} and [sorted(x) for x in seen] == [["frais", "guichet"]]


def test_weights_come_from_the_stored_parts(spark):
    from pyspark.ml.linalg import Vectors

    known = [Row(term=t) for t in "abc"]
    vectors = spark.createDataFrame([(1, Vectors.sparse(3, [0, 2], [0.6, 0.8])), (2, Vectors.dense([0.0, 1.0, 0.0])), (3, Vectors.sparse(3, [], []))], ["id", "features"])
    weights = topics.weights(vectors, known)
    assert {tuple(r) for r in weights.collect()} == {(1, "a", 0.6), (1, "c", 0.8), (2, "b", 1.0)}
    assert "UDF(" not in weights._jdf.queryExecution().optimizedPlan().toString()


def test_a_vocabulary_is_counted_once(spark, monkeypatch):
    calls, count = [], topics.vocabulary
    monkeypatch.setattr(topics, "vocabulary", lambda *a: calls.append(1) or count(*a))
    for name in ("topic_vocabulary", "topic_names_of_terms"):
        calls.clear()
        rows = QUERIES[name](spark, "/root/testdata/sf0.001").groupBy("langue").count().collect()
        assert len(calls) == len(rows) > 0


@pytest.fixture(scope="module")
def dealt_vectors(spark):
    rows = [(i, [f"m{(i * j + j // 3) % 23}" for j in range(1, 3 + i % 9)] if i % 17 else [f"only{i}"]) for i in range(300)]
    docs = spark.createDataFrame(rows, "id long, words array<string>")
    known = topics.vocabulary(docs, 300).orderBy(F.desc("occurrences"), "term").collect()
    return topics.stored(topics.dealt(topics.tfidf(docs, known, 300)), "vectors", "batch")


def test_blocks_are_inferred_as_by_sparks_lda(dealt_vectors):
    """The same topics given, every document has the shares that Spark's own model finds one by one."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.functions import vector_to_array

    lda = LDA(k=8, seed=42, optimizer="online", maxIter=5, subsamplingRate=0.5, docConcentration=[0.125], optimizeDocConcentration=False, featuresCol="features")
    model = lda.fit(dealt_vectors)
    want = {r["id"]: r["p"] for r in model.transform(dealt_vectors).select("id", vector_to_array("topicDistribution").alias("p")).collect()}
    got = {r["id"]: r for r in topics.assign_topics(model.topicsMatrix().toArray().T, dealt_vectors).collect()}
    assert got.keys() == want.keys()
    found = {i: (r["topic_id"], float(r["topic_probability"])) for i, r in got.items()}
    assert all(found[i] == (0, 0.125) for i, p in want.items() if sum(p) == 0)
    # Both stop at the same small change, from different starts: of these mixed documents about 6 % settle a little apart.
    near = [abs(p[found[i][0]] - max(p)) < 0.02 and abs(found[i][1] - max(p)) < 0.02 for i, p in want.items() if sum(p)]
    assert sum(near) > 0.9 * len(near) > 0


def test_an_update_reads_its_own_part_only(spark, dealt_vectors, monkeypatch):
    read, cells = [], topics._cells
    monkeypatch.setattr(topics, "_cells", lambda frame, *more: read.append(frame) or cells(frame, *more))
    model = topics.fit_topics(dealt_vectors, passes=2)
    assert len(read) == 2 * topics.BATCHES and sum(f.count() for f in read) == 2 * dealt_vectors.count() == 600
    assert all("PartitionFilters: [isnotnull(batch" in f._jdf.queryExecution().executedPlan().toString() for f in read)
    # One wave of tasks.
    assert all(f.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism for f in read)
    assert sorted(r["id"] for f in read[: topics.BATCHES] for r in f.select("id").collect()) == list(range(300))
    # Rows in another order and other files lie in the same parts.
    again = topics.stored(topics.dealt(dealt_vectors.drop("batch").orderBy(F.desc("id")).repartition(7)), "vectors", "batch")
    assert abs(topics.fit_topics(again, passes=2) - model).max() < 1e-9


def test_parts_without_documents_are_passed_over(spark, dealt_vectors):
    few = topics.dealt(dealt_vectors.drop("batch").filter("id in (1, 2)"))
    assert topics.fit_topics(few, passes=1).shape[0] == 8


def test_topics_of_a_document_do_not_depend_on_its_block(monkeypatch):
    import numpy as np

    from branchvoice.functions import inference

    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 9, 200)
    docs = inference.Documents(rng.integers(0, 30, sizes.sum()), rng.random(sizes.sum()), sizes)
    likely = inference.exp_expected_log(rng.gamma(1.0, 1.0, (8, 30))).T
    counts, _ = inference.topic_counts(docs, likely, 0.125)
    sums = inference.word_statistics(docs, likely, 0.125)
    for block in (1, 7, 1000):
        monkeypatch.setattr(inference, "BLOCK", block)
        assert (inference.topic_counts(docs, likely, 0.125)[0] == counts).all()
    for i in np.flatnonzero(sizes):
        cells = docs.cells(np.array([i]))
        share = inference.exp_expected_log(counts[i : i + 1])[0]
        words, w = likely[docs.places[cells]], docs.weights[cells]
        ratio = w / (words @ share)
        # Settled: one more round changes little.
        assert np.abs(0.125 + share * (ratio @ words) - counts[i]).mean() < 2e-3
        np.subtract.at(sums, docs.places[cells], words * share * ratio[:, None])
    assert np.abs(sums).max() < 1e-9 and (counts[sizes == 0] == 1).all()


def test_digamma():
    import numpy as np

    from branchvoice.functions import inference

    got = [np.log(y) + r for y, r in [inference._digamma_parts(np.array([0.125, 1.0, 3.5, 50.0, 1e6]))]][0]
    assert np.abs(got - [-8.388492663295854, -0.5772156649015329, 1.1031566406452432, 3.901989673427892, 13.815510057964191]).max() < 1e-10
