"""Topic model: one distributed LDA per language over TF-IDF vectors."""

from concurrent.futures import ThreadPoolExecutor
from math import log

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from branchvoice.functions import inference, names, text
from branchvoice.operators.aggregates import by_language, count_by, union_all
from branchvoice.operators.storage import stored
from branchvoice.operators.workers import ship

LANGUAGES = ["fr", "ar"]
MIN_LANGUAGE_REVIEWS = 20
MIN_DOCUMENTS = 10
TOPICS = 8
PASSES = 10
# Every update reads one of so many parts of the documents, whatever the size of the corpus.
BATCHES = 5
# The first updates count less; later ones fade by this power.
LEARNING_OFFSET, LEARNING_DECAY = 50.0, 0.7
OTHER_LABEL = {"fr": "Topic", "ar": "موضوع"}


def eligible_languages(corpus: DataFrame, minimum: int = MIN_LANGUAGE_REVIEWS) -> DataFrame:
    """Languages with enough reviews for a model."""
    return count_by(corpus.filter(F.col("langue").isin(LANGUAGES)), "langue").filter(F.col("n") >= minimum)


def prep_corpus(corpus: DataFrame) -> DataFrame:
    """Word lists (id, langue, words) of both languages in one pass; reviews with five characters or fewer left are dropped."""
    words = text.by_language(text.topic_words, F.col("avis"), F.col("langue"), LANGUAGES)
    prepared = corpus.filter(F.col("langue").isin(LANGUAGES)).select("id", "langue", words.alias("words"))
    return prepared.filter(F.length(F.array_join("words", " ")) > 5)


def pairs(words: Column, among: list[str] | None = None) -> Column:
    """Pairs of neighbours; NULL in place of those with a word that is not among the given ones."""

    def pair(a: Column, b: Column) -> Column:
        joined = F.concat_ws(" ", a, b)
        return joined if among is None else F.when(a.isin(among) & b.isin(among), joined)

    return F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1),
        F.slice(words, F.lit(2), F.size(words) - 1),
        pair,
    )


def terms(words: Column) -> Column:
    """Single words and pairs of neighbours."""
    return F.concat(words, pairs(words))


def _counted(docs: DataFrame, found: Column) -> DataFrame:
    """Documents and occurrences of every term in a column of term lists.

    Sorting a document's terms marks their first occurrence, so one aggregation (combined
    before its shuffle) gives both counts.
    """
    ordered = docs.select(F.sort_array(found).alias("term"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("term", F.lit(1), F.greatest(F.size("term") - 1, F.lit(0))))
    marked = ordered.select("term", before.alias("before")).select(F.inline(F.arrays_zip("term", "before"))).filter("term is not null")
    first = F.when(F.col("term") == F.col("before"), 0).otherwise(1)
    return marked.groupBy("term").agg(F.sum(first).alias("documents"), F.count("*").alias("occurrences"))


#: Frequent words that pairs are looked up in, as a multiple of the vocabulary; with more of them all pairs are counted.
FREQUENT = 10


def vocabulary(docs: DataFrame, rows: int, size: int = 1000) -> DataFrame:
    """The `size` most frequent terms found in 2 documents or more and in at most 80 %.

    Words are counted first. A pair occurs no more often than either of its words, and one that
    occurs less often than the `size`-th word has no place: only pairs of two words that reach
    its count are counted. Words hold no space.
    """
    used = lambda counts: counts.filter((F.col("documents") >= 2) & (F.col("documents") <= 0.8 * rows))
    first = lambda counts: counts.orderBy(F.desc("occurrences"), "term").limit(size)
    counts = stored(_counted(docs, F.col("words")), "words-counted")
    singles = stored(first(used(counts)), "words-used")
    n, least = singles.agg(F.count("*"), F.min("occurrences")).first()
    # A term of two documents occurs twice.
    least = least if n == size else 2
    most = FREQUENT * size
    frequent = [r["term"] for r in counts.filter(F.col("occurrences") >= least).limit(most + 1).collect()]
    found = pairs(F.col("words"), frequent if len(frequent) <= most else None)
    return first(singles.unionByName(used(_counted(docs, found))))


def tfidf(docs: DataFrame, known: list[Row], rows: int) -> DataFrame:
    """Term counts times smoothed idf + 1, scaled to unit length.

    The vocabulary (at most 1000 rows) is the only thing that reaches the driver; its
    document counts give the idf without another pass over the documents.
    """
    idf = DenseVector([log((1 + rows) / (1 + r["documents"])) + 1.0 for r in known])
    stages = [
        CountVectorizerModel.from_vocabulary([r["term"] for r in known], inputCol="terms", outputCol="counts"),
        ElementwiseProduct(scalingVec=idf, inputCol="counts", outputCol="weighted"),
        Normalizer(p=2.0, inputCol="weighted", outputCol="features"),
    ]
    tagged = docs.select("id", terms(F.col("words")).alias("terms"))
    return PipelineModel(stages).transform(tagged).select("id", "features")


def _parts(vectors: DataFrame) -> tuple[Column, Column]:
    """Places and values of the stored parts of the vectors, not the zeros of the whole vocabulary."""
    vector = F.unwrap_udt("features")
    return F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1)), vector["values"]


def weights(vectors: DataFrame, known: list[Row]) -> DataFrame:
    """The vectors as rows (id, term, weight)."""
    table = F.array(*[F.lit(r["term"]) for r in known])
    cells = vectors.select("id", F.inline(F.arrays_zip(*_parts(vectors)))).toDF("id", "index", "weight")
    return cells.filter("weight > 0").select("id", F.get(table, F.col("index")).alias("term"), "weight")


def dealt(vectors: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The vectors with the part of the corpus that each lies in, by hash of id and vector.

    Every part is spread evenly over as many partitions as tasks run at once, so that an update
    over its files is one wave of equal tasks.
    """
    key = F.xxhash64("id", F.unwrap_udt("features"))
    tagged = vectors.withColumn("batch", F.pmod(key, F.lit(batches)).cast("int"))
    return tagged.repartition(vectors.sparkSession.sparkContext.defaultParallelism, key)


def _cells(vectors: DataFrame, *more: str) -> DataFrame:
    places, values = _parts(vectors)
    return vectors.select(*more, places.alias("places"), values.alias("weights"))


def fit_topics(vectors: DataFrame, k: int = TOPICS, batches: int = BATCHES, passes: int = PASSES) -> np.ndarray:
    """Online LDA over dealt vectors: `passes` looks at every document, each in `batches` updates; k x terms.

    The schedule is the same at every size. An update reads its own part of the vectors only, so
    they are read `passes` times. It starts from the topics that Spark's LDA starts from and takes the
    same steps; documents are inferred by blocks instead of one by one. What reaches the driver is
    one sum a task, with a number per term and topic (64 KB), added in the order of the tasks.
    """
    ship(vectors.sparkSession)
    alpha = 1.0 / k
    start = LDA(k=k, seed=42, optimizer="online", maxIter=0, featuresCol="features").fit(vectors.select("features").limit(1))
    found = start.topicsMatrix().toArray().T
    sizes = {r["batch"]: r["n"] for r in count_by(vectors, "batch").collect()}
    updates = [b for _ in range(passes) for b in range(batches) if b in sizes]
    for i, b in enumerate(updates, 1):
        likely = inference.exp_expected_log(found).T
        part = _cells(vectors.filter(F.col("batch") == b)).mapInArrow(inference.statistics_step(likely, alpha), "sums array<double>")
        seen = sum(sums.reshape(-1, k).T for sums in part.toArrow()["sums"].to_numpy())
        rate = (LEARNING_OFFSET + i) ** -LEARNING_DECAY
        found = (1 - rate) * found + rate * (seen * sum(sizes.values()) / sizes[b] + 1.0 / k)
    return found


def assign_topics(model: np.ndarray, vectors: DataFrame) -> DataFrame:
    """Strongest topic of every document with its probability.

    A document without any known term has no evidence: all topics are equally likely and
    the first one is taken.
    """
    ship(vectors.sparkSession)
    step = inference.strongest_step(inference.exp_expected_log(model).T, 1.0 / len(model))
    schema = f"id {vectors.schema['id'].dataType.simpleString()}, topic_id int, share double"
    best = _cells(vectors, "id").mapInArrow(step, schema)
    return best.select("id", "topic_id", F.col("share").cast("decimal(4,3)").alias("topic_probability"))


def top_terms(spark: SparkSession, model: np.ndarray, known: list[str], n: int = 5) -> DataFrame:
    """The n strongest terms of each topic (k x n rows), strongest first."""
    order = np.argsort(-model, axis=1, kind="stable")[:, :n]
    rows = [(topic, place, known[i]) for topic, row in enumerate(order.tolist()) for place, i in enumerate(row)]
    return spark.createDataFrame(rows, "topic_id int, place int, term string")


def name_topics(strong: DataFrame, lang: str) -> DataFrame:
    """Label of the first strong term with a known keyword, else number and three terms."""
    labelled = strong.withColumn("label", names.keyword_topic(F.lower("term")))
    label = F.min_by("label", F.when(F.col("label").isNotNull(), F.col("place")))
    strongest = F.array_sort(F.collect_list(F.when(F.col("place") < 3, F.struct("place", "term"))))
    listed = F.array_join(F.transform(strongest, lambda x: x["term"]), ", ")
    other = F.concat(
        F.lit(OTHER_LABEL.get(lang, OTHER_LABEL["ar"])), F.lit(" "), (F.col("topic_id") + 1).cast("string"), F.lit(": "), F.col("listed")
    )
    grouped = labelled.groupBy("topic_id").agg(label.alias("label"), listed.alias("listed"))
    return grouped.select("topic_id", F.coalesce("label", other).alias("topic_name"))


class LanguageTopics:
    """Vectors, model and names of one language; `ready` is False below the size gate."""

    def __init__(self, words: DataFrame, lang: str):
        self.lang = lang
        self.documents = by_language(words, lang)
        self.rows = self.documents.count()
        self.ready = self.rows >= MIN_DOCUMENTS
        if self.ready:
            # At most 1000 rows, counted once.
            self.vocabulary = stored(vocabulary(self.documents, self.rows), "vocabulary")
            self.known = self.vocabulary.orderBy(F.desc("occurrences"), "term").collect()

    def fit(self) -> "LanguageTopics":
        # Every update reads the folder of its own part.
        self.vectors = stored(dealt(self.tfidf()), "vectors", "batch")
        self.model = fit_topics(self.vectors)
        self.names = name_topics(top_terms(self.vectors.sparkSession, self.model, [r["term"] for r in self.known]), self.lang)
        return self

    def save(self, path: str) -> None:
        spark = self.documents.sparkSession
        topics = list(enumerate(self.model.tolist()))
        spark.createDataFrame(topics, "topic int, words array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        spark.createDataFrame(self.known, "term string, documents long, occurrences long").coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.names.coalesce(1).write.mode("overwrite").parquet(f"{path}/names")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/complete")

    def load(self, path: str) -> "LanguageTopics":
        spark = self.documents.sparkSession
        self.model = np.array([r["words"] for r in spark.read.parquet(f"{path}/model").orderBy("topic").collect()])
        self.known = spark.read.parquet(f"{path}/vocabulary").orderBy(F.desc("occurrences"), "term").collect()
        self.names = spark.read.parquet(f"{path}/names")
        self.vectors = self.tfidf()
        return self

    def tfidf(self) -> DataFrame:
        return tfidf(self.documents, self.known, self.rows)

    def assignments(self) -> DataFrame:
        # k rows of names.
        return assign_topics(self.model, self.vectors).join(F.broadcast(self.names), "topic_id").select(
            "id", "topic_id", "topic_name", "topic_probability", F.lit(self.lang).alias("langue")
        )


def language_documents(corpus: DataFrame) -> list[LanguageTopics]:
    """Documents and vocabulary of every language that passes both size gates.

    The corpus should stand on a written table: it is read for the gate and once for the words.
    """
    enough = [r["langue"] for r in eligible_languages(corpus).collect()]  # at most two rows
    words = stored(prep_corpus(corpus), "words")
    found = [LanguageTopics(words, lang) for lang in LANGUAGES if lang in enough]
    return [m for m in found if m.ready]


def topic_models(corpus: DataFrame) -> list[LanguageTopics]:
    """A fitted model for every language that passes both size gates, fitted side by side."""
    with ThreadPoolExecutor(len(LANGUAGES)) as pool:
        return list(pool.map(LanguageTopics.fit, language_documents(corpus)))


def corpus_digest(corpus: DataFrame) -> str:
    """A key of the corpus' rows, whatever their order: it changes when a row changes, comes or goes."""
    row = F.xxhash64(*[F.col(c).cast("string") for c in ("id", "avis", "langue")])
    other = F.crc32(F.concat_ws("\x1f", F.col("id").cast("string"), "langue", "avis").cast("binary"))
    seen = corpus.agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum(other).alias("s")).first()
    return f"{seen['n']}-{(seen['x'] or 0) & (1 << 64) - 1:016x}-{seen['s'] or 0}"


def _saved(spark: SparkSession, path: str) -> bool:
    """The marker is written last: without it a fit was not saved to its end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/complete")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def saved_topic_models(corpus: DataFrame, folder: str) -> list[LanguageTopics]:
    """Models of this very corpus: loaded from `folder` where they were saved, else fitted and saved there.

    A model is kept under a digest of the corpus, so one of other data is never taken for it, and
    outlives the session. Vocabulary and names (at most 1000 and 8 rows) lie beside it; vectors
    follow from corpus and vocabulary and are not kept.
    """
    spark = corpus.sparkSession
    root = f"{folder}/{corpus_digest(corpus)}"
    models = language_documents(corpus)

    def ready(m: LanguageTopics) -> LanguageTopics:
        path = f"{root}/{m.lang}"
        if _saved(spark, path):
            return m.load(path)
        m.fit().save(path)
        return m

    with ThreadPoolExecutor(len(LANGUAGES)) as pool:
        return list(pool.map(ready, models))


def assigned(models: list[LanguageTopics], spark: SparkSession) -> DataFrame:
    """Topic table of all languages, with the language: id, topic_id, topic_name, topic_probability, langue."""
    if not models:
        schema = "id long, topic_id int, topic_name string, topic_probability decimal(4,3), langue string"
        return spark.createDataFrame([], schema)
    return union_all(*[m.assignments() for m in models])


def review_topics(corpus: DataFrame) -> DataFrame:
    """Topic table: id, topic_id, topic_name, topic_probability over all languages."""
    return assigned(topic_models(corpus), corpus.sparkSession).drop("langue")


def topic_sizes(topics: DataFrame) -> DataFrame:
    """Documents per language and topic of a topic table that carries the language."""
    return count_by(topics, "langue", "topic_id", "topic_name")
