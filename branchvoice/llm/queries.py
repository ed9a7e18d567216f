"""Queries of the operators in this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchvoice.llm import (
    decontamination, language, lexical, minhash, mixing, packing, secret_scan, sharding, substrings, token_counts, token_files, vector_codes, vectors,
)
from branchvoice.llm.stages import new_folder, ship


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file, the same on all workers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(documents(spark, sf_dir), shards=16)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return rows.select("doc_id", "size", crc, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.secrets(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every run encodes all contents; pass a lasting folder to keep counts."""
    cache = new_folder(spark, "token-cache")
    return token_counts.token_counts(
        documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), cache, normalise=token_counts.one_space, by_word=True
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = language.identified(documents(spark, sf_dir))
    return rows.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    manifest = token_files.write_tokens(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), folder, end=0)
    return token_files.read_tokens(spark, folder, manifest)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.without_repeats(documents(spark, sf_dir), window=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.9)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=2, percent=80)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=20)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("codebooks")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_token_files": op6_token_files,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_packing": op13_packing,
}

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
#: Components of `edges` (both directions) over `nodes`: the smallest id that each can reach.
REACHED = """
  reached AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a),
  labelled AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a)"""

TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Each round as two common tables: the nearest entry of every part, and the codebooks that follow from it."""
    near = """
      near{k} AS MATERIALIZED (SELECT row, p, any_value(x) AS x,
        min({entries} * CAST(list_sum(list_transform(x, lambda a, i: (a - c[i]) * (a - c[i]))) AS BIGINT) + e) AS best FROM cut JOIN book{k} USING (p) GROUP BY row, p)"""
    book = """
      mean{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
        SELECT p, e, i, CAST(sum(a) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT p, best % {entries} AS e, unnest(x) AS a, generate_subscripts(x, 1) AS i FROM near{k}) GROUP BY p, e, i) GROUP BY p, e),
      book{next} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e)"""
    steps = [t.format(k=k, next=k + 1, entries=entries) for k in range(rounds) for t in (near, book)] + [near.format(k=rounds, entries=entries)]
    return f"""
      WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({scale} * x) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      cut AS MATERIALIZED (SELECT row, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS parts(p)),
      book0 AS MATERIALIZED (SELECT p, row AS e, x AS c FROM cut WHERE row < {entries}),{",".join(steps)},
      coded AS (SELECT row, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY row)
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
      FROM kept JOIN coded USING (row)"""


#: What SQL can express; the others rest on samples, models, draws or tokenizers, and are tested against brute force.
ORACLE: dict[str, str] = {
    "op7_substring_dedup": f"""
      WITH docs AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents),
      places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM docs WHERE len(w) >= 13),
      windows AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS g FROM places),
      first AS (SELECT g, min(doc_id) AS d FROM windows GROUP BY g),
      gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM windows JOIN first USING (g) WHERE d < doc_id),
      words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
      kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) FILTER (g.p IS NULL) AS kept, count(g.p) AS n
               FROM words x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id)
      SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
      FROM docs LEFT JOIN kept ON docs.doc_id = kept.doc_id""",
    "op8_embedding_near_dedup": f"""
      WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
      usable AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                 WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
      edges AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
                WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
      {REACHED}
      SELECT id AS vec_id, (SELECT count(*) FROM edges WHERE a = id) AS n_links, component_id, id = component_id AS kept FROM labelled""",
    "op10_minhash_near_dedup": f"""
      WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
      docs AS (SELECT doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
      sets AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM docs),
      shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
      edges AS (SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id
                AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
                GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
      {REACHED}
      SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, id = component_id AS kept
      FROM labelled JOIN sets ON id = doc_id""",
    "op11_lexical_search": f"""
      WITH docs AS (SELECT doc_id, {TERMS} AS w FROM documents WHERE text IS NOT NULL),
      total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM docs WHERE len(w) > 0),
      counts AS (SELECT doc_id, n, word, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS word FROM docs) GROUP BY doc_id, n, word),
      weights AS (SELECT word, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counts, total GROUP BY word),
      asked AS (SELECT item_id, word, count(*) AS times FROM (SELECT item_id, unnest({TERMS}) AS word FROM benchmark WHERE text IS NOT NULL) GROUP BY item_id, word),
      scored AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words)))) AS BIGINT) AS score
                 FROM asked JOIN weights USING (word) JOIN counts USING (word), total GROUP BY item_id, doc_id),
      ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
      SELECT * FROM ranked WHERE rank <= 20""",
    "op12_vector_codes": lloyd_sql(),
}
