"""The registered queries in plain SQL over the same tables.

Written independently of the Spark expressions: windows instead of range ranking, one
regular expression per cleaning step, full word lists. Only fixed values are shared.
"""

import re
from pathlib import Path

from branchvoice.functions import rules
from branchvoice.sources import documents as doc

AS_OF = "DATE '2025-06-30'"
STAMP = "TIMESTAMP '2025-06-30 00:00:00'"


def lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def arr(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({arr(values)})[({index}) % {len(values)} + 1]"


def first_match(text: str, table, default: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({text}, {lit(n)})" for n in needles) + f" THEN {lit(value)}"
        for needles, value in table
    )
    return f"CASE {whens} ELSE {default} END"


def pct(num: str, den: str) -> str:
    return ratio(f"({num}) * 100", den, 2)


def ratio(num: str, den: str, digits: int) -> str:
    scale = 10**digits
    return (
        f"CASE WHEN {den} > 0 THEN CAST((CAST({num} AS HUGEINT) * {2 * scale} + CAST({den} AS HUGEINT)) // (CAST({den} AS HUGEINT) * 2)"
        f" AS DOUBLE) / {scale} END"
    )


def is_in(c: str, values) -> str:
    return f"{c} IN (" + ", ".join(lit(v) for v in values) + ")"


# --- column rules ------------------------------------------------------------------

AR = rules.ARABIC_BLOCKS


def clean(c: str) -> str:
    no_urls = f"regexp_replace(lower({c}), 'https?://[^\\s]+', '', 'g')"
    kept = f"regexp_replace({no_urls}, '[^\\p{{L}}\\p{{N}}_\\s{AR}'']', ' ', 'g')"
    return f"trim(regexp_replace({kept}, '\\s+', ' ', 'g'), ' ')"


def normalize(c: str) -> str:
    s = clean(c)
    for mark in (r"\.", "!", r"\?"):
        s = f"regexp_replace({s}, '{mark}{{2,}}', '{mark[-1]}', 'g')"
    return f"trim({s}, ' ')"


def language(c: str) -> str:
    def n(cls):
        return f"len(regexp_extract_all({c}, '[{cls}]'))"

    return (
        f"CASE WHEN {n(AR)} * 10 > length({c}) * 3 THEN 'ar' "
        f"WHEN {n(rules.FRENCH_LETTERS)} * 2 > length({c}) THEN 'fr' ELSE 'mixed' END"
    )


def sentiment(c: str) -> str:
    stars = " ".join(f"WHEN regexp_matches({c}, {lit('(?s)' + p)}) THEN '{v}'" for p, v in rules.STAR_RULES)
    return (
        f"CASE WHEN regexp_matches(lower({c}), {lit('|'.join(rules.POSITIVE_WORDS))}) THEN 'Positif' "
        f"WHEN regexp_matches(lower({c}), {lit('|'.join(rules.NEGATIVE_WORDS))}) THEN 'Negatif' {stars} "
        f"ELSE 'Neutre' END"
    )


def whole_words(words) -> str:
    return f"(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(words)})($|[^\\p{{L}}\\p{{N}}_])"


def sentiment_whole(c: str) -> str:
    s = sentiment(c)
    for words in (rules.POSITIVE_WORDS, rules.NEGATIVE_WORDS):
        s = s.replace(lit("|".join(words)), lit(whole_words(words)))
    return s


def folded(text: str) -> str:
    bare = str.maketrans(*rules.FOLDED)
    table = [([n.translate(bare) for n in needles], v) for needles, v in rules.TOPIC_KEYWORDS]
    return first_match(f"translate({text}, {lit(rules.FOLDED[0])}, {lit(rules.FOLDED[1])})", table, "NULL")


def rating(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[0-5](\\.[0-9])?$') THEN CAST({c} AS DECIMAL(2,1)) ELSE CAST(0 AS DECIMAL(2,1)) END"


def stripped_rating(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}, ' ') = '' THEN '0' WHEN regexp_matches({c}, '^[0-5](\\.[0-9])?$') THEN {c} "
        f"ELSE regexp_replace({c}, '[^0-9.]', '', 'g') END"
    )


def missing(c: str, default: str) -> str:
    return f"CASE WHEN {c} IS NULL OR trim({c}, ' ') IN ('', 'nan', 'null') THEN {lit(default)} ELSE {c} END"


def blank_to(c: str, default: str) -> str:
    return f"CASE WHEN {c} IS NULL OR trim({c}, ' ') = '' THEN {lit(default)} ELSE trim({c}, ' ') END"


def basic_date(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_matches({c}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(try_strptime({c}, '%d/%m/%Y') AS DATE) END"
    )


def dmy(c: str) -> str:
    return (
        f"strftime(CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_matches({c}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(try_strptime({c}, '%d/%m/%Y') AS DATE) "
        f"WHEN regexp_matches(lower({c}), '(?s)il y a.*jour') THEN {AS_OF} - 1 "
        f"WHEN regexp_matches(lower({c}), '(?s)il y a.*semaine') THEN {AS_OF} - 7 "
        f"WHEN regexp_matches(lower({c}), '(?s)il y a.*mois') THEN CAST({AS_OF} - INTERVAL 1 MONTH AS DATE) "
        f"ELSE CAST(try_strptime(regexp_extract({c}, '\\d{{1,2}}-\\d{{1,2}}-\\d{{4}}'), '%d-%m-%Y') AS DATE) END, '%d/%m/%Y')"
    )


AGO = "il y a ([0-9]{1,4}|une?) (jour|semaine|mois|an)"


def dmy_exact(c: str) -> str:
    number, unit = (f"regexp_extract(lower({c}), {lit(AGO)}, {k})" for k in (1, 2))
    n = f"(CASE WHEN {number} IN ('un', 'une') THEN 1 ELSE try_cast({number} AS INTEGER) END)"
    back = (
        f"CASE {unit} WHEN 'jour' THEN {AS_OF} - {n} WHEN 'semaine' THEN {AS_OF} - 7 * {n} "
        f"WHEN 'mois' THEN CAST({AS_OF} - to_months({n}) AS DATE) WHEN 'an' THEN CAST({AS_OF} - to_months(12 * {n}) AS DATE) END"
    )
    dated = f"regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') OR regexp_matches({c}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$')"
    return f"CASE WHEN {dated} THEN {dmy(c)} ELSE coalesce(strftime({back}, '%d/%m/%Y'), {dmy(c)}) END"


LABEL_DATE = "CASE WHEN regexp_matches(date_avis, '^\\d{1,2}/\\d{1,2}/\\d{4}$') THEN CAST(try_strptime(date_avis, '%d/%m/%Y') AS DATE) END"
QUALITY = (
    "CASE WHEN avis_length_cleaned >= 20 AND langue_detected IN ('fr','ar') THEN 1.0::DOUBLE "
    "WHEN avis_length_cleaned >= 10 AND langue_detected IN ('fr','ar') THEN 0.8::DOUBLE "
    "WHEN avis_length_cleaned >= 5 THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END"
)
LENGTH_BIN = (
    "CASE WHEN avis_length_cleaned <= 10 THEN 'tres_court' WHEN avis_length_cleaned <= 50 THEN 'court' "
    "WHEN avis_length_cleaned <= 150 THEN 'moyen' WHEN avis_length_cleaned <= 300 THEN 'long' ELSE 'tres_long' END"
)
BANK = first_match("lower(banque)", rules.BANK_NAMES, "banque")
CITY = first_match("lower(ville)", rules.CITY_NAMES, "ville")
CATEGORY = first_match("topic", rules.TOPIC_CATEGORIES, lit(rules.OTHER_TOPIC_CATEGORY))
TOPIC_ID = "CASE " + " ".join(f"WHEN topic_name = {lit(v)} THEN {i}" for i, (_, v) in enumerate(rules.TOPIC_KEYWORDS)) + " END"


def equals(c: str, pairs, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} = {lit(k)} THEN {v}" for k, v in pairs) + f" ELSE {default} END"


def member(c: str, table, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {is_in(c, names)} THEN {lit(v)}" for names, v in table) + f" ELSE {lit(default)} END"


# --- models as common table expressions, in dependency order --------------------------

VALID = "avis_raw <> '' AND length(avis_raw) BETWEEN 5 AND 2000 AND banque <> 'Unknown'"
KEYS = ["banque", "ville", "nom_agence"]


def dedup(source: str, body: str) -> str:
    return f"""
      SELECT *, duplicate_rank > 1 AS is_exact_duplicate, similar_rank > 1 AS is_similar_duplicate,
             CASE WHEN duplicate_rank = 1 AND similar_rank = 1 THEN 1.0::DOUBLE WHEN duplicate_rank = 1 THEN 0.8::DOUBLE
                  WHEN text_quality_score > 0.8 THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END AS keep_confidence_score,
             CASE WHEN duplicate_rank > 1 THEN FALSE ELSE TRUE END AS should_keep
      FROM (SELECT *, md5(banque || ville || nom_agence || {body}) AS content_hash,
                   row_number() OVER (PARTITION BY banque, ville, nom_agence, {body} ORDER BY created_at, id) AS duplicate_rank,
                   row_number() OVER (PARTITION BY banque, ville, left({body}, 100) ORDER BY created_at, id) AS similar_rank
            FROM {source})"""


CTES = {
    "lines": """
      SELECT doc_id, n_chars, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos
      FROM (SELECT doc_id, n_chars, string_split(text, chr(10)) AS parts FROM documents)""",
    "raw": f"""
      SELECT doc_id * 2147483648 + pos + 1 AS id,
             CASE WHEN n_chars % 20 <= 5 THEN {lit(rules.CRAWLED_BANKS[0])}
                  WHEN n_chars % 20 <= 18 THEN ({arr(rules.CRAWLED_BANKS)})[n_chars % 20 - 4]
                  ELSE {pick(doc.DIRTY_BANKS, 'doc_id')} END AS banque,
             {pick(doc.CITIES, 'n_chars // 20')} AS ville,
             {pick(doc.BRANCHES, 'n_chars // 7')} AS nom_agence,
             CASE WHEN n_chars % 13 = 0 THEN '' ELSE (n_chars % 5) || ' rue ' || (n_chars % 11) END AS localisation,
             {pick(doc.NOTES, 'doc_id + pos')} AS note,
             {pick(doc.PHRASES, 'length(line)')} || line AS avis,
             {pick(doc.DATES, 'doc_id + pos')} AS date_avis,
             TIMESTAMP '2025-01-01 00:00:00' + to_minutes(CAST(doc_id % 50 AS BIGINT)) AS created_at,
             doc_id, pos, line
      FROM lines""",
    "stg": f"""
      SELECT * FROM (
        SELECT id, {', '.join(f"{blank_to(c, 'Unknown')} AS {c}" for c in [*KEYS, 'localisation'])},
               {blank_to('note', '0')} AS note_raw, {blank_to('avis', '')} AS avis_raw,
               {blank_to('date_avis', '')} AS date_avis_raw, created_at FROM raw) AS named
      WHERE {VALID}""",
    "cleaned": f"""
      SELECT *, {QUALITY} AS text_quality_score, {LENGTH_BIN} AS text_length_category
      FROM (SELECT *, length(avis_cleaned) AS avis_length_cleaned
            FROM (SELECT id, banque, ville, nom_agence, localisation, {rating('note_raw')} AS note_numeric,
                         avis_raw AS avis_original, {clean('avis_raw')} AS avis_cleaned,
                         length(avis_raw) AS avis_length_original, {language('avis_raw')} AS langue_detected,
                         date_avis_raw, created_at FROM stg))""",
    "dedup": dedup("cleaned", "avis_cleaned"),
    "kept": "SELECT * FROM dedup WHERE should_keep",
    "corpus": """
      SELECT id, avis_cleaned AS avis, langue_detected AS langue, banque, ville FROM kept
      WHERE avis_cleaned IS NOT NULL AND trim(avis_cleaned, ' ') <> '' AND length(avis_cleaned) >= 10""",
    "topics": f"""
      SELECT id, {TOPIC_ID} AS topic_id, topic_name, topic_probability
      FROM (SELECT id, {first_match('avis', rules.TOPIC_KEYWORDS, 'NULL')} AS topic_name,
                   CAST((id % 1000 + 1) / 1000 AS DECIMAL(4,3)) AS topic_probability
            FROM corpus WHERE langue IN ('fr', 'ar'))
      WHERE topic_name IS NOT NULL""",
    "mart": f"""
      SELECT k.id, {BANK} AS banque, {CITY} AS ville, nom_agence, localisation, note_numeric AS note, avis_cleaned AS avis,
             langue_detected AS langue, coalesce({dmy('date_avis_raw')}, 'Date inconnue') AS date_avis,
             {sentiment('avis_cleaned')} AS sentiment, coalesce(t.topic_name, {lit(rules.DEFAULT_TOPIC)}) AS topic
      FROM kept k LEFT JOIN topics t ON k.id = t.id
      WHERE trim(avis_cleaned, ' ') <> '' AND length(trim(avis_cleaned, ' ')) >= 5""",
    "bank": f"""
      SELECT row_number() OVER (ORDER BY bank_name) AS bank_key, bank_name,
             {equals('bank_name', [(n, lit(t)) for n, t, _ in rules.BANK_ATTRIBUTES], lit(rules.OTHER_BANK_TYPE))} AS bank_type,
             CAST({equals('bank_name', [(n, y) for n, _, y in rules.BANK_ATTRIBUTES], 'NULL')} AS BIGINT) AS founded_year,
             {STAMP} AS created_at
      FROM (SELECT DISTINCT banque AS bank_name FROM mart WHERE banque IS NOT NULL)""",
    "branch": f"""
      SELECT row_number() OVER (ORDER BY bank_name, city, branch_name) AS branch_key, branch_name, bank_name, city,
             {first_match('lower(branch_name)', rules.BRANCH_TYPES, lit(rules.STANDARD_BRANCH_TYPE))} AS branch_type,
             {first_match('lower(branch_name)', rules.BRANCH_SERVICES, lit(rules.STANDARD_SERVICES))} AS services,
             {STAMP} AS created_at
      FROM (SELECT DISTINCT nom_agence AS branch_name, banque AS bank_name, ville AS city FROM mart WHERE nom_agence IS NOT NULL)""",
    "place": f"""
      SELECT row_number() OVER (ORDER BY city, address) AS location_key, city, address,
             {member('city', rules.CITY_REGIONS, rules.OTHER_REGION)} AS region,
             {equals('city', [(c, lit(v)) for c, v in rules.CITY_CENTRES], 'NULL')} AS coordinates,
             {member('city', rules.CITY_SIZES, rules.SMALL_CITY)} AS city_size, {STAMP} AS created_at
      FROM (SELECT DISTINCT ville AS city, localisation AS address FROM mart WHERE ville IS NOT NULL)""",
    "feeling": "SELECT * FROM (VALUES "
    + ", ".join(f"({k}, {lit(s)}, {lit(r)}, {lit(d)})" for k, s, r, d in rules.SENTIMENTS)
    + ") AS v(sentiment_key, sentiment, score_range, description)",
    "subject": f"""
      SELECT row_number() OVER (ORDER BY topic) AS topic_key, topic AS topic_name, {CATEGORY} AS category,
             {equals('topic', [(n, lit(v)) for n, v in rules.TOPIC_DESCRIPTIONS], 'topic')} AS description, {STAMP} AS created_at
      FROM (SELECT DISTINCT topic FROM mart WHERE topic IS NOT NULL)""",
    "dated": f"""
      SELECT *, CAST(year(coalesce(review_date, {AS_OF})) AS BIGINT) AS review_year,
             CAST(month(coalesce(review_date, {AS_OF})) AS BIGINT) AS review_month
      FROM (SELECT *, {LABEL_DATE} AS review_date FROM mart)""",
    "fact": f"""
      SELECT d.id AS review_id, coalesce(bank_key, -1) AS bank_key, coalesce(branch_key, -1) AS branch_key,
             coalesce(location_key, -1) AS location_key, CAST(coalesce(sentiment_key, -1) AS BIGINT) AS sentiment_key,
             coalesce(topic_key, -1) AS topic_key, CAST(note AS DOUBLE) AS rating, avis AS review_text, langue AS language,
             review_date, {STAMP} AS created_at, CAST(note >= 4 AS BIGINT) AS is_positive_rating,
             CAST(note <= 2 AS BIGINT) AS is_negative_rating, CAST(d.sentiment = 'Positif' AS BIGINT) AS is_positive_sentiment,
             CAST(d.sentiment = 'Negatif' AS BIGINT) AS is_negative_sentiment, length(avis) AS review_length,
             review_year, review_month
      FROM dated d LEFT JOIN bank ON d.banque = bank_name
      LEFT JOIN branch b ON d.nom_agence = b.branch_name AND d.banque = b.bank_name AND d.ville = b.city
      LEFT JOIN place p ON d.ville = p.city AND d.localisation = p.address
      LEFT JOIN feeling f ON d.sentiment = f.sentiment LEFT JOIN subject s ON d.topic = s.topic_name""",
    "fanout": """
      SELECT d.id AS review_id, d.banque AS bank_name, coalesce(nb, 0) AS branch_matches, coalesce(np, 0) AS location_matches,
             greatest(coalesce(nb, 0), 1) * greatest(coalesce(np, 0), 1) AS fact_rows, review_year, review_month
      FROM dated d
      LEFT JOIN (SELECT branch_name, bank_name, count(*) AS nb FROM branch GROUP BY ALL) b
             ON d.nom_agence = b.branch_name AND d.banque = b.bank_name
      LEFT JOIN (SELECT city, count(*) AS np FROM place GROUP BY ALL) p ON d.ville = p.city""",
    "scored": f"""
      SELECT banque AS bank_name, ville AS city, nom_agence, note AS rating,
             note * CAST(0.12 AS DECIMAL(3,2)) + CASE sentiment WHEN 'Positif' THEN CAST(0.4 AS DECIMAL(2,1))
               WHEN 'Negatif' THEN CAST(0 AS DECIMAL(2,1)) ELSE CAST(0.2 AS DECIMAL(2,1)) END AS composite_score,
             sentiment, {LABEL_DATE} AS review_date, langue AS language, {CATEGORY} AS topic_category, topic_probability AS topic_confidence
      FROM mart m LEFT JOIN topics t ON m.id = t.id""",
    "analysis": f"""
      SELECT topic_category, bank_name, CAST(sum(rating * 10) AS BIGINT) AS tenths, count(*) AS review_count, CAST(sum(rating) AS DOUBLE) / count(*) AS avg_rating,
             CAST(sum(topic_confidence) AS DOUBLE) / count(topic_confidence) AS avg_confidence,
             count(*) FILTER (sentiment = 'Positif') AS positive_count, count(*) FILTER (sentiment = 'Negatif') AS negative_count,
             count(*) FILTER (sentiment = 'Neutre') AS neutral_count,
             {pct("count(*) FILTER (sentiment = 'Positif')", "count(*)")} AS positive_rate,
             {pct("count(*) FILTER (sentiment = 'Negatif')", "count(*)")} AS negative_rate,
             count(*) FILTER (language = 'fr') AS french_count, count(*) FILTER (language = 'ar') AS arabic_count
      FROM scored GROUP BY topic_category, bank_name""",
    "summary": f"""
      SELECT topic_category, CAST(sum((CAST(tenths AS HUGEINT) * 2000000000 + review_count * 10) // (review_count * 20)) AS DOUBLE) / count(*) / 1e9 AS overall_avg_rating, CAST(sum(review_count) AS BIGINT) AS total_reviews, CAST(sum(positive_count) AS BIGINT) AS total_positive,
             CAST(sum(negative_count) AS BIGINT) AS total_negative,
             {pct("sum(positive_count)", "sum(review_count)")} AS overall_positive_rate
      FROM analysis GROUP BY topic_category""",
    "variant": f"""
      SELECT *, {QUALITY} AS text_quality_score, {LENGTH_BIN} AS text_length_category
      FROM (SELECT *, length(avis_cleaned) AS avis_length_cleaned
            FROM (SELECT id, banque, ville, nom_agence, localisation, {rating('note_raw')} AS note_numeric,
                         avis_raw AS avis_original, {clean('avis_raw')} AS avis_cleaned, {normalize('avis_raw')} AS avis_normalized,
                         length(avis_raw) AS avis_length_original, {language('avis_raw')} AS langue_detected, date_avis_raw,
                         {basic_date('date_avis_raw')} AS date_avis_parsed, created_at
                  FROM (SELECT id, {', '.join(f"{missing(c, 'Unknown')} AS {c}" for c in [*KEYS, 'localisation'])},
                               {stripped_rating('note')} AS note_raw, {missing('avis', '')} AS avis_raw,
                               {missing('date_avis', '')} AS date_avis_raw, created_at FROM raw)
                  WHERE {VALID}))""",
    "variant_dedup": dedup("variant", "avis_normalized"),
    "normalized": f"""
      SELECT * EXCLUDE (duplicate_rank, similar_rank), {BANK} AS banque_normalized, {CITY} AS ville_normalized,
             CASE WHEN note_numeric >= 4 THEN 'Excellent' WHEN note_numeric >= 3 THEN 'Bon' WHEN note_numeric >= 2 THEN 'Moyen'
                  WHEN note_numeric >= 1 THEN 'Mauvais' ELSE 'Non noté' END AS note_category,
             strftime(date_avis_parsed, '%Y-%m') AS review_period
      FROM variant_dedup WHERE should_keep""",
    "tagged": f"SELECT *, topic AS topic_name, {CATEGORY} AS topic_category FROM mart",
    "bank_year": "SELECT banque AS bank_name, review_year, 1 AS fact_rows FROM dated",
}


def year_report(source: str) -> str:
    total = "sum(nombre_avis) OVER (PARTITION BY banque)"
    return f"""
      SELECT banque, year, nombre_avis, CAST(total AS BIGINT) AS total_avis_banque, {ratio('total', '7', 1)} AS moyenne_annuelle_banque,
             {pct('nombre_avis', 'total')} AS pourcentage_annee,
             rank() OVER (PARTITION BY banque ORDER BY nombre_avis DESC) AS rang_annee_banque
      FROM (SELECT banque, year, nombre_avis, {total} AS total
            FROM (SELECT g.banque, g.year, CAST(coalesce(sum(fact_rows), 0) AS BIGINT) AS nombre_avis
                  FROM (SELECT DISTINCT bank_name AS banque, unnest(range(2019, 2026)) AS year FROM {source}) g
                  LEFT JOIN {source} c ON c.bank_name = g.banque AND c.review_year = g.year
                  GROUP BY ALL))"""


CTES["years"] = year_report("bank_year")
NAMES = list(CTES)


def with_models(sql: str) -> str:
    """Put the models a statement needs in front of it."""
    needed, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in NAMES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    ctes = ", ".join(f"{n} AS ({CTES[n]})" for n in NAMES if n in needed)
    return f"WITH {ctes} {sql}" if ctes else sql


POS, NEG, NEU = (f"count(*) FILTER (sentiment = '{s}')" for s in ("Positif", "Negatif", "Neutre"))
NOTE_MEAN = ratio("CAST(sum(note * 10) AS BIGINT)", "count(*) * 10", 2)


def leader(col: str, out: str) -> str:
    return f"""(SELECT topic_name, count(*) AS nombre_{out}s, arg_min(v, (-n, v)) AS {out}_principale, max(n) AS {out}_principale_count
               FROM (SELECT topic_name, {col} AS v, count(*) AS n FROM tagged GROUP BY ALL) GROUP BY topic_name)"""


def star_count(n: int) -> str:
    return f"count(*) FILTER (floor(note + 0.5) = {n})"


def levels(c: str, table, lowest: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} >= {b} THEN {lit(v)}" for b, v in table) + f" ELSE {lit(lowest)} END"


# A copy of the published French list of our own, so that a change on the other side shows.
FUNCTION_WORDS = {"fr": Path(__file__).with_name("french_stop_words.txt").read_text(encoding="utf-8").split(), "ar": rules.FUNCTION_WORDS["ar"]}


def words(step: str, columns: str = "id") -> str:
    def frame(lang: str) -> str:
        stop = arr(FUNCTION_WORDS[lang] + rules.DOMAIN_STOP_WORDS[lang])
        done = stemmed(step.removesuffix(STEMS), lang) if step.endswith(STEMS) else step
        done = done.replace("@STOP", stop)
        return f"SELECT {columns}, array_to_string({done}, ' ') AS words FROM corpus WHERE langue = '{lang}'"

    return " UNION ALL ".join(map(frame, ("fr", "ar")))


PREPARED = (
    "trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\p{{Nd}}+', '', 'g'), '\\s+', ' ', 'g'), ' ')"
)
TOKENS = f"string_split({PREPARED.format(c='avis')}, ' ')"
WORDY = "length(w) > 2 AND regexp_matches(w, '^\\p{L}+\\z')"
NOT_STOP = "NOT list_contains(@STOP, w)"
STEMS = "@STEMS"


def stemmed(words_: str, lang: str) -> str:
    """Every round of the stemmer as a list_transform around the one before."""
    for step in rules.STEM_ROUNDS[lang]:
        whens = ""
        for region, endings, instead in step:
            stem = rules.STEM_REGIONS[region]
            pattern, new = (f"^(?:{endings})({stem})\\z", f"{instead}\\1") if region == "front" else (f"^({stem})(?:{endings})\\z", f"\\1{instead}")
            whens += f" WHEN regexp_matches(w, {lit(pattern)}) THEN regexp_replace(w, {lit(pattern)}, {lit(new)})"
        words_ = f"list_transform({words_}, lambda w: CASE{whens} ELSE w END)"
    return words_


DEDUP_COLUMNS = "is_exact_duplicate, is_similar_duplicate, keep_confidence_score, should_keep"
NA = f"{', '.join(lit(t) for t in rules.MISSING_TOKENS)}"
RAW_COLUMNS = ["banque", "ville", "nom_agence", "localisation", "note", "avis", "date_avis"]
CSV_NAMES = ["Banque", "Ville", "Nom Agence", "Localisation", "Note", "Avis", "Date Avis"]
PAGE = (
    "SELECT page_id, {nom} AS nom, {loc} AS localisation, {note} AS note FROM pages"
).format(
    nom="coalesce(nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1), ' '), ''), 'Nom inconnu')",
    loc="coalesce(nullif(trim(regexp_extract(url, '^https?://[^/]+/([a-z][a-z])/', 1), ' '), ''), 'Localisation inconnue')",
    note="coalesce(nullif(trim(regexp_extract(url, 'page=([0-5])', 1), ' '), ''), '0')",
)
LINKS = (
    "(SELECT page_id, regexp_extract(html, 'lang=\"([a-z]*)\"', 1) AS lang, "
    "unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS url FROM pages)"
)


def check(name: str, failing: str) -> str:
    return (
        f"SELECT {lit(name)} AS check_name, count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status"
        f" FROM ({failing}) AS failing"
    )


def fresh(table: str, name: str, col: str) -> str:
    age = f"(epoch({STAMP}) - epoch(max({col})))"
    return (
        f"SELECT max({col}) AS newest, CAST(floor({age} / 3600) AS BIGINT) AS age_hours, "
        f"CASE WHEN {age} > 604800 THEN 'error' WHEN {age} > 86400 THEN 'warn' ELSE 'pass' END AS status, "
        f"{lit(name)} AS table_name FROM {table}"
    )


def top(col: str, k: int = 5) -> str:
    return f"SELECT {col}, count(*) AS n FROM raw WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY n DESC, {col} LIMIT {k}"


BANK_TOPIC = f"""
  SELECT * FROM (
    SELECT banque, topic_category, topic_name, count(*) AS nombre_avis, {NOTE_MEAN} AS note_moyenne,
           CASE WHEN count(*) > 1 THEN floor(sqrt(CAST(CAST(count(*) AS HUGEINT) * sum(CAST(note * 10 AS BIGINT) * CAST(note * 10 AS BIGINT))
             - CAST(sum(note * 10) AS HUGEINT) * CAST(sum(note * 10) AS HUGEINT) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * (count(*) - 1))) * 10 + 0.5) / 100 END AS note_ecart_type, {POS} AS sentiment_positif, {NEG} AS sentiment_negatif,
           {NEU} AS sentiment_neutre, {ratio('sum(length(avis))', 'count(*)', 2)} AS longueur_moyenne_avis,
           {pct(POS, 'count(*)')} AS taux_satisfaction, {pct(NEG, 'count(*)')} AS taux_insatisfaction
    FROM tagged GROUP BY banque, topic_category, topic_name) AS g"""

STATEMENTS = {
    "bank_sentiment": f"""
      SELECT banque, count(*) AS reviews, {POS} AS positive, {NEG} AS negative, {pct(POS, 'count(*)')} AS satisfaction
      FROM (SELECT {BANK} AS banque, {sentiment('avis_cleaned')} AS sentiment FROM kept) GROUP BY banque""",
    "stg_raw_reviews": "SELECT * FROM stg",
    "missing_value_default": f"SELECT id, {missing('nom_agence', 'Unknown')} AS nom_agence, {missing('ville', 'Unknown')} AS ville FROM raw",
    "null_profile": "SELECT count(*) AS total_rows, "
    + ", ".join(f"count(*) - count({c}) AS {c}_nulls" for c in RAW_COLUMNS) + " FROM raw",
    "top_banks": top("banque"),
    "top_cities": top("ville"),
    "review_sample": "SELECT id, banque, ville, left(avis, 50) AS avis_extrait FROM raw ORDER BY id LIMIT 3",
    "flatten_reviews": "SELECT doc_id, banque, ville, nom_agence, localisation, pos, line AS avis FROM raw",
    "page_defaults": PAGE,
    "crawl_grid": f"SELECT banque, unnest({arr(rules.CRAWLED_CITIES)}) AS ville FROM "
    "(SELECT DISTINCT trim(banque, ' ') AS banque FROM raw WHERE trim(banque, ' ') <> '')",
    "unseen_links": f"""
      SELECT url, min(page_id) AS page_id, arg_min(lang, page_id) AS lang FROM {LINKS} AS l
      WHERE lang <> 'fr' AND url NOT IN (SELECT url FROM {LINKS} AS s WHERE lang = 'fr') GROUP BY url""",
    "csv_reviews_scan": "SELECT " + ", ".join(f"CASE WHEN {c} NOT IN ({NA}) THEN {c} END AS {c}" for c in RAW_COLUMNS) + " FROM raw",
    "csv_reviews_sink": "SELECT " + ", ".join(f"nullif({c}, '') AS \"{n}\"" for c, n in zip(RAW_COLUMNS, CSV_NAMES)) + " FROM raw",
    "raw_full_refresh": """
      SELECT count(*) AS total_rows, count(*) AS ids, 1 AS first_id, count(*) AS last_id,
             CAST(sum(length(avis)) AS BIGINT) AS characters, TIMESTAMP '2025-06-29 12:00:00' AS created_at FROM raw""",
    "partitioned_fact": "SELECT review_id, bank_key, location_key, review_date, review_year, rating FROM fact WHERE review_year = 2024",
    "fact_lookup": """
      SELECT asked, review_id, bank_key, location_key, review_date, review_year, rating
      FROM fact, (VALUES ('place'), ('bank and place')) AS kinds(asked)
      WHERE location_key IN (SELECT DISTINCT location_key FROM fact WHERE review_year = 2025 AND bank_key = 9 AND location_key > 0 ORDER BY location_key LIMIT 3)
        AND (asked = 'place' OR review_year = 2025 AND bank_key = 9)""",
    "csv_profile": "SELECT count(*) AS total_rows, "
    + ", ".join(f"count(*) FILTER ({c} IS NULL OR {c} IN ({NA})) AS {c}_nulls" for c in RAW_COLUMNS) + " FROM raw",
    "branch_estimates": """SELECT banque, count(DISTINCT nom_agence) AS nom_agence, count(DISTINCT localisation) AS localisation,
      TRUE AS nom_agence_close, TRUE AS localisation_close FROM mart GROUP BY banque""",
    "report_csv": BANK_TOPIC,
    "clean_text": f"SELECT id, {clean('avis')} AS avis_cleaned FROM raw",
    "normalize_text": f"SELECT id, {normalize('avis')} AS avis_normalized FROM raw",
    "detect_language": f"SELECT id, {language('avis')} AS langue FROM raw",
    "detect_arabic": "SELECT id, CASE WHEN regexp_matches(avis, '[\\x{0600}-\\x{06FF}]') THEN 'Arabe' ELSE 'Français' END AS langue FROM raw",
    "parse_rating": f"SELECT id, CAST({rating('note')} AS DOUBLE) AS note FROM raw",
    "strip_rating": f"SELECT id, {stripped_rating('note')} AS note FROM raw",
    "text_quality": "SELECT id, text_quality_score FROM cleaned",
    "length_bin": "SELECT id, text_length_category FROM cleaned",
    "int_reviews_cleaned": "SELECT * REPLACE (CAST(note_numeric AS DOUBLE) AS note_numeric) FROM cleaned",
    "format_date_dmy": f"SELECT id, coalesce({dmy('date_avis')}, 'Date inconnue') AS date_avis FROM raw",
    "parse_date_basic": f"SELECT id, {basic_date('date_avis')} AS date_avis FROM raw",
    "date_parts": f"""
      SELECT id, date_avis, review_date, CAST(year(coalesce(review_date, {AS_OF})) AS BIGINT) AS review_year,
             CAST(month(coalesce(review_date, {AS_OF})) AS BIGINT) AS review_month
      FROM (SELECT id, date_avis, {LABEL_DATE} AS review_date
            FROM (SELECT id, coalesce({dmy('date_avis')}, 'Date inconnue') AS date_avis FROM raw))""",
    "review_period": f"SELECT id, strftime({basic_date('date_avis')}, '%Y-%m') AS review_period FROM raw",
    "content_hash": "SELECT id, md5(banque || ville || nom_agence || avis_cleaned) AS content_hash FROM cleaned",
    "exact_duplicates": "SELECT id, duplicate_rank FROM dedup",
    "similar_duplicates": "SELECT id, similar_rank FROM dedup",
    "dedup_decision": f"SELECT id, {DEDUP_COLUMNS} FROM dedup",
    "int_reviews_deduplicated": "SELECT * REPLACE (CAST(note_numeric AS DOUBLE) AS note_numeric) FROM dedup",
    "kept_reviews": "SELECT id, banque, ville, nom_agence, avis_cleaned FROM kept",
    "attach_topic_names": f"SELECT k.id, banque, coalesce(topic_name, {lit(rules.DEFAULT_TOPIC)}) AS topic FROM kept k LEFT JOIN topics t ON k.id = t.id",
    "topic_scalar_lookup": "SELECT id, (SELECT min(topic_name) FROM topics t WHERE t.id = k.id) AS topic_name FROM kept k",
    "normalize_bank": f"SELECT id, {BANK} AS banque FROM stg",
    "normalize_city": f"SELECT id, {CITY} AS ville FROM stg",
    "sentiment": f"SELECT id, {sentiment('avis_cleaned')} AS sentiment FROM cleaned",
    "sentiment_raw_text": f"SELECT id, {sentiment('avis')} AS sentiment FROM raw",
    "mart_reviews_enriched": "SELECT * REPLACE (CAST(note AS DOUBLE) AS note) FROM mart",
    "dim_bank": "SELECT * FROM bank",
    "dim_branch": "SELECT * FROM branch",
    "dim_location": "SELECT * EXCLUDE (address) FROM place",
    "dim_topic": "SELECT * FROM subject",
    "dim_sentiment": f"""
      SELECT CAST(sentiment_key AS BIGINT) AS sentiment_key, f.sentiment, score_range, description, {STAMP} AS created_at,
             coalesce(n, 0) AS reviews
      FROM feeling f LEFT JOIN (SELECT sentiment, count(*) AS n FROM mart GROUP BY sentiment) m ON f.sentiment = m.sentiment""",
    "fact_reviews": "SELECT * FROM fact",
    "fact_fanout": "SELECT * FROM fanout",
    "staging_variant": "SELECT * REPLACE (CAST(note_numeric AS DOUBLE) AS note_numeric) FROM variant",
    "reviews_normalized": "SELECT * REPLACE (CAST(note_numeric AS DOUBLE) AS note_numeric) FROM normalized",
    "reviews_clean": f"""
      SELECT id, content_hash, c.banque, c.ville, nom_agence, localisation, avis_original, avis_cleaned, avis_normalized,
             langue_detected AS langue, CAST(note_numeric AS DOUBLE) AS note, note_category, avis_length_original,
             avis_length_cleaned, text_length_category, text_quality_score, date_avis_parsed AS date_avis, review_period,
             created_at, text_quality_score >= 0.8 AS is_high_quality, langue_detected IN ('fr','ar') AS is_valid_language,
             note_numeric > 0 AS has_rating, {STAMP} AS processed_at, total_reviews_in_city, avg_rating_in_city,
             positive_reviews_in_city
      FROM (SELECT * EXCLUDE (banque, ville), banque_normalized AS banque, ville_normalized AS ville FROM normalized) c
      LEFT JOIN (SELECT banque_normalized AS banque, ville_normalized AS ville, count(*) AS total_reviews_in_city,
                        CAST(sum(note_numeric) AS DOUBLE) / count(note_numeric) AS avg_rating_in_city,
                        count(*) FILTER (note_numeric >= 4) AS positive_reviews_in_city
                 FROM normalized GROUP BY ALL) s ON c.banque = s.banque AND c.ville = s.ville""",
    "banks_performance": f"""
      SELECT *, row_number() OVER (PARTITION BY city ORDER BY avg_composite_score DESC, bank_name, city) AS city_rank,
             row_number() OVER (ORDER BY avg_composite_score DESC, bank_name, city) AS global_rank, {STAMP} AS calculated_at
      FROM (SELECT bank_name, city, count(*) AS total_reviews, count(DISTINCT nom_agence) AS total_agencies,
                   CAST(sum(rating) AS DOUBLE) / count(*) AS avg_rating,
                   CAST(sum(composite_score) AS DOUBLE) / count(*) AS avg_composite_score,
                   {POS} AS positive_reviews, {NEG} AS negative_reviews, {NEU} AS neutral_reviews,
                   {pct(POS, 'count(*)')} AS positive_percentage, {pct(NEG, 'count(*)')} AS negative_percentage,
                   min(review_date) AS first_review_date, max(review_date) AS last_review_date,
                   count(*) FILTER (language = 'fr') AS french_reviews, count(*) FILTER (language = 'ar') AS arabic_reviews
            FROM scored GROUP BY bank_name, city)""",
    "topic_analysis": """
      SELECT a.* EXCLUDE (tenths), overall_positive_rate AS topic_benchmark FROM analysis a
      LEFT JOIN summary s ON a.topic_category = s.topic_category""",
    "topic_summary": "SELECT * FROM summary",
    "topic_corpus": "SELECT * FROM corpus",
    "mart_sorted_table": "SELECT id, banque, CAST(note AS DOUBLE) AS note, sentiment, topic FROM mart",
    "report_bank_topic": BANK_TOPIC,
    "report_topic_distribution": f"""
      SELECT * EXCLUDE (best), CASE WHEN best < {rules.DOMINANT_SHARE} THEN 'Mixte' WHEN sentiment_positif_pct = best THEN 'Positif'
                     WHEN sentiment_negatif_pct = best THEN 'Negatif' ELSE 'Neutre' END AS sentiment_dominant
      FROM (SELECT *, greatest(sentiment_positif_pct, sentiment_negatif_pct, sentiment_neutre_pct) AS best,
                   {levels('note_moyenne', rules.PERFORMANCE_LEVELS, rules.LOW_PERFORMANCE)} AS performance_level,
                   {levels('pourcentage_total', rules.POPULARITY_LEVELS, rules.LOW_POPULARITY)} AS popularite_level
            FROM (SELECT t.*, nombre_banques, banque_principale, banque_principale_count, nombre_villes, ville_principale,
                         ville_principale_count, row_number() OVER (ORDER BY nombre_avis DESC, t.topic_name) AS rang_popularite,
                         {pct('nombre_avis', 'sum(nombre_avis) OVER ()')} AS pourcentage_total,
                         {pct('banque_principale_count', 'nombre_avis')} AS banque_principale_pct,
                         {pct('ville_principale_count', 'nombre_avis')} AS ville_principale_pct
                  FROM (SELECT topic_name, topic_category, count(*) AS nombre_avis, {NOTE_MEAN} AS note_moyenne,
                               {POS} AS sentiment_positif_count, {NEG} AS sentiment_negatif_count, {NEU} AS sentiment_neutre_count,
                               {pct(POS, 'count(*)')} AS sentiment_positif_pct, {pct(NEG, 'count(*)')} AS sentiment_negatif_pct,
                               {pct(NEU, 'count(*)')} AS sentiment_neutre_pct,
                               {', '.join(f'{star_count(n)} AS note_{n}_count, {pct(star_count(n), "count(*)")} AS note_{n}_pct' for n in (5, 4, 3, 2, 1))},
                               {ratio('sum(length(avis))', 'count(*)', 0)} AS longueur_moyenne_avis
                        FROM tagged GROUP BY topic_name, topic_category) t
                  JOIN {leader('banque', 'banque')} lb ON t.topic_name = lb.topic_name
                  JOIN {leader('ville', 'ville')} lv ON t.topic_name = lv.topic_name))""",
    "report_topic_detail": f"""
      SELECT t.*, banques_mentionnant, exemples_avis_positifs, exemples_avis_negatifs
      FROM (SELECT topic_name, topic_category, count(*) AS total_avis, {NOTE_MEAN} AS note_moyenne, {POS} AS sentiment_positif_count,
                   {NEG} AS sentiment_negatif_count, {NEU} AS sentiment_neutre_count, {pct(POS, 'count(*)')} AS taux_positif
            FROM tagged GROUP BY topic_name, topic_category) t
      JOIN (SELECT topic_name, string_agg(banque, ', ' ORDER BY banque) AS banques_mentionnant
            FROM (SELECT DISTINCT topic_name, banque FROM tagged) GROUP BY topic_name) b ON t.topic_name = b.topic_name
      LEFT JOIN (SELECT topic_name, string_agg(avis, ' | ' ORDER BY id) FILTER (sentiment = 'Positif') AS exemples_avis_positifs,
                        string_agg(avis, ' | ' ORDER BY id) FILTER (sentiment = 'Negatif') AS exemples_avis_negatifs
                 FROM (SELECT *, row_number() OVER (PARTITION BY topic_name, sentiment ORDER BY id) AS rn
                       FROM tagged WHERE sentiment <> 'Neutre') WHERE rn <= 2 GROUP BY topic_name) e ON t.topic_name = e.topic_name""",
    "report_category_insights": f"""
      SELECT t.topic_category AS categorie, nombre_total_avis, note_moyenne_categorie, taux_positif_categorie, meilleure_banque,
             note_meilleure_banque, pire_banque, note_pire_banque, topics_inclus
      FROM (SELECT topic_category, count(*) AS nombre_total_avis, {NOTE_MEAN} AS note_moyenne_categorie,
                   {pct(POS, 'count(*)')} AS taux_positif_categorie FROM tagged GROUP BY topic_category) t
      JOIN (SELECT topic_category, arg_min(banque, (-m, banque)) AS meilleure_banque, max(m) AS note_meilleure_banque,
                   arg_min(banque, (m, banque)) AS pire_banque, min(m) AS note_pire_banque
            FROM (SELECT topic_category, banque, {NOTE_MEAN} AS m FROM tagged GROUP BY ALL) GROUP BY topic_category) x
        ON t.topic_category = x.topic_category
      JOIN (SELECT topic_category, string_agg(topic_name, ', ' ORDER BY topic_name) AS topics_inclus
            FROM (SELECT DISTINCT topic_category, topic_name FROM tagged) GROUP BY topic_category) n
        ON t.topic_category = n.topic_category""",
    "report_bank_year": "SELECT * FROM years",
    "report_bank_year_fanout": year_report("fanout"),
    "report_bank_summary": f"""
      SELECT banque, total AS total_avis_2019_2025, {ratio('total', '7', 1)} AS moyenne_annuelle, annees_actives, meilleure_annee,
             meilleur_score, pire_annee, pire_score, meilleur_score - pire_score AS ecart_max_min,
             CASE WHEN slope > 0 THEN 'Croissante' WHEN slope < 0 THEN 'Décroissante' ELSE 'Stable' END AS tendance_generale,
             CASE WHEN squares > 2 * total * total THEN 'Variable' WHEN 4 * squares > 5 * total * total THEN 'Modérée' ELSE 'Régulière' END AS regularite,
             row_number() OVER (ORDER BY total DESC, banque) AS rang_volume_total
      FROM (SELECT banque, CAST(sum(nombre_avis) AS BIGINT) AS total, count(*) FILTER (nombre_avis > 0) AS annees_actives,
                   arg_max(year, (nombre_avis, -year)) AS meilleure_annee, max(nombre_avis) AS meilleur_score,
                   arg_min(year, (nombre_avis, year)) AS pire_annee, min(nombre_avis) AS pire_score,
                   sum(nombre_avis * (year - 2022)) AS slope, 7 * sum(CAST(nombre_avis AS HUGEINT) * nombre_avis) AS squares
            FROM years GROUP BY banque)""",
    "report_bank_year_pivot": "SELECT \"index\", "
    + ", ".join(f'CAST("{y}" AS DOUBLE) AS "{y}"' for y in range(2019, 2026))
    + f', CAST("TOTAL" AS DOUBLE) AS "TOTAL", {ratio(chr(34) + "TOTAL" + chr(34), "7", 1)} AS "MOYENNE" FROM ('
    + " UNION ALL ".join(
        f"SELECT {key} AS \"index\", " + ", ".join(f'sum(nombre_avis) FILTER (year = {y}) AS "{y}"' for y in range(2019, 2026))
        + f', sum(nombre_avis) AS "TOTAL" FROM years {group}'
        for key, group in (("banque", "GROUP BY banque"), ("'TOTAL_TOUTES_BANQUES'", ""))
    ) + ") AS p",
    "prep_text": f"SELECT id, {PREPARED.format(c='avis')} AS prepared FROM raw",
    "tokens": words(f"list_filter({TOKENS}, lambda w: {WORDY})"),
    "stopwords": words(f"list_filter({TOKENS}, lambda w: {NOT_STOP})"),
    "stems": words(f"list_filter({TOKENS}, lambda w: {WORDY} AND {NOT_STOP}){STEMS}"),
    "eligible_languages": "SELECT langue, count(*) AS n FROM corpus WHERE langue IN ('fr', 'ar') GROUP BY langue HAVING count(*) >= 20",
    "topic_vocabulary": "SELECT term, documents, occurrences, langue FROM vocab",
    "topic_vectors": """
      SELECT id, langue, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight
      FROM (SELECT t.id, t.langue, t.term, t.n * (ln((1 + total) / (1 + documents)) + 1) AS w
            FROM counted t JOIN vocab v ON t.langue = v.langue AND t.term = v.term JOIN sized s ON t.langue = s.langue)""",
    "topic_names_of_terms": f"""
      SELECT topic_id, langue, coalesce(arg_min(label, place) FILTER (label IS NOT NULL),
             CASE langue WHEN 'fr' THEN 'Topic' ELSE 'موضوع' END || ' ' || (topic_id + 1) || ': ' || string_agg(term, ', ' ORDER BY place) FILTER (place < 3)) AS topic_name
      FROM (SELECT langue, term, (place - 1) // 5 AS topic_id, (place - 1) % 5 AS place, {first_match('lower(term)', rules.TOPIC_KEYWORDS, 'NULL')} AS label
            FROM vocab WHERE place <= 40) GROUP BY topic_id, langue""",
    "topic_model_checks": """
      SELECT langue, total AS documents, total AS assigned, 0 AS unknown_ids, 0 AS bad_topics, 0 AS bad_probabilities, 0 AS unnamed, 8 AS names
      FROM sized""",
    "mart_lda_checks": """
      SELECT count(*) AS mart_rows, count(*) FILTER (t.id IS NULL) AS without_topic, 0 AS wrong_default, 0 AS unnamed, 0 AS dimension_gaps,
             (SELECT count(*) FROM (SELECT id FROM topics UNION SELECT id FROM prepared)) AS topic_rows
      FROM mart m LEFT JOIN (SELECT id FROM topics UNION SELECT id FROM prepared) t ON m.id = t.id""",
    "topic_sizes_keyword": "SELECT langue, topic_id, topic_name, count(*) AS n FROM topics t JOIN corpus c ON t.id = c.id GROUP BY ALL",
    "topic_upsert": """
      SELECT id, topic_id, topic_name, CAST(topic_probability AS DOUBLE) AS topic_probability FROM topics
      WHERE id NOT IN (SELECT doc_id * 2147483648 + 1 FROM labels)
      UNION ALL SELECT doc_id * 2147483648 + 1, quality, 'Service client', 0.5::DOUBLE FROM labels""",
    "check_unique": check("unique id", "SELECT id FROM raw GROUP BY id HAVING count(*) > 1"),
    "check_not_null": " UNION ALL ".join(check(f"not null {c}", f"SELECT 1 FROM raw WHERE {c} IS NULL") for c in ("id", "banque", "avis")),
    "check_accepted_values": f"SELECT banque, count(*) AS n FROM mart WHERE NOT {is_in('banque', rules.ACCEPTED_BANKS)} GROUP BY banque",
    "check_expression": check("note between 0 and 5", "SELECT 1 FROM cleaned WHERE NOT (note_numeric BETWEEN 0 AND 5)")
    + " UNION ALL " + check("quality between 0 and 1", "SELECT 1 FROM cleaned WHERE NOT (text_quality_score BETWEEN 0 AND 1)"),
    "check_unique_combination": "SELECT banque, ville, nom_agence, avis_cleaned, count(*) AS n FROM cleaned GROUP BY ALL HAVING count(*) > 1",
    "check_freshness": fresh("raw", "raw_reviews", "created_at") + " UNION ALL " + fresh("events", "events", "ts"),
    "load_verification": "SELECT item, n, 'profile' AS section FROM (SELECT unnest(["
    + ", ".join([lit("total_rows"), *[lit(f"{c}_nulls") for c in RAW_COLUMNS]]) + "]) AS item, unnest(["
    + ", ".join(["count(*)", *[f"count(*) - count({c})" for c in RAW_COLUMNS]]) + "]) AS n FROM raw)"
    + "".join(f" UNION ALL SELECT {c}, n, '{c}' FROM ({top(c)})" for c in ("banque", "ville"))
    + " UNION ALL SELECT avis_extrait, id, 'sample' FROM (SELECT id, left(avis, 50) AS avis_extrait FROM raw ORDER BY id LIMIT 3)",
    "union_all": "SELECT id, banque, 'staged' AS origin FROM stg UNION ALL SELECT id, banque, 'kept' FROM kept",
    "preview_reviews": "SELECT id, banque, ville, note_raw FROM stg ORDER BY id LIMIT 5",
    "drop_similar": "SELECT id, is_similar_duplicate, should_keep AND NOT is_similar_duplicate AS should_keep FROM dedup",
    "parse_rating_comma": f"SELECT id, CAST({rating("replace(note, ',', '.')")} AS DOUBLE) AS note FROM raw",
    "sentiment_whole_words": f"SELECT id, {sentiment_whole('avis_cleaned')} AS sentiment FROM cleaned",
    "format_date_exact": f"SELECT id, coalesce({dmy_exact('date_avis')}, 'Date inconnue') AS date_avis FROM raw",
    "keyword_topics_folded": f"""
      SELECT id, {TOPIC_ID} AS topic_id, topic_name FROM (SELECT id, {folded('avis')} AS topic_name FROM corpus WHERE langue IN ('fr', 'ar'))
      WHERE topic_name IS NOT NULL""",
    "csv_mixed_encodings": " UNION ALL ".join(
        "SELECT " + ", ".join(f"CASE WHEN {c} NOT IN ({NA}) THEN {c} END AS {c}" for c in RAW_COLUMNS) + f" FROM {t}" for t in ("raw", "latin", "marked")
    ),
    "csv_skipped_rows": "SELECT count(*) AS loaded, (SELECT count(*) FROM documents) AS skipped FROM raw",
    "sql_functions": f"""
      SELECT id, avis_cleaned AS cleaned, {normalize('avis_original')} AS normalized, {language('avis_original')} AS langue,
             {missing('nom_agence', 'Unknown')} AS nom_agence, {sentiment('avis_cleaned')} AS sentiment,
             {dmy('date_avis_raw')} AS date_avis, (SELECT min(topic_name) FROM topics t WHERE t.id = k.id) AS topic FROM kept k""",
}

PAIRS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
CTES["marked"] = "SELECT * REPLACE (avis || chr(65533) AS avis) FROM raw"
CTES["latin"] = "SELECT * FROM raw WHERE NOT regexp_matches(coalesce(avis, ''), '[^\\x{00}-\\x{FF}]')"
# Languages behind both size gates.
CTES["prepared"] = (
    f"SELECT id, langue, string_split(words, ' ') AS w FROM ({words(f'list_filter({TOKENS}, lambda w: {WORDY} AND {NOT_STOP}){STEMS}', 'id, langue')}) "
    "WHERE length(words) > 5 AND langue IN (SELECT langue FROM corpus GROUP BY langue HAVING count(*) >= 20)"
)
CTES["sized"] = "SELECT langue, count(*) AS total FROM prepared GROUP BY langue HAVING count(*) >= 10"
CTES["counted"] = f"SELECT id, langue, term, count(*) AS n FROM (SELECT id, langue, unnest(list_concat(w, {PAIRS})) AS term FROM prepared) GROUP BY ALL"
CTES["vocab"] = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY langue ORDER BY occurrences DESC, term) AS place
                 FROM (SELECT c.langue, term, count(*) AS documents, CAST(sum(n) AS BIGINT) AS occurrences
                       FROM counted c JOIN sized s ON c.langue = s.langue GROUP BY c.langue, term, total
                       HAVING count(*) >= 2 AND count(*) <= 0.8 * total)) WHERE place <= 1000"""
NAMES = list(CTES)

ORACLE = {name: with_models(sql) for name, sql in STATEMENTS.items()}
