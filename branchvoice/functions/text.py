"""Text functions, all Column -> Column; plain expressions but for the stems."""

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from branchvoice.functions import rules

# Word characters are spelled out: plain \w is ASCII-only on the JVM.
DROPPED_CHARS = rf"[^\p{{L}}\p{{N}}_'{rules.ARABIC_BLOCKS}]+"
URL = r"https?://\S+"
ARABIC_CHAR = f"[{rules.ARABIC_BLOCKS}]"


def first_match(text: Column, table, default) -> Column:
    """Value of the first rule one of whose needles occurs in the text."""
    chain = F
    for needles, value in table:
        chain = chain.when(reduce(or_, (text.contains(n) for n in needles)), F.lit(value))
    return chain.otherwise(default)


def contains_any(text: Column, words) -> Column:
    """Words that contain another word of the list decide nothing and are not searched."""
    deciding = [w for w in words if not any(o in w and o != w for o in words)]
    return reduce(or_, (text.contains(w) for w in deciding))


def blank_to(c: Column, default: str) -> Column:
    """Trimmed text, or the default when nothing is left."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def handle_missing(c: Column, default: str = "") -> Column:
    """Default for NULL, blank, 'nan' and 'null'; anything else stays untrimmed."""
    missing = c.isNull() | F.trim(c).isin("", "nan", "null")
    return F.when(missing, F.lit(default)).otherwise(c)


def clean_text(c: Column) -> Column:
    """Lower case, no URLs, letters/digits/apostrophes only, single spaces.

    White space is not in the kept class, so one replacement both drops foreign
    characters and collapses the spaces around them.
    """
    low = F.lower(c)
    # The cheap test spares texts without a URL a whole regular-expression pass.
    no_urls = F.when(low.contains("http"), F.regexp_replace(low, URL, "")).otherwise(low)
    return F.trim(F.regexp_replace(no_urls, DROPPED_CHARS, " "))


def normalize_text(c: Column) -> Column:
    """clean_text plus collapsing of repeated sentence marks."""
    dots = F.regexp_replace(clean_text(c), r"\.{2,}", ".")
    bangs = F.regexp_replace(dots, "!{2,}", "!")
    return F.trim(F.regexp_replace(bangs, r"\?{2,}", "?"))


def detect_language(c: Column) -> Column:
    """'ar' above 30 % Arabic characters, 'fr' above 50 % Latin ones, else 'mixed'."""
    size = F.length(c)
    latin = size - F.length(F.translate(c, rules.FRENCH_LETTERS, ""))
    arabic = F.regexp_count(c, F.lit(ARABIC_CHAR))
    # An Arabic character takes at least one extra byte, so most Latin text is ruled out
    # by two lengths and never counted.
    wide = (F.octet_length(c) - size) * 10 > size * 3
    return (
        F.when(wide & (arabic * 10 > size * 3), "ar").when(latin * 2 > size, "fr").otherwise("mixed")
    )


def detect_arabic_any(c: Column) -> Column:
    return F.when(c.rlike(r"[\x{0600}-\x{06FF}]"), "Arabe").otherwise("Français")


def has_word(text: Column, words) -> Column:
    """One of the words, not inside a longer one."""
    edge = r"[\p{L}\p{N}_]"
    return text.rlike(f"(?<!{edge})({'|'.join(words)})(?!{edge})")


def analyze_sentiment(c: Column, whole_words: bool = False) -> Column:
    """First hit of: positive words, negative words, star patterns; else 'Neutre'.

    Words count inside longer words too, unless `whole_words`.
    """
    low, found = F.lower(c), has_word if whole_words else contains_any
    chain = F.when(found(low, rules.POSITIVE_WORDS), "Positif").when(found(low, rules.NEGATIVE_WORDS), "Negatif")
    starred = c.contains("étoile") | c.contains("/5")
    for pattern, label in rules.STAR_RULES:
        chain = chain.when(starred & c.rlike(f"(?s){pattern}"), label)
    return chain.otherwise("Neutre")


# --- preparation for the topic model -------------------------------------------

def prep_text(c: Column) -> Column:
    """Punctuation to spaces, lower case, digits deleted, single spaces."""
    words = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(words, r"\p{Nd}+", ""), r"\s+", " "))


def tokens(c: Column) -> Column:
    """Words of the prepared text."""
    return F.split(prep_text(c), " ")


def filter_tokens(words: Column) -> Column:
    """Alphabetic words of three letters or more."""
    return F.filter(words, lambda w: (F.length(w) > 2) & w.rlike(r"^\p{L}+\z"))


def stop_words(lang: str) -> list[str]:
    """Function words (Spark's French list, ours for Arabic) and words of the trade; French by default."""
    own = rules.FUNCTION_WORDS["ar"] if lang == "ar" else StopWordsRemover.loadDefaultStopWords("french")
    return [*own, *rules.DOMAIN_STOP_WORDS["ar" if lang == "ar" else "fr"]]


def drop_stopwords(words: Column, lang: str) -> Column:
    stop = stop_words(lang)
    return F.filter(words, lambda w: ~w.isin(stop))


def _stem_rule(region: str, endings: str, instead: str) -> tuple[str, str, str]:
    """Pattern of a word that has one of the endings in a region, and what is put before and behind the stem instead."""
    stem = rules.STEM_REGIONS[region]
    if region == "front":
        return rf"(?:{endings})({stem})", instead, ""
    return rf"({stem})(?:{endings})", "", instead


def _last_letters(endings: str) -> str:
    """Letters that a word with one of the endings ends in."""
    found = set()
    for ending in endings.split("|"):
        found |= {ending[-2], ending[-3]} if ending.endswith("?") else {ending[-1]}
    return "".join(sorted(found))


#: Stems that a task remembers.
KNOWN_STEMS = 200_000


def _stemmer(rounds: list[list[tuple[str, str, str, str | None]]], most: int):
    """What a task does with batches of word lists: every different word of a batch is stemmed once.

    A round takes a word's longest ending of the first rule that fits; the last letter is looked at first.
    """

    def stemmed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        steps = []
        for step in rounds:
            fits = [(re.compile(pattern).fullmatch, front, end, last) for pattern, front, end, last in step]
            letters = {letter for *_, last in fits for letter in last or ""}
            steps.append(({x: [f[:3] for f in fits if f[3] is None or x in f[3]] for x in letters}, [f[:3] for f in fits if f[3] is None]))
        known = {}

        def stem(word):
            for by_last, others in steps:
                for match, front, end in by_last.get(word[-1:], others):
                    if found := match(word):
                        word = front + found[1] + end
                        break
            return word

        def remembered(word):
            found = known.get(word)
            if found is None and word is not None:
                if len(known) >= most:
                    known.clear()
                found = known[word] = stem(word)
            return found

        for batch in batches:
            coded = batch.flatten().dictionary_encode()
            stems = pa.array([remembered(w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32))
            yield pa.ListArray.from_arrays(ends, stems, mask=batch.is_null())

    return stemmed


def stem_tokens(words: Column, lang: str) -> Column:
    """Stems: rounds of endings, each tried in its region of the word.

    Rules depend on the word alone, so they are tried on the different words of an Arrow batch and not on all words.
    """
    rounds = []
    for step in rules.STEM_ROUNDS.get(lang, rules.STEM_ROUNDS["fr"]):
        last = [None if region == "front" else _last_letters(endings) for region, endings, _ in step]
        rounds.append([(*_python_pattern(rule), ends) for rule, ends in zip(step, last)])
    # Else Spark would stem once more for a filter on the stems.
    return F.arrow_udf(_stemmer(rounds, KNOWN_STEMS), "array<string>").asNondeterministic()(words)


def _python_pattern(rule: tuple[str, str, str]) -> tuple[str, str, str]:
    """A stem rule with the letters as Python writes them."""
    pattern, front, end = _stem_rule(*rule)
    return pattern.replace(r"\p{L}", r"[^\W\d_]"), front, end


def by_language(step, c: Column, language: Column, languages: list[str]) -> Column:
    """step(c, lang) of the row's own language; a row's text is handed to no other language's step."""
    return F.coalesce(*[step(F.when(language == lang, c), lang) for lang in languages])


def topic_words(c: Column, lang: str) -> Column:
    return stem_tokens(filter_tokens(drop_stopwords(tokens(c), lang)), lang)
