import hashlib
import pickle
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchvoice.llm import decontamination, language, queries, secret_scan, substrings, token_counts, token_files
from branchvoice.llm.automaton import SuffixAutomaton

from .conftest import prose

tokenizers = pytest.importorskip("tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def same(rows, want):
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_automaton_statistics_and_owners():
    draw = random.Random(1)
    texts = [[draw.choice("ab") for _ in range(draw.randint(0, 12))] for _ in range(6)]
    automaton = SuffixAutomaton()
    for owner, t in enumerate(texts):
        automaton.add(t, owner)
    automaton.settle()
    inside = lambda part, t: any(t[k : k + len(part)] == part for k in range(len(t) - len(part) + 1))
    query = [draw.choice("abc") for _ in range(60)]
    for at, (state, length) in enumerate(automaton.matches(query)):
        longest = max(n for n in range(at + 2) if n == 0 or any(inside(query[at + 1 - n : at + 1], t) for t in texts))
        assert length == longest
        if length >= 2:
            owner = automaton.owner[automaton.ancestor(state, 2)]
            assert owner == min(o for o, t in enumerate(texts) if inside(query[at - 1 : at + 1], t))


# Repeated passages

def repeats_brute(rows, window):
    first = {}
    cut = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in cut:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in cut:
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < i:
                    gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("cuts_each", [2000, 1])
def test_repeats_against_brute_force(make, cuts_each):
    draw, rows = random.Random(8), []
    passages = [prose(900 + k, draw.randint(10, 40)).split(" ") for k in range(12)]
    for i in range(90):
        w = []
        for _ in range(draw.randint(0, 4)):
            w += prose(draw.random(), draw.randint(0, 25)).split(" ") + draw.choice(passages)[draw.randint(0, 3) :]
        rows.append((i, draw.choice([" ", "\n", "  \t"]).join(w)))
    rows += [(5, "the same id " + " ".join(passages[0] * 2)), (200, " ".join(["a"] * 60)), (201, " ".join(["a"] * 13))]
    got = substrings.without_repeats(make([(i, t, "en", "s") for i, t in rows]), cuts_each=cuts_each).collect()
    same([tuple(r) for r in got], repeats_brute(rows, 13))


def test_repeats_in_odd_documents(odd, odd_texts, empty):
    got = substrings.without_repeats(odd).collect()
    same([tuple(r) for r in got], repeats_brute([(i, t) for i, t, _, _ in odd_texts], 13))
    assert substrings.without_repeats(empty).collect() == []


# Language

def test_languages_learned_and_predicted(make, empty):
    rows = [(i, prose(i, 50, "fr" if i % 2 else "en"), "fr" if i % 2 else "en", "s") for i in range(60)]
    extra = [(100, None, "en", "s"), (101, "12 !", "en", "s"), (102, "", None, None), (None, prose(1, 30, "fr"), "xx", "s"), (103, prose(7, 30_000, "fr"), None, "s")]
    got = {r.doc_id: r for r in language.identified(make(rows + extra)).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang, _ in rows)
    assert got[103].lang_pred == "fr" and all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (100, 101, 102))
    assert language.identified(empty).collect() == []
    unlabelled = make([(1, "some text", None, "s"), (2, None, None, "s")])
    assert {r.lang_pred for r in language.identified(unlabelled).collect()} == {"und"}


def test_held_out_documents_teach_nothing(make):
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, prose(i, 40), "zz" if i in held else "en", "s") for i in range(300)]
    got = language.identified(make(rows)).collect()
    assert {r.lang_pred for r in got} == {"en"}
    flags = {r.doc_id: r.h for r in make(rows).select("doc_id", language.held_out().alias("h")).collect()}
    assert [i for i in range(300) if flags[i]] == held


def test_phrases_are_the_greedy_parse():
    parser = language.Parser([{"lang": "a", "text": "banana bandana"}, {"lang": "b", "text": "cabana"}])
    sample = {"a": "banana bandana", "b": "cabana"}
    for text in ("banana", "bandcab ana", "xyz ban", "nanana"):
        counted, _ = parser.phrases([text])
        for k, lang in enumerate(parser.languages):
            phrases, now = 0, ""
            for c in text:
                if now + c in sample[lang]:
                    now += c
                else:
                    phrases, now = phrases + 1, c if c in sample[lang] else ""
            assert counted[0, k] == phrases, (text, lang)


def test_languages_beyond_the_common_letters(make):
    # Latin and Cyrillic fill the common letters; the others differ in letters outside them, or in marks alone.
    letters = {"en": "abcdefghijklmnopqrstuvwxyz", "ru": "".join(map(chr, range(0x430, 0x450))), "el": "".join(map(chr, range(0x3B1, 0x3CA)))}
    shared = "".join(map(chr, range(0x4E00, 0x4E40)))
    letters |= {"zh-a": shared + "".join(map(chr, range(0x5000, 0x5020))), "zh-b": shared + "".join(map(chr, range(0x6000, 0x6020)))}
    syllables = {k: list(v) for k, v in letters.items()}
    syllables |= {"hi-a": [c + m for c in "कखगघ" for m in "ािी"], "hi-b": [c + m for c in "कखगघ" for m in "ुूृ"]}
    rows = []
    for at, (lang, parts) in enumerate(syllables.items()):
        draw = random.Random(at)
        vocabulary = ["".join(draw.choices(parts, k=draw.randint(2, 6))) for _ in range(60)]
        for k in range(40):
            words = draw.choices(vocabulary, k=60 if lang in ("en", "ru", "el") else 8)
            rows.append((1000 * at + k, " ".join(words), lang, "s"))
    got = {r.doc_id: r.lang_pred for r in language.identified(make(rows)).collect()}
    assert got == {i: lang for i, _, lang, _ in rows}


def test_steps_by_rare_symbols_and_case():
    wide = "".join(map(chr, range(0x4E00, 0x4E80)))
    sample = {"a": f"{wide} banana {wide[::-1]} ıſς İ", "b": f"cabana {wide[5:90]}"}
    parser = language.Parser([{"lang": k, "text": t} for k, t in sample.items()])
    for text in (wide, wide[3:50] + wide[7:60:2], f"ban {wide[80:100]} ana", "a\u9999b", "ıſς"):
        counted, letters = parser.phrases([text])
        assert letters[0] == sum(c.isalpha() for c in text)
        for k, lang in enumerate(parser.languages):
            phrases, now = 0, ""
            for c in text:
                if now + c in sample[lang]:
                    now += c
                else:
                    phrases, now = phrases + 1, c if c in sample[lang] else ""
            assert counted[0, k] == phrases, (text, lang)
    of = parser.symbols(["iIsSσΣ ıſς \u0301"])[0].tolist()
    assert of[0] == of[1] and of[2] == of[3] and of[4] == of[5] and len({*of[:6:2], *of[7:10]}) >= 4
    assert parser.phrases(["\u0301 \u0301"])[1][0] == 0


def spoken(languages, rows, size):
    """A sample as labelled rows give it: each language with letters of its own, common and rare ones."""
    draw, sample = random.Random(5), []
    for k in range(languages):
        letters = [chr(0x61 + (7 * k + i) % 26) for i in range(12)] + [chr(0x4E00 + 40 * k + i) for i in range(60)] + ["\u0301", " ", "\u0130", "A"]
        sample += [{"lang": f"l{k}", "text": "".join(draw.choices(letters, k=size))} for _ in range(rows)]
    return sample


def test_driver_holds_no_table_of_all_languages():
    sample = spoken(6, 8, 1000)
    language.Parser(sample[:2]).phrases(["a"])  # what a process makes once
    tracemalloc.start()
    try:
        parser = language.Parser(sample)
        parser.bounds = language.bounds(sample)
        peak = tracemalloc.get_traced_memory()[1]
        sent = len(pickle.dumps(parser))
        parser.phrases(["abc"])
        assert len(pickle.dumps(parser)) == pytest.approx(sent, rel=0.01)
    finally:
        tracemalloc.stop()
    table = 6 * 8 * 1000 * language.DENSE * 4  # with a state for each symbol, the fewest there can be
    assert peak < 3 * table and sent < table / 4


def test_bounds_of_one_language_are_those_among_all():
    sample = spoken(5, 6, 300) + [{"lang": "m", "text": "1 2"}, {"lang": "m", "text": "\u0301"}, {"lang": "n", "text": "alone"}]
    worst = {}
    for own, other in ((sample[::2], sample[1::2]), (sample[1::2], sample[::2])):
        parser = language.Parser(own)
        phrases, letters = parser.phrases([row["text"] for row in other])
        for row, n, m in zip(other, phrases, letters):
            if row["lang"] in parser.languages and m:
                rate = n[parser.languages.index(row["lang"])] / m
                worst[row["lang"]] = max(worst.get(row["lang"], language.LEAST_RATE), language.TIMES * rate)
    assert language.bounds(sample) == worst and len(worst) == 5


def test_unlearned_languages_go(make):
    rows = [(i, prose(i, 150, "fr" if i % 2 else "en"), "fr" if i % 2 else "en", "s") for i in range(60)]
    draw = random.Random(1)
    gibberish = " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(100))
    rows += [(100, gibberish, None, "s"), (101, "все люди рождаются свободными и равными " * 5, None, "s"), (102, "короткий", None, "s"), (103, prose(900, 20_000), None, "s")]
    kept = [r.doc_id for r in language.in_known_language(make(rows)).collect()]
    assert sorted(kept) == [*range(60), 102, 103]
    assert {r.doc_id: r.lang_pred for r in language.identified(make(rows)).collect()}[100] != "und"


def test_rejected_documents_go(odd, empty):
    kept = language.in_known_language(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, None, 7, 8, 9, 10, 11}
    assert language.in_known_language(empty).collect() == []


# Benchmark

def test_leaks_exact_edited_and_absent(make, spark):
    items = [(k, prose(5000 + k, 12 + 4 * k)) for k in range(10)] + [(20, "two words"), (21, ""), (22, None), (None, "none")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    draw, rows, want = random.Random(2), [], set()
    for i in range(60):
        w = [f"w{draw.randrange(10**6)}" for _ in range(40)]
        if i % 3 == 0:
            k = draw.randrange(10)
            item = items[k][1].split(" ")
            if i % 2:
                for at in range(4, len(item), 9):
                    item[at] = f"edit{i}"
            w[20:20] = item
            want.add((i, k))
        rows.append((i, draw.choice([" ", ", ", "\n"]).join(w).upper() if i % 5 == 0 else " ".join(w), "en", "s"))
    rows += [(70, "Here are TWO, words.", "en", "s"), (71, None, "en", "s"), (72, "", "en", "s"), (None, items[3][1], "en", "s")]
    for size in (8 << 20, 400):
        got = decontamination.contaminated(make(rows), bench, slice_bytes=size).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want | {(70, 20), (None, 3)}
        exact = next(r for r in got if r.doc_id == 0)
        assert exact.score == 1.0 and exact.start_word == 20
    kept = decontamination.decontaminated(make(rows), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in {i for i, _ in want} | {70})
    assert kept.columns == make(rows).columns


def test_no_items_or_no_documents(odd, empty, spark):
    bench = spark.createDataFrame([(1, "some words to find")], "item_id long, text string")
    assert decontamination.contaminated(empty, bench).collect() == []
    assert decontamination.contaminated(odd, bench.limit(0)).collect() == []
    assert decontamination.decontaminated(odd, bench.limit(0)).count() == odd.count()


@pytest.mark.parametrize("copies", [64, 65, 1000])
def test_widely_repeated_half_of_an_item(make, spark, copies):
    hot, unseen = [f"hot{k}" for k in range(14)], [f"unseen{k}" for k in range(16)]
    bench = spark.createDataFrame([(1, " ".join(hot + unseen))], "item_id long, text string")
    rows = [(i, " ".join([f"a{i}", *hot, f"b{i}"]), "en", "s") for i in range(copies)] + [(-1, " ".join(hot[:11]), "en", "s")]
    got = decontamination.contaminated(make(rows), bench).collect()
    assert sorted((r.doc_id, r.score, r.start_word, r.end_word) for r in got) == [(i, 14 / 30, 1, 15) for i in range(copies)]


def test_every_sufficient_alignment_is_found(make, spark):
    draw = random.Random(13)
    vocabulary = [f"v{k}" for k in range(12)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randint(1, 24)))) for k in range(12)]
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 40))), "en", "s") for i in range(150)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    number = {v: np.uint64(k) for k, v in enumerate(vocabulary)}
    codes = lambda text: np.array([number[w] for w in text.split()], np.uint64)
    want = {}
    for i, text, _, _ in rows:
        for k, item in items:
            w = item.split()
            if len(w) > 2 or f" {item} " in f" {text} ":
                score = decontamination.align(codes(item), codes(text))[0] / len(w)
                if score >= decontamination.SHARE:
                    want[i, k] = score
    got = decontamination.contaminated(make(rows), bench).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == want and len(got) == len(want) > 100


def test_copies_with_a_foreign_word_after_every_second(make, spark):
    """No three words in a row are the item's, and the alignment is 0.53 of it."""
    item = [f"w{k}" for k in range(30)]
    edited = [x for k in range(0, 30, 2) for x in (*item[k : k + 2], f"foreign{k}")]
    clash = spark.createDataFrame([(1, " ".join(item), 5, "x", 0.5)], "item_id long, text string, doc_id int, start_word string, score double")
    rows = [(i, prose(i, 30) + " " + " ".join(edited) + " " + prose(i + 50, 30), "en", "s") for i in range(20)]
    got = decontamination.contaminated(make(rows), clash).collect()
    assert sorted(r.doc_id for r in got) == list(range(20)) and all(abs(r.score - 16 / 30) < 1e-9 for r in got)
    assert decontamination.decontaminated(make(rows), clash).count() == 0


def test_alignment_scores():
    a = np.arange(10, dtype=np.uint64)
    assert decontamination.align(a, np.concatenate([[99], a, [98]]).astype(np.uint64)) == (10.0, 1, 11)
    gap = np.array([0, 1, 2, 3, 50, 4, 5, 6, 7, 8, 9], np.uint64)
    assert decontamination.align(a, gap)[0] == 9.0
    assert decontamination.align(a, np.array([77], np.uint64))[0] == 0.0


# Secrets

def spans_brute(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(out)]


def test_base_spans_against_the_patterns(make):
    draw = random.Random(6)
    parts = ["password", "PassWD", "ſecret", "toKen", "api_key", "apikey", '"', "'", " ", "  ", "=", ":", "abc", "abcdef", "A+/_.=-9", "AKIA", "AKIA" + "Z9" * 8, "0f" * 12, "0f" * 11, "é𝄞", "\n"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(400)] + ["", "secret: a:b secret=longer9"]
    df = make([(i, t, "en", "s") for i, t in enumerate(texts)] + [(1000, None, "en", "s")])
    rows = secret_scan.secrets(df).collect()
    for r in rows:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind != "random"]
        assert base == (spans_brute(texts[r.doc_id]) if r.doc_id < 1000 else [])


def test_models_add_random_strings_only(make, empty):
    draw = random.Random(4)
    hexes = lambda n: "".join(draw.choices("0123456789abcdef", k=n))
    rows = [(i, f"{prose(i, 40)} token = \"{hexes(40)}\" some_name_{i} getUserName{i} theCacheCount FromTheCache {prose(i + 500, 40)}", "en", "s") for i in range(80)]
    planted = "q7Zp4Xk9Tb2Vw8Rm5Lc3"
    rows += [(900, f"see {planted} here", "en", "s"), (901, "getUserNameFromTheCache2 theingtionertheing4 https://the.ing/tion", "en", "s")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.secrets(make(rows)).collect()}
    assert got[900] == [("random", 4, 24)] and got[901] == []
    assert all([k for k, _, _ in got[i]] == ["assign", "hex"] for i in range(80))
    assert secret_scan.secrets(empty).collect() == []


def test_random_strings_of_any_make_up(make):
    """Letters alone look random too; a secret that many documents repeat is not learned as ordinary; plain words are not found."""
    draw = random.Random(9)
    strings = ["".join(draw.choices(letters, k=k)) for letters, k in [("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 40)] * 20 + [("abcdefghijklmnopqrstuvwxyz", 32), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 24)] * 3]
    plain = ["the" * 9, "ingtionerouthaning", "-" * 40, "=" * 30, "/the/tion/ing/er/ou", "THEINGTIONEROUTHAN"]
    rows = [(i, f"{prose(i, 300)} {prose(i, 20).upper()} {' '.join(plain)} ---- ==== /ing/the", "en", "s") for i in range(60)]
    rows += [(100 + i, f"{prose(i, 10)} {v} {prose(i, 10)}", "en", "s") for i, v in enumerate(strings)] + [(200 + i, f"copy {strings[0]}", "en", "s") for i in range(150)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.secrets(make(rows)).collect()}
    for i, v in enumerate(strings):
        at = rows[60 + i][1].index(v)
        assert got[100 + i] == [("random", at, at + len(v))], v
    assert all(got[200 + i] == [("random", 5, 45)] for i in range(150)) and all(got[i] == [] for i in range(60))


def test_secrets_of_odd_documents(odd, odd_texts):
    rows = secret_scan.secrets(odd).collect()
    base = lambda r: tuple(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind != "random")
    same([(r.doc_id, base(r)) for r in rows], [(i, tuple(spans_brute(t or ""))) for i, t, _, _ in odd_texts])


def test_the_filter_before_the_random_model_lets_every_match_through(make):
    draw = random.Random(16)
    parts = ["PassWD", "toKen", "api_key", "apikey", "API-KEY", '"', " ", "=", ":", "abcdef", "AKIA", "Z9" * 8, "0f" * 12, "0f" * 11, "é"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 8))) for _ in range(300)]
    df = make([(i, t, "en", "s") for i, t in enumerate(texts)])
    passed = {r.doc_id for r in df.where(secret_scan.may_match(F.col("text"))).collect()}
    assert passed >= {i for i, t in enumerate(texts) if secret_scan.base_spans(t)} and len(passed) < 300


def test_languages_that_tie_go_by_name(make):
    rows = [(i, prose(i // 2, 60), ("zz", "aa")[i % 2], "s") for i in range(40)]
    got = language.identified(make(rows), learn=F.lit(True)).collect()
    assert {r.lang_pred for r in got} == {"aa"} and all(r.score == 0 for r in got)


# Tokens

@pytest.fixture(scope="module")
def token_texts():
    odd = ["", None, " ", "\n\n", "a  b", "a \n b\t\tc ", "x <|endoftext|> y", "a  <|endoftext|>", "<|startoftext|>b", "it's we'll 'S", "é  ü z", "\x1c a\x85b", "  lead", "trail  ", "ÅÄ ﬁ Σς", "1234 56,7", "日本 語。", "a b", "👍🏽 ok"]
    draw = random.Random(11)
    mixed = ["".join(draw.choices([" ", "  ", "\n", "\t", "ab", "the", "é", "12", "<|endoftext|>", "'s", "!", " ", "\x1f"], k=30)) for _ in range(60)]
    return odd + mixed + [prose(1, 20_000)]


def test_token_counts_and_cache(make, spark, token_texts, tmp_path):
    path = queries.tokenizer("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in token_texts]
    rows = [(i, t, "en", "s") for i, t in enumerate(token_texts)]
    rows += [(500 + i, t, "fr", None) for i, t in enumerate(token_texts[:20])] + [(None, token_texts[4], "en", "s"), (3, token_texts[3], "en", "s")]
    cache = f"{tmp_path}/cache"
    count = lambda df, **k: token_counts.token_counts(df, path, cache, normalise=token_counts.one_space, by_word=True, **k)
    got = count(make(rows), limit=5).collect()
    assert len(got) == len(rows)
    for r in got:
        i = 4 if r.doc_id is None else r.doc_id - 500 if r.doc_id >= 500 else r.doc_id
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want[i], len((token_texts[i] or "").encode()), want[i] > 5)
    stored = spark.read.parquet(cache)
    assert stored.select("digest").distinct().count() == stored.count()
    # Known contents are looked up: a count changed in the store comes back, and nothing is appended.
    n = stored.count()
    changed = f"{tmp_path}/changed"
    stored.withColumn("n_tokens", F.col("n_tokens") + 1000).write.parquet(changed)
    back = token_counts.token_counts(make(rows), path, changed, normalise=token_counts.one_space, by_word=True).collect()
    assert len(back) == len(rows) and all(r.n_tokens == want[4 if r.doc_id is None else r.doc_id - 500 if r.doc_id >= 500 else r.doc_id] + 1000 for r in back)
    assert spark.read.parquet(changed).count() == n
    new = make([(1, "brand new content", "en", "s"), (2, "a  b", "en", "s")])
    assert {r.doc_id: r.n_tokens for r in count(new).collect()} == {1: 3, 2: want[4]} and spark.read.parquet(cache).count() == n + 1
    # Without the word cache and normal form the counts are the same.
    plain = token_counts.token_counts(make(rows[:40]), path, f"{tmp_path}/plain").collect()
    assert {r.doc_id: r.n_tokens for r in plain} == {i: want[i] for i in range(40)}


def test_token_counts_of_nothing(empty, tmp_path):
    assert token_counts.token_counts(empty, queries.tokenizer("word_bpe_49k.json"), f"{tmp_path}/c").collect() == []


def test_token_files_round_trip(make, spark, token_texts, tmp_path):
    path = queries.tokenizer("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = [(i * 3 + 1, t, "en", "s") for i, t in enumerate(token_texts)] + [(None, "none", "en", "s"), (4, "again", "en", "s")]
    random.Random(1).shuffle(rows)
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_tokens(make(rows), path, folder)
    got = sorted(token_files.read_tokens(spark, folder, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got][:2] == [None, 1] and [r.doc_id for r in got][1:] == sorted(i for i, *_ in rows if i is not None)
    at, texts = 0, {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t or "")
    for r in got:
        ids = [np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4") for t in texts[r.doc_id]]
        assert r.start == at and (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(x.tobytes())) for x in ids}
        at += r.n_tokens
    assert manifest.agg(F.sum("ids")).first()[0] == at


def test_runs_share_no_encoded_chunks():
    words, bytewise = queries.tokenizer("word_bpe_49k.json"), queries.tokenizer("byte_bpe_50k.json")
    for of, kept in ((lambda run: token_files.encoder_of(run, bytewise), token_files._encoders), (lambda run: token_counts.counter_of(run, words, True), token_counts._counters)):
        first = of("first")
        assert of("first") is first and of("second") is not first and len(kept) == 1


def test_token_files_of_nothing(empty, spark, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_tokens(empty, queries.tokenizer("byte_bpe_50k.json"), folder)
    assert token_files.read_tokens(spark, folder, manifest).collect() == []


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    draw = np.random.default_rng(n)
    for high in (1, 2, 50_000, 1 << 32):
        values = draw.integers(0, high, n).astype(np.uint32)
        values[draw.random(n) < 0.05] = (1 << 32) - 1
        data = token_files.encode_file([7, None], [n, 0], values)
        ids, counts, back = token_files.decode_file(data)
        assert (back == values).all() and ids.tolist() == [7, token_files.NO_ID] and counts.tolist() == [n, 0]
    skewed = np.where(draw.random(4096) < 0.02, 49_000, draw.integers(0, 200, 4096)).astype(np.uint32)
    assert len(token_files.encode_file([1], [4096], skewed)) < 4096 * 1.35


def test_digests_of_the_queries(spark):
    rows = queries.op2_secret_scan(spark, "/root/testdata/sf0.001").collect()
    assert all(r.base_sha256 == hashlib.sha256(",".join(s for s in r.spans.split(",") if s and not s.startswith("random")).encode()).hexdigest() for r in rows)
