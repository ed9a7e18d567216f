import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, label string, n int, start int"


def prose(seed: int, n: int, kind: str = "en") -> str:
    parts = {"en": ["the", "ing", "tion", "er", "ou", "th", "an"], "fr": ["eau", "oi", "ent", "que", "ai", "é", "eux"]}[kind]
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n))


def rows_of(texts):
    """Documents from (doc_id, text, lang, source), with extra columns whose names the operators use inside."""
    return [(i, t, lang, s, len(t or ""), 7, "k", "l", 3, 9) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts: spark.createDataFrame(rows_of(texts), SCHEMA)


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls in every column, empty and long texts, repeated rows and copies."""
    base = prose(1, 60)
    edited = base.split(" ")
    edited[30] = "changed"
    secret = "password=" + "3f9a" * 6
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(edited), "en", None),
        (4, None, "fr", "b"), (5, "", None, "b"), (6, " \t\n ", "en", "c"), (None, prose(2, 30), "en", "a"), (None, None, None, None),
        (7, prose(3, 40, "fr"), "fr", "b"), (8, prose(4, 40, "fr"), None, "c"), (9, prose(5, 20_000), "en", "c"),
        (10, f"{prose(6, 20)} {secret} é𝄞 {prose(7, 20)}", "en", "b"), (11, "x", "en", "c"), (12, "12 34 !!", "fr", "a"),
    ]


@pytest.fixture(scope="session")
def odd(make, odd_texts):
    return make(odd_texts)


@pytest.fixture(scope="session")
def empty(make):
    return make([])
