"""Language identification by cross-parsing entropy.

One suffix automaton per language holds a bounded sample of its labelled text. A document is
parsed greedily into the longest phrases that occur in the sample; the language that needs the
fewest phrases, each weighed by the bits that point into its sample, wins.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from branchvoice.llm.automaton import SuffixAutomaton
from branchvoice.llm.stages import broadcast_if_small, ship, slices, stage

#: Bounds of the sample: rows and symbols per language, symbols over all languages, characters of a row.
ROWS, SYMBOLS, ALL_SYMBOLS, ROW_CHARS = 64, 40_000, 240_000, 4_000
#: Times ROWS that are ranked per language, about.
THINNED = 8
#: Symbols: 0 for whatever is no letter or mark, one for each letter or mark of the sample, the commonest
#: first, then one for letters and one for marks outside it. Steps by symbols below DENSE lie in a table,
#: the others in a sorted list.
DENSE = 64
#: Documents are parsed in pieces of so many symbols, all pieces of a batch side by side.
PIECE = 1024
UNKNOWN = "und"
#: A text is explained by a language with so many phrases, and beyond them so many times the phrases a letter
#: of the labelled row that takes most of them, or so many phrases a letter if that is less.
FREE, TIMES, LEAST_RATE = 16, 1.5, 0.36


def labelled_sample(docs: DataFrame, learn: Column) -> list:
    """Rows (lang, text) to learn from: at most ROWS different texts per language, in hash order; long ones give a window.

    Hashes are thinned to some hundreds per language before they are ranked, so that no task gets
    more of a language than that, however large the corpus.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    hashes = stage(rows.select("lang", F.xxhash64("text").alias("h")).distinct(), "language-hashes")
    counts = stage(hashes.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    draw = F.shiftrightunsigned(F.xxhash64("h", F.lit(1)), 11) / F.lit(float(1 << 53))
    drawn = hashes.join(broadcast_if_small(counts, 64), "lang").where(draw * F.col("n") < THINNED * ROWS)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = stage(drawn.withColumn("rank", rank).where(F.col("rank") <= ROWS).select("lang", "h"), "language-sample")
    size = F.length("text")
    start = F.when(size > ROW_CHARS, F.pmod(F.xxhash64("text"), size - ROW_CHARS)).otherwise(0).cast("int") + 1
    window = rows.withColumn("h", F.xxhash64("text")).join(broadcast_if_small(chosen, 64), ["lang", "h"])
    window = window.groupBy("lang", "h").agg(F.min(F.substring("text", start, F.lit(ROW_CHARS))).alias("text"))
    return window.orderBy("lang", "h").collect()


@cache
def _kinds() -> np.ndarray:
    """By code point: 1 for letters, 2 for combining marks (vowel signs, tone marks, accents), 0 for others."""
    kinds = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.int8, 0x110000)
    kinds[[c for c in range(0x300, 0x110000) if unicodedata.category(chr(c))[0] == "M"]] = 2
    return kinds


@cache
def _lowered() -> tuple[np.ndarray, np.ndarray]:
    """Code points with another code point as lower case, and those."""
    pairs = [(c, ord(low)) for c in range(0x20000) if len(low := chr(c).lower()) == 1 and ord(low) != c]
    return tuple(np.array(pairs).T)


def _texts(sample: Iterable) -> dict[str, list[str]]:
    """Texts of a sample by language."""
    texts: dict[str, list[str]] = {}
    for row in sample:
        texts.setdefault(row["lang"], []).append(row["text"])
    return texts


def _share(languages: int) -> int:
    """Symbols that each of so many languages learns at most."""
    return min(SYMBOLS, ALL_SYMBOLS // max(1, languages))


class Parser:
    """Automata of all languages as lists of their steps; the table of the steps by common symbols is made where texts are parsed.

    `most` bounds the symbols of a language. The automata are built one after the other, so that the
    objects of one alone are in memory. The table takes 256 bytes a state, the lists about 12: the
    driver makes no table of all languages and sends none.
    """

    def __init__(self, sample: list, most: int | None = None) -> None:
        #: Phrases a letter that explain a text, by language; None: every text with a letter is explained.
        self.bounds: dict[str, float] | None = None
        texts = _texts(sample)
        self.languages = sorted(texts)
        counts: dict[str, int] = {}
        for own in texts.values():
            for c, n in Counter("".join(own)).items():
                c = c.lower() if len(c.lower()) == 1 else c
                if c.isalpha() or unicodedata.category(c)[0] == "M":
                    counts[c] = counts.get(c, 0) + n
        self.letters = sorted(counts, key=lambda c: (-counts[c], c))
        self.alphabet = len(self.letters) + 3
        self.roots, self.bits, self.states = [], [], 0
        common, rare = [], []
        most = _share(len(self.languages)) if most is None else most
        for language in self.languages:
            state, symbol, to, states, size = self._grown(texts[language], most)
            state, to, dense = state + self.states, to + self.states, symbol < DENSE
            common.append((state[dense] * DENSE + symbol[dense], to[dense]))
            rare.append((state[~dense] * self.alphabet + symbol[~dense], to[~dense]))
            self.roots.append(self.states)
            self.bits.append(np.log2(max(2, size)))
            self.states += states
        empty = np.zeros(0, np.int64)
        #: Steps by symbols below DENSE: their cells in the table, and the states they lead to.
        self.cells = np.concatenate([empty, *(k for k, _ in common)]).astype(np.int32)
        self.ends = np.concatenate([empty, *(t for _, t in common)]).astype(np.int32)
        keys, goals = np.concatenate([empty, *(k for k, _ in rare)]), np.concatenate([empty, *(t for _, t in rare)])
        order = np.argsort(keys)
        # A key and goal above all others end the list.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.goals = np.append(goals[order], 0).astype(np.int32)

    def _grown(self, texts: list[str], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
        """Steps of a language's automaton (state, symbol, next state), its states and the symbols it holds."""
        automaton, size = SuffixAutomaton(), 0
        for text in texts:
            symbols, _ = self.symbols([text])
            automaton.add(symbols[: most - size].tolist())
            size = min(most, size + len(symbols))
            if size == most:
                break
        state = np.repeat(np.arange(len(automaton.next)), [len(edges) for edges in automaton.next])
        # Steps over the end of a text are no steps of the language.
        symbol = np.fromiter((s if isinstance(s, int) else -1 for edges in automaton.next for s in edges), np.int64, len(state))
        to = np.fromiter((t for edges in automaton.next for t in edges.values()), np.int64, len(state))
        inside = symbol >= 0
        return state[inside], symbol[inside], to[inside], len(automaton.next), size

    def _steps(self) -> np.ndarray:
        """State by state and symbol below DENSE, where the step leads; made once per process.

        A step that starts a new phrase is stored as the complement of the state it leads to.
        """
        if not hasattr(self, "_table"):
            table = np.empty(self.states * DENSE, np.int32)
            state = self.cells // DENSE  # in ascending order
            for root, end in zip(self.roots, [*self.roots[1:], self.states]):
                start = np.full(DENSE, root, np.int32)
                own = slice(*np.searchsorted(state, [root, root + 1]))
                start[self.cells[own] - root * DENSE] = self.ends[own]
                table[root * DENSE : end * DENSE].reshape(-1, DENSE)[:] = ~start
            table[self.cells] = self.ends
            self._table = table
        return self._table

    def _codes(self) -> np.ndarray:
        if not hasattr(self, "_symbol_of"):
            of = np.array([0, self.alphabet - 2, self.alphabet - 1], np.int32)[_kinds()]
            of[[ord(c) for c in self.letters]] = np.arange(1, len(self.letters) + 1)
            upper, lower = _lowered()
            of[upper] = of[lower]
            self._symbol_of = of
        return self._symbol_of

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_symbol_of", "_table")}

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, runs of 0 made one, and where each text starts."""
        of = self._codes()
        symbols = of[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = np.cumsum([0] + [len(t) for t in texts])
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0)
        keep[starts[:-1][starts[:-1] < len(symbols)]] = True
        return symbols[keep], np.concatenate([[0], np.cumsum(keep)])[starts]

    def _is_letter(self) -> np.ndarray:
        """Which symbols are letters: neither 0 nor marks."""
        return np.array([False, *(c.isalpha() for c in self.letters), True, False])

    def _rare(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Steps by symbols outside the table; as there, the complement where a new phrase starts."""
        key = state.astype(np.int64) * self.alphabet + symbol[:, None]
        at = np.searchsorted(self.keys, key)
        inside = self.keys[at] == key
        roots = np.array(self.roots, np.int32)
        key = roots.astype(np.int64) * self.alphabet + symbol[:, None]
        again = np.searchsorted(self.keys, key)
        restart = np.where(self.keys[again] == key, self.goals[again], roots)
        return np.where(inside, self.goals[at], ~restart)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by text and language, and letters by text."""
        symbols, starts = self.symbols(texts)
        table = self._steps()
        n, kinds = len(texts), len(self.languages)
        letters = np.diff(np.concatenate([[0], np.cumsum(self._is_letter()[symbols])])[starts])
        sizes = np.diff(starts)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(n), pieces)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + at * PIECE
        length = np.minimum(PIECE, starts[owner + 1] - begin)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        found = np.zeros((len(owner), kinds), np.int32)
        state = np.tile(np.array(self.roots, np.int32), (len(owner), 1))
        alive = np.searchsorted(-length, -np.arange(PIECE), side="left")
        for step in range(int(length.max(initial=0))):
            k = alive[step]
            symbol = symbols[begin[:k] + step]
            to = table[state[:k] * DENSE + np.minimum(symbol, DENSE - 1)[:, None]]
            rare = np.flatnonzero(symbol >= DENSE)
            if len(rare):
                to[rare] = self._rare(state[rare], symbol[rare])
            sign = to >> 31
            found[:k] -= sign
            state[:k] = to ^ sign
        total = np.zeros((n, kinds), np.int64)
        np.add.at(total, owner, found)
        return total, letters


def bounds(sample: list) -> dict[str, float]:
    """Phrases a letter, beyond FREE, that explain a text, by language.

    Each half of a language's labelled rows is parsed against the other half, which is less than the
    whole sample knows, and the worst row counts. No bound where a language has no two rows with letters.
    """
    halves = sample[::2], sample[1::2]
    worst: dict[str, float] = {}
    for own, other in (halves, halves[::-1]):
        known, texts = {row["lang"] for row in own}, _texts(other)
        for language in sorted(known & texts.keys()):
            # The automaton of one language at a time: a letter it lacks ends a phrase, whether other languages have it or not.
            parser = Parser([row for row in own if row["lang"] == language], _share(len(known)))
            phrases, letters = parser.phrases(texts[language])
            for n, m in zip(phrases[:, 0].tolist(), letters.tolist()):
                if m:
                    worst[language] = max(worst.get(language, LEAST_RATE), TIMES * (n / m))
    return worst


def _identified(parser):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parser.value
        kinds = len(known.languages)
        for batch in slices("text", 4 << 20)(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if kinds:
                phrases, letters = known.phrases(texts)
                cost = (phrases + 1) * np.array(known.bits)
                rank = np.sort(cost, axis=1)
                lead = 1 - rank[:, 0] / rank[:, 1] if kinds > 1 else np.ones(len(texts))
                chosen = cost.argmin(1)
                some = letters > 0
                if known.bounds is not None:
                    bound = np.array([known.bounds.get(k, np.inf) for k in known.languages])
                    some &= phrases[np.arange(len(texts)), chosen] <= FREE + bound[chosen] * letters
                names = [known.languages[k] if s else UNKNOWN for k, s in zip(chosen, some)]
                scores = np.where(some, lead, 0.0)
            rest = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.string()), pa.array(scores)], names=[*batch.schema.names, "lang_pred", "score"])

    return run


def held_out() -> Column:
    """Documents that are not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _predicted(docs: DataFrame, rows: DataFrame, learn: Column | None, explained: bool = False) -> DataFrame:
    """`rows` (with a column text) and their lang_pred and score, learned from `docs`; `und` if not `explained`, when asked for."""
    learn = ~held_out() if learn is None else learn
    sample = labelled_sample(docs, learn)
    own = Parser(sample)
    if explained:
        own.bounds = bounds(sample)
    ship(docs.sparkSession)
    parser = docs.sparkSession.sparkContext.broadcast(own)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(_identified(parser), T.StructType([*rows.schema.fields, *added]))


def identified(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """Per document: doc_id, lang_pred, score (how far the best language is ahead of the next, 0 to 1).

    Languages and their phrases come from rows with a non-null lang where `learn` holds (default:
    not held out): up to 64 rows of a language, chosen by hash, 4,000 characters of a row, 40,000 symbols
    of a language and 240,000 of all, so beyond six languages each has an equal part of those. Whole
    texts are parsed, of any length, in pieces of 1,024 symbols at whose ends a phrase ends. `und` with score 0 where the text is null or has no letter, or where nothing
    could be learned; with one language known, score 1. Ties go to the first language by name.
    Predictions see the text alone. Repeated rows are predicted one by one; an empty table gives
    no rows; other columns are not read.
    """
    return _predicted(docs, docs.select("doc_id", "text"), learn).drop("text")


def in_known_language(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """The documents with a language, columns unchanged: those predicted `und` go, and those no language explains.

    The best language explains a text of few phrases, or of no more phrases a letter than its own
    labelled rows allow (see `bounds`).
    """
    # Renamed by place, so that columns of these names in the input stay what they are.
    inside = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    rows = _predicted(docs, inside, learn, explained=True)
    return rows.where(F.col("lang_pred") != UNKNOWN).drop("lang_pred", "score").toDF(*docs.columns)
