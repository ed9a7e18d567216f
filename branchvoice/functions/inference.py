"""Topics of documents under online LDA: what a task does with a batch of documents, in numpy."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Documents inferred together; their arrays stay in a core's cache.
BLOCK = 512
#: A document is settled when its topic counts change by no more than this on average, as in Spark's own LDA.
TOLERANCE = 1e-3


def _digamma_parts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """y and r with digamma(x) = log(y) + r for positive x, to about 1e-11."""
    # Six steps up the recurrence as one fraction, then the asymptotic series.
    v = x * (x + 5)
    y = x + 6
    z = 1 / y
    zz = z * z
    series = 0.5 * z + zz * (1 / 12 - zz * (1 / 120 - zz * (1 / 252 - zz * (1 / 240 - zz / 132))))
    return y, -series - (2 * x + 5) * ((3 * v + 20) * v + 24) / (v * (v + 4) * (v + 6))


def exp_expected_log(counts: np.ndarray) -> np.ndarray:
    """exp(E[log p]) of every row's Dirichlet distribution."""
    y, r = _digamma_parts(counts)
    y0, r0 = _digamma_parts(counts.sum(axis=1, keepdims=True))
    return y / y0 * np.exp(r - r0)


class Documents:
    """Term places and weights of documents, end to end; `sizes` are their numbers of terms, 0 included."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, sizes: np.ndarray):
        self.places, self.weights, self.sizes = places, weights, sizes
        self.starts = np.cumsum(sizes) - sizes

    def cells(self, some: np.ndarray) -> np.ndarray:
        sizes = self.sizes[some]
        return np.repeat(self.starts[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def topic_counts(docs: Documents, likely: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Topic counts of every document, and exp(E[log share]) of them; documents without a term keep ones.

    `likely` has a row exp(E[log p(word | topic)]) per word. A settled document stays as it is, so
    results do not depend on the documents beside it. Blocks with few unsettled documents left are
    put together.
    """
    k = likely.shape[1]
    counts = np.ones((len(docs.sizes), k))
    shares = exp_expected_log(counts)
    pending = np.flatnonzero(docs.sizes)
    while len(pending):
        blocks = np.array_split(pending, -(-len(pending) // BLOCK))
        pending = np.concatenate([_settle(docs, likely, alpha, b, counts, shares, len(blocks) == 1) for b in blocks])
    return counts, shares


def _settle(docs, likely, alpha, block, counts, shares, whole) -> np.ndarray:
    """Rounds over a block until a quarter is left, or nothing of a `whole` one; returns the unsettled documents."""
    enough = 0 if whole else len(block) // 4
    while len(block) > enough:
        cells, sizes = docs.cells(block), docs.sizes[block]
        words, weights, starts = likely[docs.places[cells]], docs.weights[cells], np.cumsum(sizes) - sizes
        old, share = counts[block], shares[block]
        settled = np.zeros(len(block), bool)
        while settled.mean() <= 0.2:
            expected = np.einsum("ij,ij->i", words, np.repeat(share, sizes, axis=0)) + 1e-100
            new = alpha + share * np.add.reduceat(words * (weights / expected)[:, None], starts, axis=0)
            share = exp_expected_log(new)
            now = ~settled & ~(np.abs(new - old).mean(axis=1) > TOLERANCE)
            counts[block[now]], shares[block[now]] = new[now], share[now]
            old, settled = new, settled | now
        block = block[~settled]
        counts[block], shares[block] = old[~settled], share[~settled]
    return block


def word_statistics(docs: Documents, likely: np.ndarray, alpha: float) -> np.ndarray:
    """What the documents add to every word and topic."""
    _, shares = topic_counts(docs, likely, alpha)
    spread = np.repeat(shares, docs.sizes, axis=0)
    ratio = docs.weights / (np.einsum("ij,ij->i", likely[docs.places], spread) + 1e-100)
    found = [np.bincount(docs.places, ratio * spread[:, t], len(likely)) for t in range(likely.shape[1])]
    return np.stack(found, axis=1) * likely


def _documents(batch: pa.RecordBatch) -> Documents:
    places, weights = batch.column("places"), batch.column("weights")
    sizes = pc.list_value_length(places).to_numpy(zero_copy_only=False)
    return Documents(places.flatten().to_numpy(), weights.flatten().to_numpy(), sizes)


def statistics_step(likely: np.ndarray, alpha: float):
    """What a task does in an update: one row, the sum over its documents for every word and topic."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros_like(likely)
        for batch in batches:
            found += word_statistics(_documents(batch), likely, alpha)
        sums = pa.ListArray.from_arrays(pa.array([0, found.size], pa.int32()), pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([sums], ["sums"])

    return step


def strongest_step(likely: np.ndarray, alpha: float):
    """What a task does to assign topics: id, first topic of the largest share, that share."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, _ = topic_counts(_documents(batch), likely, alpha)
            best = counts.argmax(axis=1)
            share = counts.max(axis=1) / counts.sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best.astype(np.int32)), pa.array(share)], ["id", "topic_id", "share"])

    return step
