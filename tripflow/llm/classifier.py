"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Random indexing: every word has a fixed sparse random index vector; a word's vector is the sum of
the index vectors of the words around it, over all occurrences in the corpus. Words are told apart
by hash in a fixed number of buckets (runs of signs, and words all in capitals, have buckets of
their own), so the vectors are a matrix of known size (25 MB): each task sums those of its own
words, Spark adds them up by bucket, and scoring gets the matrix as a broadcast.

A document is the mean of its words' vectors and the length of that mean, which grows as a text
repeats itself. A two-layer network in numpy, trained on a bounded sample of labelled rows, gives
the score; its temperature is set on rows that it was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.labelled import SAMPLE, training_rows
from tripflow.llm.rows import doc_id, keyed, prepare, text_of
from tripflow.llm.text import BYTES, mix, texts_of
from tripflow.session import durable

BUCKETS = 1 << 17
#: Of these, buckets for runs of signs and for words in capitals. The latter are few, as capitals
#: tell more than which word is in them.
SIGNS, CAPITALS = 1 << 12, 16
WIDTH = 48
NONZERO = 4
#: Words to each side that count as context.
CONTEXT = 2
HIDDEN = 24
#: Vectors worked on, or given out, at once.
ROWS = 1 << 14

_KIND = np.full(256, 2, dtype=np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[128:] = _KIND[48:58] = _KIND[65:91] = _KIND[97:123] = 1
_SMALL = np.zeros(256, dtype=np.int64)
_SMALL[97:123] = 1
_LARGE = np.zeros(256, dtype=np.int64)
_LARGE[65:91] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero values of each bucket's index vector."""
    draws = mix(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64)).reshape(BUCKETS, NONZERO)
    return (draws % np.uint64(WIDTH)).astype(np.int64), np.where(draws >> np.uint64(63), 1, -1)


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token of a piece of texts, and the range of tokens of each row."""
    kind = _KIND[data]
    change = np.ones(len(data) + 1, dtype=bool)
    if len(data):
        change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    borders = np.flatnonzero(change)
    starts, ends = borders[:-1], borders[1:]
    solid = kind[starts] > 0 if len(starts) else np.zeros(0, dtype=bool)
    starts, ends = starts[solid], ends[solid]
    sign = kind[starts] == 2
    hashes = BYTES.ranges(BYTES.prefix(BYTES.letters[_LOWER[data]]), starts, ends)
    small = np.concatenate([[0], np.cumsum(_SMALL[data])])
    large = np.concatenate([[0], np.cumsum(_LARGE[data])])
    capital = (small[ends] == small[starts]) & (large[ends] - large[starts] > 1)
    words = BUCKETS - SIGNS - CAPITALS
    out = (hashes % np.uint64(words)).astype(np.int64)
    out = np.where(capital, words + SIGNS + (hashes % np.uint64(CAPITALS)).astype(np.int64), out)
    out = np.where(sign, words + (hashes % np.uint64(SIGNS)).astype(np.int64), out)
    return out, np.searchsorted(starts, offsets)


def _context_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    total = np.zeros(BUCKETS * WIDTH, dtype=np.int64)
    for batch in batches:
        for _, data, offsets in texts_of(batch.column("text")):
            tokens, rows = buckets(data, offsets)
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            for gap in range(1, CONTEXT + 1):
                near = np.flatnonzero(row[gap:] == row[:-gap])
                left, right = tokens[near], tokens[near + gap]
                for word, other in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        np.add.at(total, word * WIDTH + places[other, k], signs[other, k])
    vectors = total.reshape(BUCKETS, WIDTH)
    seen = np.flatnonzero(vectors.any(axis=1))
    for first in range(0, len(seen), ROWS):
        some = seen[first : first + ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(pa.array(vectors[some, k]) for k in range(WIDTH))],
            names=["bucket", *(f"v{k}" for k in range(WIDTH))],
        )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all buckets over the whole corpus: a matrix of fixed size."""
    prepare(docs.sparkSession)
    names = [f"v{k}" for k in range(WIDTH)]
    schema = "bucket int, " + ", ".join(f"{n} long" for n in names)
    sums = docs.select(text_of().alias("text")).mapInArrow(_context_sums, schema)
    # At most BUCKETS rows of WIDTH numbers.
    table = sums.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    out = np.zeros((BUCKETS, WIDTH), dtype=np.float32)
    place = table.column("bucket").to_numpy()
    for k, name in enumerate(names):
        out[place, k] = table.column(name).to_numpy()
    lengths = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(lengths > 0, lengths, np.float32(1))


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: mean vector, its length, how words repeat, logarithm of their number."""
    tokens, rows = buckets(data, offsets)
    n = len(rows) - 1
    sizes = np.diff(rows)
    row = np.repeat(np.arange(n), sizes)
    # Different words of each text, with their counts.
    words, counts = np.unique(row * BUCKETS + tokens, return_counts=True)
    owner, words = words // BUCKETS, words % BUCKETS
    means = np.zeros((n, WIDTH))
    for first in range(0, len(words), ROWS):
        part = slice(first, first + ROWS)
        starts = np.flatnonzero(np.diff(owner[part], prepend=-1))
        weighted = vectors[words[part]].astype(np.float64) * counts[part, None]
        means[owner[part][starts]] += np.add.reduceat(weighted, starts, axis=0)
    means /= np.maximum(1, sizes)[:, None]
    squares = np.bincount(owner, weights=counts.astype(float) ** 2, minlength=n)
    spread = np.sqrt(squares) / np.maximum(1, sizes)
    return np.column_stack([means, np.linalg.norm(means, axis=1), spread, np.log1p(sizes)])


@dataclass
class Network:
    """Two layers; inputs are standardised by the training rows."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2[:, 0] + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on the log loss; a fifth of the rows is kept for the temperature."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
    n = x.shape[1]
    layers = [
        rng.normal(0, n**-0.5, (n, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)),
        np.zeros(1),
    ]
    net = Network(mean, scale, layers)
    first = [np.zeros_like(w) for w in layers]
    second = [np.zeros_like(w) for w in layers]
    z = (x - mean) / scale
    turn = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            turn += 1
            w1, b1, w2, b2 = layers
            hidden = np.tanh(z[part] @ w1 + b1)
            p = 1 / (1 + np.exp(-np.clip(hidden @ w2[:, 0] + b2[0], -50, 50)))
            out = ((p - y[part]) / len(part))[:, None]
            back = out @ w2.T * (1 - hidden**2)
            slopes = [z[part].T @ back, back.sum(axis=0), hidden.T @ out, out.sum(axis=0)]
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * layers[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                step = first[i] / (1 - 0.9**turn) / (np.sqrt(second[i] / (1 - 0.999**turn)) + 1e-8)
                layers[i] -= 0.003 * step
    if len(held):
        logits, truth = net.logits(x[held]), y[held]

        def loss(t: float) -> float:
            return float(np.mean(np.logaddexp(0, logits / t) - truth * logits / t))

        net.temperature = min(np.geomspace(0.3, 10, 60), key=loss)
    return net


def _pooled(rows: DataFrame, vectors: np.ndarray, carry: list[str], schema: str, net: Network | None):
    shared = rows.sparkSession.sparkContext.broadcast(vectors)

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = shared.value
        for batch in batches:
            for first, data, offsets in texts_of(batch.column("text")):
                x = pooled(vectors, data, offsets)
                piece = batch.slice(first, len(offsets) - 1)
                value = pa.array(net.score(x)) if net else pa.array(list(x), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in carry), value], names=[*carry, "value"]
                )

    return rows.mapInArrow(look, f"{schema}, value " + ("double" if net else "array<double>"))


@dataclass
class Classifier:
    vectors: np.ndarray
    net: Network | None


def learn(docs: DataFrame, labels: DataFrame, name: str = "quality", sample: int = SAMPLE) -> Classifier:
    """Word vectors over all of `docs`, and a network from at most `sample` labelled rows.

    Without labels of both classes there is no network, and every score is 0.5.
    """
    vectors = word_vectors(docs)
    rows = durable(training_rows(docs, labels, name, sample), "training")
    table = _pooled(rows.select("label", "text"), vectors, ["label"], "label int", None).toPandas()
    y = (table["label"] == 1).to_numpy(dtype=float)
    if len(set(y.tolist())) < 2:
        return Classifier(vectors, None)
    x = np.array(table["value"].tolist(), dtype=float)
    # Rows come in no fixed order; training starts from one.
    order = np.lexsort(x.T)
    return Classifier(vectors, fit(x[order], y[order]))


def quality_scores(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, tkey, score: every row's probability of label 1.

    Empty and missing texts pool to zeros and are scored as such.
    """
    prepare(docs.sparkSession)
    rows = keyed(docs)
    if model.net is None:
        return rows.select(doc_id(), "tkey", F.lit(0.5).alias("score"))
    scored = _pooled(rows, model.vectors, ["ord", "tkey"], "ord long, tkey int", model.net)
    return scored.select(doc_id(), "tkey", F.col("value").alias("score"))
