"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Texts are folded first: lower case, accents off, letters of other scripts that look like Latin ones,
and digits or signs inside words that stand for letters ("1d10t", "$tup1d"); numbers stay numbers
and part words ("2013", "10 000"). Lexicon terms are words or beginnings of words. One automaton
finds all terms and exception phrases in a single pass over a text; a hit inside an exception phrase
does not count, and a word counts with its heaviest term. The sum of weights is normalised by the
length of the text, and a logistic curve makes a score of it.

Weights are log odds of a term's presence in toxic against other documents; every term with support
is kept. Exceptions are pairs of adjacent words, one of them a hit, that as large a share of the
other documents holds as of the toxic ones. All this and the curve are learnt from a bounded sample
of labelled rows, which bounds the lexicon; scoring reads every text whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.labelled import SAMPLE, training_rows
from tripflow.llm.rows import doc_id, keyed, prepare
from tripflow.session import durable

# Letters of other scripts by the Latin letter that they look like, and digits by the letter they
# stand for. Fixed values.
LOOK = "асеорхуіѕјԁһкмтвνορτυιɑɡ"
LIKE = "aceopxyisjdhkmtbvoptuiag"
DIGITS = "0134578"
LETTERS = "oieastb"
SIGNS = {"@": "a", "$": "s", "!": "i"}
#: Terms to begin with, where labels teach nothing. Fixed values.
SEEDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting")
#: Phrases in which a term is harmless, besides those learnt. Fixed values.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser award", "not stupid")
#: Fewest toxic documents of the sample that must hold a term, and fewest others that must hold an
#: exception.
SUPPORT = 8
#: Least log odds of a term.
WEIGHT = 1.5
#: Letters of beginnings of words that are terms.
SHORTEST, LONGEST = 4, 8

_SIGN = re.compile(r"(?<=[a-z])!(?=[a-z])|[@$](?=[a-z])")
_OTHER = re.compile(r"[^a-z]+")
_DIGIT = re.compile("[0-9]")
_NUMBER = re.compile(r"(?<![a-z0-9@$])[0-9]+(?![a-z0-9@$])")


def _folding() -> dict[int, str]:
    table = {ord(a): b for a, b in zip(LOOK, LIKE)}
    for code in range(0xC0, 0x250):
        plain = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if plain.isascii() and plain.isalpha():
            table[code] = plain
    return table | {0xDF: "ss", 0xE6: "ae", 0xF8: "o"}


_FOLD = _folding()
_FOLD_DIGITS = str.maketrans(DIGITS, LETTERS)


def fold(text: str) -> str:
    """Words of a to z, each with one space before it, and one space at the end."""
    text = text.lower().translate(_FOLD)
    if _DIGIT.search(text):
        text = _NUMBER.sub(" ", text).translate(_FOLD_DIGITS)
    if "@" in text or "$" in text or "!" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return " " + _OTHER.sub(" ", text).strip(" ") + " "


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 2.0, 0.2, 0.4]))

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (len(term) + 1, weight))
        for phrase in self.exceptions:
            found.add_word(fold(phrase), (len(fold(phrase)), None))
        found.make_automaton()
        return found

    def hits(self, automaton, folded: str) -> dict[int, float]:
        """Heaviest term of each word that has one outside exceptions, by the place before it."""
        heaviest: dict[int, float] = {}
        harmless = []
        if len(automaton):
            for end, (size, weight) in automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    harmless.append((start, end))
                elif weight > heaviest.get(start, 0):
                    heaviest[start] = weight
        for first, last in harmless:
            for start in [s for s in heaviest if first <= s < last]:
                heaviest.pop(start, None)
        return heaviest

    def features(self, automaton, text: str) -> tuple[float, float, float]:
        """Heaviest term, weight by length of the text, weight of all terms (in logarithm)."""
        folded = fold(text)
        heaviest = self.hits(automaton, folded)
        total = sum(heaviest.values())
        words = max(1, folded.count(" ") - 1)
        top = max(heaviest.values(), default=0.0)
        return top, 10 * total / (words + 20), float(np.log1p(total))

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.curve[0] + features @ self.curve[1:]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _terms(text: str) -> set[str]:
    out = set()
    for word in set(fold(text).split()):
        out.add(word)
        for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
            out.add(word[:n])
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method; the ridge keeps it finite where the classes are apart."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _pairs(lexicon: Lexicon, automaton, text: str) -> set[str]:
    """Pairs of adjacent words of which one is a hit."""
    folded = fold(text)
    out = set()
    for start in lexicon.hits(automaton, folded):
        end = folded.index(" ", start + 1)
        if start:
            out.add(folded[folded.rindex(" ", 0, start) + 1 : end])
        if end + 1 < len(folded):
            out.add(folded[start + 1 : folded.index(" ", end + 1)])
    return out


def _counted(rows: DataFrame, parts: Callable[[], Callable[[str], set[str]]]) -> DataFrame:
    """term, bad, good: toxic and other documents of `rows` that hold each part of a text.

    `parts` gives, once in each task, the function that takes a text apart.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = parts()
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                (bad if label == 1 else good).update(apart(text))
            names = list(bad | good)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([bad[n] for n in names], pa.int64()),
                    pa.array([good[n] for n in names], pa.int64()),
                ],
                names=["term", "bad", "good"],
            )

    counts = rows.mapInArrow(count, "term string, bad long, good long").groupBy("term")
    return counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon, its exceptions and its curve from at most `sample` labelled rows.

    Terms and pairs of words are counted by Spark, and those with support come to the driver: their
    number is bounded by the words of the sample over SUPPORT. With too few labels the seeds remain,
    all of one weight.
    """
    prepare(docs.sparkSession)
    rows = durable(training_rows(docs, labels, "toxic", sample), "training")
    totals = rows.groupBy("label").count().collect()
    toxic = sum(r["count"] for r in totals if r["label"] == 1)
    other = sum(r["count"] for r in totals if r["label"] != 1)
    seeds = Lexicon({term: 3.0 for term in SEEDS})
    if toxic < SUPPORT or other < SUPPORT:
        return seeds

    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (other + 1))
    counts = _counted(rows, lambda: _terms).where(F.col("bad") >= SUPPORT).withColumn("weight", odds)
    found = counts.where(F.col("weight") > WEIGHT).select("term", "weight").collect()
    lexicon = Lexicon(dict(sorted((r["term"], r["weight"]) for r in found)) or seeds.weights)

    def pairs() -> Callable[[str], set[str]]:
        automaton = lexicon.automaton()
        return lambda text: _pairs(lexicon, automaton, text)

    harmless = _counted(rows, pairs).where(F.col("good") >= SUPPORT).where(odds <= 0)
    lexicon.exceptions = tuple(sorted({*EXCEPTIONS, *(r["term"] for r in harmless.collect())}))
    known = _scored(rows.select("label", "text"), lexicon, ["label"], "label int")
    # `sample` rows of three numbers.
    table = known.select("label", "features").toPandas()
    # Rows come in no fixed order; the curve is fitted in one.
    x = np.array(table["features"].tolist(), dtype=float)
    y = (table["label"] == 1).to_numpy(dtype=float)
    order = np.lexsort((y, *x.T))
    lexicon.curve = _logistic(x[order], y[order])
    return lexicon


def _scored(rows: DataFrame, lexicon: Lexicon, carry: list[str], schema: str) -> DataFrame:
    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.features(automaton, t) for t in batch.column("text").to_pylist()]
            x = np.array(found, dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in carry),
                    pa.array(list(x), pa.list_(pa.float64())),
                    pa.array(lexicon.score(x)),
                ],
                names=[*carry, "features", "score"],
            )

    return rows.mapInArrow(look, f"{schema}, features array<double>, score double")


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, tkey, score, features: every row's toxicity between 0 and 1.

    Empty and missing texts get the score of a text without any term.
    """
    prepare(docs.sparkSession)
    scored = _scored(keyed(docs), lexicon, ["ord", "tkey", ], "ord long, tkey int")
    return scored.select(doc_id(), "tkey", "score", "features")
