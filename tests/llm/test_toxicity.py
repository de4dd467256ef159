"""Toxicity: automaton against plain search, folding, what is learnt, repeated ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import toxicity
from tripflow.llm.labelled import held_out, training_rows


def plain_features(lexicon, text):
    """Every word against every term, every exception at every place."""
    words = toxicity.fold(text).split()
    harmless = set()
    for phrase in lexicon.exceptions:
        phrase = toxicity.fold(phrase).split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i : i + len(phrase)] == phrase:
                harmless.update(range(i, i + len(phrase)))
    found = [
        max((w for term, w in lexicon.weights.items() if word.startswith(term)), default=0.0)
        for i, word in enumerate(words)
        if i not in harmless
    ]
    total = sum(found)
    return max(found, default=0.0), 10 * total / (max(1, len(words)) + 20), np.log1p(total)


def test_scores_against_plain_search(spark):
    rng = random.Random(5)
    words = ["idiot", "idiotic", "1d10t", "id", "trash", "can", "tr\u00e4sh", "2013", "a55", "$cum!", "\u0441lown",
             "fish", "clowns", "x", "not", "stupid", "st\u00fcpid.", "(loser)", "sore", "award", "10,000", "5", "@", "!"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(400)]
    texts += ["", None, " ", "idiot", "idiot " * 50_000, "trash can trash can", "trash can can", texts[0]]
    lexicon = toxicity.Lexicon(
        {"idio": 2.0, "idiot": 3.0, "trash": 1.5, "clown": 2.5, "scum": 4.0, "stupid": 3.0, "loser": 2.0, "ass": 1.0},
        (*toxicity.EXCEPTIONS, "can trash", "idiot id"),
    )
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    found = {r.doc_id: r for r in toxicity.toxicity(docs, lexicon).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        wanted = np.array(plain_features(lexicon, text or ""))
        assert np.allclose(found[i].features, wanted), text
        assert found[i].score == pytest.approx(float(lexicon.score(wanted[None, :])[0]))


def test_numbers_are_not_words():
    fold = toxicity.fold
    assert fold("2013 and 10,455 of 7") == " and of "
    assert fold("4ss a55 1d10t 5tup1d") == " ass ass idiot stupid "
    assert fold("room 101b") == " room ioib "
    assert fold("") == fold("1 2 3") == fold("?!") == "  "


def test_exceptions_are_learnt(spark):
    """A word that is toxic but for one phrase, which many clean documents hold."""
    rng = random.Random(9)
    filler = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(5)]
    rows, labels = [], []
    for i in range(1200):
        words = rng.sample(filler, 12)
        toxic = i % 3 == 0
        if toxic:
            words.insert(rng.randrange(1, 11), "blasted")
        elif i % 3 == 1 and i % 4 < 1:
            words += ["blasted", "heath"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "blasted" in lexicon.weights and "blast" in lexicon.weights
    assert "blasted heath" in lexicon.exceptions
    asked = spark.createDataFrame(
        [(1, "waa blasted wbb"), (2, "waa wbb blasted heath"), (3, "waa wbb")], "doc_id long, text string"
    )
    score = {r.doc_id: r.score for r in toxicity.toxicity(asked, lexicon).collect()}
    assert score[1] > 0.5 > 0.3 > score[2] and score[2] == pytest.approx(score[3], abs=0.05)


def test_lexicon_has_no_size_limit(spark):
    """More toxic words than any fixed number of terms: all of them count."""
    letters = "abcdefghijklmnopqrst"
    names = [f"zq{a}{b}{c}" for a in letters for b in letters[:15] for c in letters[:5]]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 2
        words = names[(i // 2 * 40) % len(names) :][:40] if toxic else ["calm", "words", "only"]
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len([n for n in names if n in lexicon.weights]) > 1000


def test_one_training_row_for_an_id(spark):
    """An id on a third of all rows, with different texts and copies of one, is one row."""
    rows = [(i, f"text {i}") for i in range(200)] + [(7, f"other {i % 20}") for i in range(100)]
    docs = spark.createDataFrame([*rows, (7, None), (None, "no id")], "doc_id long, text string")
    docs = docs.withColumn("label", F.lit("clash"))
    labels = [(i, i % 2) for i in range(200)] + [(7, 0), (None, 1), (8, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = training_rows(docs, labels, "toxic").collect()
    assert len({r.doc_id for r in found}) == len(found)
    spare = {r.doc_id for r in docs.where(held_out()).collect()}
    assert {r.doc_id for r in found} == set(range(200)) - spare
    assert {r.label for r in found if r.doc_id == 7} <= {1}
    assert found and sorted(found) == sorted(training_rows(docs.repartition(5), labels, "toxic").collect())
    assert training_rows(docs, labels, "toxic", sample=10).count() == 10
