"""Leaks against an edit distance and a threshold written here; repetitive texts; recall of the LSH."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import decontaminate
from tripflow.llm.decontaminate import Items, find_leaks


def words_of(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def fewest_edits(item, text):
    """Plain dynamic programming over all passages of `text`."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        next_row = [i]
        for j, other in enumerate(text, 1):
            next_row.append(min(row[j - 1] + (word != other), row[j] + 1, next_row[-1] + 1))
        row = next_row
    return min(row)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        kind, place = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[place] = "changed"
        elif kind == 1:
            words.insert(place, "added")
        else:
            del words[place]
    return words


@pytest.mark.parametrize("vocabulary", [2, 6, 400])
def test_against_plain_dynamic_programming(spark, vocabulary):
    """Few words make texts that resemble themselves; every document and item is compared."""
    rng = random.Random(vocabulary)
    draw = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    sizes = (1, 2, 4, 5, 6, 7, 10, 11, 16, 25, 33)
    items = [(i, " ".join(draw(n))) for i, n in enumerate(sizes)]
    texts = ["", None, " ".join(draw(3)), " ".join(["w0"] * 150), items[-1][1]]
    for i, item in items:
        words = item.split()
        for edits in {0, (len(words) - 1) // 5, (len(words) - 1) // 5 + 1}:
            texts.append(" ".join([*draw(9), *edited(rng, words, edits), *draw(12)]))
            texts.append(" ".join(edited(rng, words, edits)))
    expected = {
        (d, i, edits)
        for d, text in enumerate(texts)
        for i, item in items
        if (edits := fewest_edits(words_of(item), words_of(text))) * 5 < len(words_of(item))
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.withColumn("item_id", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.edits) for r in find_leaks(docs, benchmark).collect()}
    assert found <= expected
    if vocabulary < 10:
        # Where words repeat, one of a passage's many windows is found as good as always.
        assert len(found) >= 0.99 * len(expected)
    assert {(d, i) for d, i, _ in expected} - {(d, i) for d, i, _ in found} == set()
    for r in find_leaks(docs, benchmark).collect():
        passage = words_of(texts[r.doc_id])[r.start : r.end]
        assert fewest_edits(words_of(items[r.item_id][1]), passage) == r.edits


def test_recall_and_saving_of_the_hashes():
    """Against verifying every placed window: at least 0.99 of leaks with most edits remain."""
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [rng.choices(vocabulary, k=rng.randrange(12, 60)) for _ in range(150)]
    texts, planted = [], set()
    for d in range(900):
        item = d % len(items)
        words = rng.choices(vocabulary, k=40) + edited(rng, items[item], (len(items[item]) - 1) // 5)
        # Pieces of other items, which place windows that are no leaks.
        for other in rng.sample(items, 6):
            at = rng.randrange(len(other) - 5)
            words += other[at : at + 5] + rng.choices(vocabulary, k=4)
        texts.append(" ".join(words))
        planted.add((d, item))
    column = pa.array(texts)
    block = Items(list(range(len(items))), [" ".join(x) for x in items], decontaminate.RECALL)
    found = {(row, item) for row, item, *_ in block.leaks(column)}

    every = Items(list(range(len(items))), [" ".join(x) for x in items], decontaminate.RECALL)
    placed, chosen = [], []

    def all_of(tokens, rows):
        windows = every._placed(decontaminate.WORDS.prefix(tokens), rows)
        placed.extend(map(tuple, windows[:, :2].tolist()))
        chosen.extend(map(tuple, block._candidates(tokens, rows)[:, :2].tolist()))
        return windows

    every._candidates = all_of
    wanted = {(row, item) for row, item, *_ in every.leaks(column)}
    assert planted <= wanted and found <= wanted
    assert len(found) >= 0.99 * len(wanted)
    # What the hashes are for: windows that hold a piece of an item, but no leak of it.
    idle, asked = (sum(pair not in wanted for pair in pairs) for pairs in (placed, chosen))
    print(f"recall {len(found) / len(wanted):.4f}; of {idle} windows without a leak {asked} are verified")
    assert idle > 100 and asked < idle


@pytest.mark.parametrize("odd", [False, True])
def test_ten_megabytes_of_one_word(spark, odd):
    """A text of five million equal words and an item of such words, with or without one other."""
    item = ["a"] * 60
    if odd:
        item[30] = "b"
    docs = spark.createDataFrame([(1, "a " * 5_000_000), (2, "a " * 47), (3, "a " * 48)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    began = time.monotonic()
    found = {(r.doc_id, r.edits) for r in find_leaks(docs, benchmark).collect()}
    assert found == ({(1, 1)} if odd else {(1, 0)})
    assert time.monotonic() - began < 90
