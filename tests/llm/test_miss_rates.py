"""What sketches lose, by formula and on groups of copies that resemble each other."""

import numpy as np
import pytest

from tripflow.llm import near_dup
from tripflow.llm.near_dup import (
    APART_COORDINATES,
    APART_ROWS,
    BANDS,
    PERCENT,
    ROWS,
    near_duplicates,
)


def missed(similarity, rows, n_bands):
    return (1 - similarity**rows) ** n_bands


def test_bands_at_the_threshold():
    assert missed(PERCENT / 100, ROWS, BANDS) < 2e-6


@pytest.mark.parametrize(
    ("share", "most"), [(0.24, 1e-7), (0.18, 1e-3), (0.12, 0.06), (0.119, 1e-5), (0.1, 1e-3)]
)
def test_differences_at_the_threshold(share, most):
    """`share`: shingles of a difference, of those of the document."""
    t = 2 * (100 - PERCENT) / (100 + PERCENT)
    similar = (2 * share - t) / (2 * share + t)
    rows = [r for percent, r in APART_ROWS.items() if percent == 100 or 100 * share < percent]
    assert np.prod([missed(similar, r, APART_COORDINATES // r) for r in rows]) < most


def copies(m, changed, seed, words=300):
    """Copies of one text, each with words of its own in `changed` places."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for k in range(m):
        text = list(base)
        for place in rng.choice(words, changed, replace=False):
            text[place] = f"x{k}y{place}"
        texts.append(text)
    return texts


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(texts):
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= PERCENT * (len(sets[i]) + len(sets[j]) - both):
                links += 1
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(texts))], links


def found(spark, texts):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}


def test_copies_with_changes_of_their_own(spark):
    """From 0.87 down to 0.58 with each other: links of most, of some and of hardly any pairs."""
    texts, rng = [], np.random.default_rng(9)
    for changed in (2, 3, 4, 8):
        group = [[f"{changed}-{w}" for w in t] for t in copies(100, changed, changed)]
        # Some copies share their changes with one other.
        for k in range(0, 40, 4):
            group[k + 1] = list(group[k])
            group[k + 1][int(rng.integers(300))] = f"z{k}"
        texts += group
    expected, links = plain_components(texts)
    got = found(spark, texts)
    for first in range(0, 400, 100):
        same = sum(got[i] == expected[i] for i in range(first, first + 100))
        assert same >= 99
    assert links > 1000


def test_pairs_grow_with_the_copies_not_their_square(spark, monkeypatch):
    counts, real = {}, near_dup._verified

    def counted(pairs, sets, percent):
        counts["pairs"] = counts.get("pairs", 0) + pairs.count()
        return real(pairs, sets, percent)

    monkeypatch.setattr(near_dup, "_verified", counted)
    made = []
    for m in (300, 900):
        counts.clear()
        found(spark, copies(m, 8, 1))
        made.append(counts["pairs"])
    # Every pair of 900 would be 404,550.
    assert made[1] <= 20 * 900 and made[1] < 4 * made[0]


def test_an_empty_difference(spark):
    """The copy that is the common ground itself, and groups without any."""
    texts = [[f"w{i}" for i in range(300)], *copies(30, 8, 2), [f"v{i}" for i in range(300)]]
    expected, _ = plain_components(texts)
    got = found(spark, texts)
    assert [got[i] for i in range(len(texts))] == expected
