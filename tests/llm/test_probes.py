"""Inputs that once gave wrong results or ended a task."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import tokencount
from tripflow.llm.substring import substring_dedup
from tripflow.llm.text import Words, texts_of
from tripflow.llm.tokencount import token_counts
from tripflow.llm.urls import candidates, intervals, judge, shapes

SCHEMA = "doc_id long, text string"


def colliding(n=8292, low=7, high=13):
    """Two texts that differ in words swapped at sums of powers of two: with any odd base, their
    polynomials modulo 2**64 are equal."""
    words = [f"w{i}" for i in range(n)]
    one, two = list(words), list(words)
    for mask in range(1 << (high - low)):
        place = sum(1 << (low + k) for k in range(high - low) if mask >> k & 1)
        odd = bin(mask).count("1") % 2
        one[place], two[place] = ("even", "odd") if odd else ("odd", "even")
    return one, two


def uncovered(first, second, span=50):
    """Words of `second` that lie in no window of `first`."""
    seen = {tuple(first[i : i + span]) for i in range(len(first) - span + 1)}
    gone = np.zeros(len(second), dtype=bool)
    for i in range(len(second) - span + 1):
        if tuple(second[i : i + span]) in seen:
            gone[i : i + span] = True
    return [w for w, g in zip(second, gone) if not g]


def test_texts_whose_polynomials_collide(spark):
    one, two = colliding()
    docs = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(two))], SCHEMA)
    kept = {r["doc_id"]: r["kept_text"].split() for r in substring_dedup(docs).collect()}
    assert kept[1] == one
    assert kept[2] == uncovered(one, two) and len(kept[2]) >= 64


def test_digests_follow_the_words_only():
    import pyarrow as pa

    texts = ["a bc", " a\n\tbc ", "ab c", "", "  ", "abc", "a", "a bc d", None, "a bc"]
    _, data, offsets = next(texts_of(pa.array(texts)))
    found = Words(data, offsets).digests()
    words = [tuple((t or "").split()) for t in texts]
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            assert (found[i] == found[j]) == (x == y)


@pytest.mark.parametrize("sign", [" ", "\n", "a", "1", "!", "　"])
def test_ten_megabytes_of_one_sign(spark, sign):
    text = sign * (10_000_000 // len(sign.encode()))
    docs = spark.createDataFrame([(1, f"x{text}y"), (2, text)], SCHEMA)
    whole = lambda raw: np.array([len(raw)])  # noqa: E731  one section
    counts = token_counts(docs, sections=whole).collect()
    assert len(counts) == 2 and all(r["n_tokens"] > 0 for r in counts)
    assert {r["end"] for r in counts} == {len(text.encode()) + 2, len(text.encode())}


def test_sizes_of_tokens_spell_the_text():
    encoding, sizes = tokencount._encoder(tokencount.VOCABULARY)
    text = "It's   a\n\n test of ÄÖÜ 漢字 🙂 1234567"
    tokens = encoding.encode_ordinary(text)
    assert sizes[tokens].sum() == len(text.encode())


def test_a_source_without_weight_is_named(spark):
    from pyspark.errors import PySparkException

    from tripflow.llm.mixing import mix_sources, source_weights

    docs = spark.createDataFrame([(i, "t", "ab"[i % 2]) for i in range(20)], f"{SCHEMA}, source string")
    weights = source_weights(docs.where("source = 'a'"))
    with pytest.raises(PySparkException, match="no weight for source b"):
        mix_sources(docs, weights).collect()
    assert mix_sources(docs, source_weights(docs)).count() == 20


def test_a_sieve_loses_nothing_that_is_wanted(spark, monkeypatch):
    from tripflow.llm import rows

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)] + [(None, None)], SCHEMA)
    keys = rows.keyed(docs)
    wanted = keys.where("ord % 10 = 0 OR text = ''").select(*rows.KEY)
    for bits in (1 << 24, 1 << 10):
        monkeypatch.setattr(rows, "SIEVE_BITS", bits)
        passed = rows.sieved(keys, wanted)
        assert passed.join(wanted, rows.KEY).count() == 301
        assert passed.count() < (310 if bits > 5000 else 3001)
    assert rows.sieved(keys, wanted.limit(0)).count() == 0


def test_urls_of_very_many_parts(spark):
    """A URL of 10 MB and hosts of thousands of labels; the list decides how much is asked for."""
    parts, labels = 100_000, 3_000
    long = "http://a.b.example.com/" + "/".join(f"p{i % 7}" for i in range(parts)) + "/" + "x" * 9_000_000
    wide = "http://" + ".".join(["l"] * labels) + ".bad.org/en/x"
    deep = "example.com/" + "/".join(f"p{i % 7}" for i in range(300))
    listed = [(deep, "deep"), ("example.com/p0", "top"), ("bad.org/en", "org"), ("b.example.com/q", "no")]
    actions = spark.createDataFrame(
        [(e, c, "add", "2024-01-01 00:00:00") for e, c in listed],
        "entry string, category string, action string, at string",
    ).withColumn("at", F.to_timestamp("at"))
    urls = [(1, long), (2, wide), (3, "http://example.com/p0/p1"), (4, "http://bad.org/")]
    captures = spark.createDataFrame(
        [(i, u, "2024-01-02 00:00:00") for i, u in urls], "page_id long, url string, fetched_at string"
    ).withColumn("fetched_at", F.to_timestamp("fetched_at"))
    assert shapes(intervals(actions)) == ([2, 3], [1, 300])
    began = time.monotonic()
    found = {r.page_id: r.categories for r in judge(captures, actions).collect()}
    assert found == {1: ["deep", "top"], 2: ["org"], 3: ["top"], 4: []}
    assert time.monotonic() - began < 60


def test_asking_by_shape_loses_no_entry(spark):
    urls = ["http://a.b.c.d/1/2/3/4", "http://x.y", "https://c.d/1//2", "http://.d/1", None]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    every = [set(r.entries) for r in candidates(rows).collect()]
    listed = spark.createDataFrame([("c.d/1/2",), ("d",), ("b.c.d/1/2/3/4",), ("y",)], "entry string")
    some = [set(r.entries) for r in candidates(rows, "url", *shapes(listed)).collect()]
    wanted = {r.entry for r in listed.collect()}
    assert [e & wanted for e in every] == [e & wanted for e in some]
    assert all(s <= e for e, s in zip(every, some)) and sum(map(len, some)) < sum(map(len, every))
