"""Packing: every id in one piece, windows full, related documents together."""

import zlib

import numpy as np
import pytest

from conftest import TESTDATA
from tripflow.llm import packing, queries
from tripflow.llm.packing import SHARD_TOKENS, Shard, fill, pack_documents, token_ids
from tripflow.llm.tokens import LONG

tokenizers = pytest.importorskip("tokenizers")
PLAIN = "/opt/tokenizers/byte_bpe_50k.json"
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(PLAIN)


def ids_by(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, texts, plain, window=2048):
    """`texts`: by doc_id, each once."""
    of = {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append(p)
    assert set(of) == set(texts)
    for doc, text in texts.items():
        ids, at = ids_by(plain, text), 0
        for p in sorted(of[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            raw = np.array(ids[at : at + p["length"]], dtype="<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(raw)
            at += p["length"]
        assert at == len(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return [sum(n for _, n in parts) for parts in sequences.values()]


ODD = [
    "", " ", "a", "a  b", "it's   fine\n\n\n", "ÄÖÜ ß 漢字 🙂", "<|endoftext|>", "a<|endoftext|> b",
    " " * (LONG + 7), "x" + "\n" * (LONG + 3) + "y", "x" + " " * (LONG + 3) + "y z", "\t " * LONG,
    "a" * 120_000, "7" * 70_000, "! " * 60_000,
]


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_ids_equal_the_tokenizer(plain, text):
    assert token_ids(packing.VOCABULARY, text).tolist() == ids_by(plain, text)


def test_ten_megabytes_of_blanks():
    text = "a" + " " * 10_000_000 + "b"
    # "a", all blanks but the last, " b", and the end.
    assert len(token_ids(packing.VOCABULARY, text)) == 1 + 9_999_999 + 1 + 1


def test_query_packs_whole_texts(spark, plain):
    folder = str(TESTDATA / "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    pieces = queries.op12_retrieval_packing(spark, folder).collect()
    lengths = check(pieces, {r["doc_id"]: r["text"] for r in docs}, plain)
    # One short sequence for each partition at most.
    assert sum(n < 2048 for n in lengths) <= 2
    assert sum(lengths) / (2048 * len(lengths)) > 0.99


def test_odd_rows(spark, plain):
    texts = dict(enumerate([*ODD[:10], None, "word " * 30_000]))
    pieces = pack_documents(spark.createDataFrame(list(texts.items()), SCHEMA)).collect()
    check(pieces, texts, plain)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "same text")] * 3 + [(None, "same text"), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = pack_documents(docs.selectExpr("*", "'x' AS ids", "1 AS n_tokens", "2 AS first")).collect()
    assert sorted((str(p["doc_id"]), p["length"]) for p in pieces) == [
        ("1", 3), ("1", 3), ("1", 3), ("None", 1), ("None", 3),
    ]
    assert len({(p["sequence_id"], p["offset"]) for p in pieces}) == 5


def test_no_documents(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_scores_are_bm25():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 40, rng.integers(3, 30)).astype(np.uint16) for _ in range(25)]
    idf = rng.normal(1, 1, packing.IDS)
    shard, mean = Shard(ids, idf, 11.0), 11.0
    for seed in range(25):
        for other in range(25):
            expected = 0.0
            for term in set(ids[seed].tolist()):
                tf = (ids[other] == term).sum()
                norm = packing.K1 * (1 - packing.B + packing.B * len(ids[other]) / mean)
                expected += max(idf[term], 0) * tf * (packing.K1 + 1) / (tf + norm)
            assert shard.scores(seed)[other] == pytest.approx(expected)


def test_neighbours_fill_the_window_in_order_of_score():
    rng = np.random.default_rng(4)
    topics = [np.arange(100 * k, 100 * k + 60) for k in range(4)]
    ids = [rng.choice(topics[i % 4], 20).astype(np.uint16) for i in range(80)]
    idf = np.ones(packing.IDS)
    shard = Shard(ids, idf, 20.0)
    pieces, left = fill(ids, shard, 100)
    assert len(left) <= 5
    first = [place for sequence, place, *_ in pieces if sequence == 0]
    by_score = np.lexsort((np.arange(80), -shard.scores(0)))
    assert first[1:] == [i for i in by_score if i != 0][: len(first) - 1]
    # A window holds one topic as long as the topic lasts.
    kinds = [{place % 4 for s, place, *_ in pieces if s == n} for n in range(8)]
    assert sum(len(k) == 1 for k in kinds) >= 6


def test_shards_hand_on_what_is_left(spark, plain):
    texts = {i: f"text number {i} of some words " * (i % 7 + 1) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), SCHEMA)
    pieces = pack_documents(docs, window=64, shard_tokens=500).collect()
    lengths = check(pieces, texts, plain, 64)
    assert sum(n < 64 for n in lengths) <= 1
    assert SHARD_TOKENS > 500
