"""Phrases around one trigger: what a task holds of them, and what is written down."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tripflow.llm import parsing
from tripflow.llm.parsing import byte_dedup
from tripflow.llm.rows import prepare

PASSAGE = "the common passage that very many of the texts hold word for word, whatever stands about it "


def letters(n, seed):
    return "".join(random.Random(seed).choices("abcdefgh ", k=n))


def without_repeats(texts):
    """What is left of each text, and the number of runs that were cut out of it."""
    seen, out = set(), []
    for text in texts:
        raw = text.encode()
        keep = np.ones(len(raw), dtype=bool)
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                keep[k : k + 100] = False
            seen.add(raw[k : k + 100])
        runs = int((~keep[1:] & keep[:-1]).sum()) + int(len(keep) > 0 and not keep[0])
        out.append((np.frombuffer(raw, np.uint8)[keep].tobytes(), runs))
    return out


def common(n):
    """Texts around one passage; some share more of what stands about it."""
    return [letters(60, i % 70) + PASSAGE + letters(60, i % 90 + 500) for i in range(n)]


@pytest.mark.parametrize("group, pairwise", [(8192, 64), (8192, 3), (30, 64)])
def test_phrases_of_one_trigger_against_brute_force(spark, group, pairwise):
    texts = [*common(200), "", "ж" * 120, letters(300, 9) + "\n" + letters(300, 9)]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Equal rows are one document.
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))
    found = byte_dedup(docs, group=group, pairwise=pairwise).collect()
    assert len(found) == len(texts) + len(texts[::3])
    expected = without_repeats(texts)
    for r in found:
        assert (bytes(r.kept), len(r.removed)) == expected[r.doc_id], r.doc_id


def test_bytes_of_phrases_are_not_written_down(spark, monkeypatch):
    written, plain = {}, parsing.durable

    def durable(df, name):
        written[name] = dict(df.dtypes)
        return plain(df, name)

    monkeypatch.setattr(parsing, "durable", durable)
    texts = common(20)
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert byte_dedup(docs).count() == 20
    assert written and not [name for name, kinds in written.items() if "binary" in str(kinds)]


def test_a_task_holds_a_few_groups_at_a_time():
    """Three hundred triggers of 400 phrases, some 20 MB: a task holds some 2 MB of them."""
    read, rng = 0, np.random.default_rng(5)

    def batches():
        nonlocal read
        for trigger in range(300):
            texts = [row.tobytes() for row in rng.integers(97, 123, (350, 133), dtype=np.uint8)]
            texts += texts[:50]
            columns = {
                "ord": pa.array(range(400), pa.int64()),
                "tkey": pa.array([0] * 400, pa.int32()),
                "tsum": pa.array([0] * 400, pa.int64()),
                "trigger": pa.array([trigger] * 400, pa.int64()),
                "spread": pa.array([False] * 400),
                "begin": pa.array([0] * 400, pa.int32()),
                "count": pa.array([len(t) - 99 for t in texts], pa.int32()),
                "before": pa.array([20] * 400, pa.int32()),
                "bytes": pa.array(texts, pa.binary()),
            }
            batch = pa.RecordBatch.from_pydict(columns)
            read += batch.nbytes
            yield batch

    handed, spans = 0, []
    for found in parsing._shared(100, 16, 64)(batches()):
        assert read - handed < 4_000_000
        handed = read
        spans += zip(*(found.column(name).to_pylist() for name in ("ord", "low", "high")))
    assert read > 15_000_000 and handed == read
    assert spans == [(k, 0, 34) for _ in range(300) for k in range(350, 400)]
