"""Benchmark items too short for an edit: every exact copy is a leak."""

import numpy as np
import pytest
from test_operators import prose

from tripflow.llm.decontaminate import decontaminate, find_leaks
from tripflow.llm.rows import prepare


@pytest.mark.parametrize("words", [1, 2, 3, 4, 5])
def test_copies_of_short_items(spark, words):
    letters = np.random.default_rng(words).integers(0, 1 << 60, (400, words))
    items = [(n, " ".join(f"w{x:x}" for x in row)) for n, row in enumerate(letters.tolist())]
    rows = [(n, f"{prose(20, 500 + n)} {item.upper()} {prose(9, n)}") for n, item in items]
    # Neither a word more inside nor a word less is a copy.
    apart = [(400 + n, item[:-1]) for n, item in items] + [
        (800 + n, item.replace(" ", " zz ")) for n, item in items if words > 1
    ]
    docs = prepare(spark).createDataFrame(rows + apart, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.edits, r.start, r.end) for r in find_leaks(docs, benchmark).collect()}
    assert found == {(n, n, 0, 20, 20 + words) for n, _ in items}
    assert {r.doc_id for r in decontaminate(docs, benchmark).collect()} == {n for n, _ in apart}
