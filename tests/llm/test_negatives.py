"""Hard negatives against a plain search, and on odd rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tripflow.llm import negatives, queries
from tripflow.llm.negatives import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>"
INF, NAN = float("inf"), float("nan")


def plain(rows, positives=5, negatives=5):
    """By comparing every anchor with every row."""
    rows = [
        (LAST if i is None else i, label, [int(np.floor(float(np.float32(x)) * 256)) for x in v])
        for i, label, v in rows
        if label is not None and v is not None
        and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    ]
    out = []
    anchors = {(i, label, tuple(v)) for i, label, v in rows if i % 10 == 0}
    for i, label, v in anchors:
        scored = sorted(
            ((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in rows if j != i)
        )
        same = [(-s, j) for s, j, other in scored if other == label][:positives]
        for score, j in same:
            hard = [
                (-s, k) for s, k, other in scored
                if other != label and 80 * score <= -100 * s <= 100 * score
            ]
            for rank, (s, k) in enumerate(hard[:negatives], 1):
                out.append(tuple(None if x == LAST else x for x in (i, j, rank, k, score, s)))
    return sorted(out, key=str)


LAST = (1 << 63) - 1


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, hard_negatives(table, F.col("vec_id") % 10 == 0, **options).collect()), key=str)


def vectors(n, seed, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    return [
        (i, int(rng.integers(3)), (centres[rng.integers(4)] + rng.normal(size=width) / 3).tolist())
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_search(spark, seed):
    rows = vectors(400, seed)
    expected = plain(rows)
    assert found(spark, rows) == expected and expected


def test_many_slices_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PART_BYTES", 2000)
    rows = vectors(300, 3)
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        *vectors(60, 4),
        (None, 1, [1.0] * 6),
        (100, None, [1.0] * 6),
        (110, 1, None),
        (120, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
        (130, 1, [NAN] * 6),
        (140, 1, [INF] * 6),
        (150, 1, [0.0] * 6),
        (160, 1, []),
        (170, 1, [0.5, 0.5]),
        (180, 1, [3e38] * 6),  # too long for a LONG score
        (61, 2, [0.25] * 6),
        (61, 2, [0.25] * 6),
        (70, 2, [0.25] * 6),
        (70, 2, [0.25] * 6),
    ]
    assert found(spark, rows) == plain([r for r in rows if r[0] != 180])


def test_ties_go_by_id(spark):
    rows = [(i, i % 2, [1.0, 1.0]) for i in range(60)]
    assert found(spark, rows) == plain(rows)


def test_a_common_vector_and_large_components(spark):
    big = [(i, i % 3, [40000.0 * (1 + i % 7), -30000.0 * (i % 5)]) for i in range(80)]
    assert found(spark, big) == plain(big)


def test_nothing_to_find(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert found(spark, [(10, 1, [1.0]), (2, 2, [1.0])]) == []


def test_columns_with_clashing_names(spark):
    rows = vectors(60, 5)
    table = spark.createDataFrame(rows, SCHEMA).withColumns(
        {name: F.lit("x") for name in ("a", "ord", "v", "slice", "block", "score", "rank", "p")}
    )
    got = hard_negatives(table, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_query_at_other_scales(spark):
    folder = str(TESTDATA / "sf0.1")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    names = sorted(["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
    got = queries.op11_hard_negatives(spark, folder).select(*names).collect()
    sql = f"SELECT {', '.join(names)} FROM ({queries.SQL['op11_hard_negatives']})"
    assert sorted(map(tuple, got)) == sorted(con.execute(sql).fetchall())
