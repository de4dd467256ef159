"""More sources than half of the shortest period."""

import heapq

import pytest
from pyspark.sql import functions as F

from tripflow.llm.mixing import PERIOD, halved, mix_sources, period_of, schedule, source_weights
from tripflow.llm.rows import prepare


def earliest_deadline_first(shares, period):
    """The source of each slot."""
    released = sorted((j * period // s, -(-(j + 1) * period // s), i) for i, s in shares.items() for j in range(s))
    waiting, order, at = [], [], 0
    for slot in range(period):
        while at < len(released) and released[at][0] <= slot:
            heapq.heappush(waiting, released[at][1:])
            at += 1
        order.append(heapq.heappop(waiting)[1])
    return order


def frame_of(spark, sizes):
    rows = [(n, f"s{s:05d}") for s, size in enumerate(sizes) for n in range(size)]
    return prepare(spark).createDataFrame(rows, "doc_id long, source string").withColumn("text", F.lit("x"))


@pytest.mark.parametrize("period", [7, 100, 1000])
def test_halving_gives_the_schedule(spark, period):
    frame = frame_of(spark, [900, 300, 51])
    weights = source_weights(frame, period)
    keys = ["slot", "source", "share", "nth"]
    found, expected = (plan.select(*keys).orderBy("slot").collect() for plan in (
        halved(weights, period), schedule(weights, period)))
    assert len(found) == period and found == expected


@pytest.mark.parametrize("sources", [500, 501, 1300])
def test_every_source_has_its_share(spark, sources):
    sizes = [1 + 5 * (s % 7) for s in range(sources)]
    sizes[3] = 9000
    frame = frame_of(spark, sizes)
    period = period_of(sources)
    assert period == max(PERIOD, 2 * sources)
    weights = {r.number: r.share for r in source_weights(frame).collect()}
    assert sum(weights.values()) == period and min(weights.values()) >= 1 and len(weights) == sources
    slots = {}
    for slot, who in enumerate(earliest_deadline_first(weights, period)):
        slots.setdefault(who, []).append(slot)
    mixed = mix_sources(frame, block=4).collect()
    assert len(mixed) == sum(sizes)
    for r in mixed:
        turns, number = slots[int(r.source[1:])], r.mix_block
        assert r.mix_slot == number // len(turns) * period + turns[number % len(turns)]
    assert len({(r.mix_slot, r.mix_row) for r in mixed}) == len(mixed)
