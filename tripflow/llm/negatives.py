"""Hard negatives by exact search over lists that the anchors of a cluster share.

1. Anchors are put into clusters by direction; the centres come from a bounded sample of anchors,
   the assignment covers all of them.
2. Rows are dealt into slices, anchors into blocks; every slice meets every block, in one task a
   pair. There, for each cluster, the slice's rows are sorted once by what they can score at most
   with any of its members: with t the angle between row and centre and r the largest angle
   between a member and the centre, a member u scores at most |u| |x| cos(max(0, t - r)).
3. Every member walks that list and stops where the bound falls below the worst score it still
   wants: a certificate, not a guess. Scores are exact integers.
4. The first walk finds positives (rows of the anchor's label), the second, which knows the
   positives' scores, the negatives in the range that each allows. The best of all slices are
   merged by rank.

Slices and blocks are bounded in bytes, whatever a label's or a cluster's share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.rows import LAST, prepare
from tripflow.session import durable

# Fixed values of the contract.
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Negatives score between these percentages of the positive.
LOW, HIGH = 80, 100

#: Anchors, the first by hash, from which the clusters' centres are learnt; rounds of learning.
SAMPLE = 4096
ROUNDS = 8
MOST_CLUSTERS = 256
#: Bytes of vectors in a slice or a block, and rows below which a slice is not cut further.
PART_BYTES = 64 << 20
PART_ROWS = 2048
#: Rows of a list that are scored at once, at first; twice as many each time up to the last.
FIRST_STEP, LAST_STEP = 256, 4096
#: Share of |x| by which a bound is raised, for rounding in the angles.
MARGIN = 1e-6

_NEVER = np.iinfo(np.int64).max


def integer_rows(rows: DataFrame, anchor: Column) -> DataFrame:
    """ord, label, v, anchor: the rows that take part, with integer components floor(256 * x).

    Left out: rows without label or vector, with a missing or non-finite component, and those whose
    integer vector is so long (2**31 or more) that its scores may not fit a LONG.
    """
    infinite = F.lit(float("inf"))
    sound = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite)
    )
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    length = F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * SCALE), F.lit(2))
    )
    kept = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(sound)
    return kept.where(length < float(1 << 62)).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("ord"),
        F.col("label").cast("long").alias("label"),
        scaled.cast("array<int>").alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists as rows of integers; shorter ones end in zeros."""
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    counts = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(counts), int(counts.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < counts[:, None]] = flat.flatten().to_numpy()
    return out


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a vector of zeros has direction 0."""
    real = vectors.astype(np.float64)
    lengths = np.sqrt((real * real).sum(axis=1))
    return real / np.where(lengths > 0, lengths, 1)[:, None], lengths


def learn_centres(sample: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Directions of `clusters` centres at most: k-means by angle, from evenly spaced members."""
    units, _ = _units(sample)
    centres = units[np.linspace(0, len(units) - 1, min(clusters, len(units))).astype(int)]
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        lengths = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(lengths[:, None] > 0, sums / np.where(lengths > 0, lengths, 1)[:, None], centres)
    return centres


def _assign(centres: np.ndarray):
    def assign(batches):
        for batch in batches:
            vectors = _matrix(pa.chunked_array([batch.column("v")]))
            width = min(vectors.shape[1], centres.shape[1])
            nearest = (vectors[:, :width].astype(np.float64) @ centres[:, :width].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest.astype(np.int32))],
                names=[*batch.schema.names, "cluster"],
            )

    return assign


class _Best:
    """The best `width` (score, place) of each of some lines, the earliest place of equal scores."""

    def __init__(self, lines: int, width: int, ids: np.ndarray):
        self.width, self.ids = width, ids
        self.line = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0, dtype=np.int64)
        self.place = np.zeros(0, dtype=np.int64)
        #: What a line still takes: scores from here on.
        self.least = np.full(lines, np.iinfo(np.int64).min)

    def add(self, line: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        if not len(line):
            return
        line = np.concatenate([self.line, line])
        score = np.concatenate([self.score, score])
        place = np.concatenate([self.place, place])
        order = np.lexsort((self.ids[place], -score, line))
        line, score, place = line[order], score[order], place[order]
        first = np.searchsorted(line, line, side="left")
        rank = np.arange(len(line)) - first
        keep = rank < self.width
        self.line, self.score, self.place = line[keep], score[keep], place[keep]
        full = rank == self.width - 1
        self.least[line[full]] = np.maximum(self.least[line[full]], score[full])


Take = Callable[[np.ndarray, np.ndarray, np.ndarray], None]


def _walk(
    members: np.ndarray, rows: np.ndarray, wanted: Callable[[], np.ndarray], take: Take
) -> None:
    """Show each member the rows that may score at least what it wants.

    `wanted()`: the least score of interest for each member, checked before every step; `take(which,
    where, scores)`: members, places of rows, and the scores of every one with every other.
    """
    units, reach = _units(members)
    row_units, lengths = _units(rows)
    mean = units.sum(axis=0)
    size = np.sqrt(mean @ mean)
    centre = mean / size if size > 0 else mean
    turned = reach > 0
    radius = np.arccos(np.clip(units[turned] @ centre, -1, 1)).max(initial=0)
    angle = np.arccos(np.clip(row_units @ centre, -1, 1))
    bound = lengths * (np.cos(np.maximum(0, angle - radius)) + MARGIN)
    order = np.argsort(-bound, kind="stable")
    # Sums of products stay exact in double precision up to 2**53.
    exact = np.float64 if reach.max(initial=0) * lengths.max(initial=0) < 2.0**52 else np.int64
    members, rows = members.astype(exact), rows.astype(exact)
    at, step = 0, FIRST_STEP
    while at < len(order):
        which = np.flatnonzero(reach * bound[order[at]] + 1 >= wanted())
        if not len(which):
            return
        where = order[at : at + step]
        scores = members[which] @ rows[where].T
        take(which, where, scores.astype(np.int64))
        at, step = at + step, min(2 * step, LAST_STEP)


def _columns(rows: pa.Table, anchors: pa.Table):
    """Vectors of both sides, as wide as each other."""
    x, u = _matrix(rows.column("v")), _matrix(anchors.column("v"))
    width = max(x.shape[1], u.shape[1])
    x, u = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, u))
    return x, u


def _positives(limit: int):
    names = ["a", "score", "ord"]

    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if len(rows) and len(anchors):
            x, u = _columns(rows, anchors)
            ids, labels = rows.column("ord").to_numpy(), rows.column("label").to_numpy()
            own, name = anchors.column("ord").to_numpy(), anchors.column("a").to_numpy()
            mine, cluster = anchors.column("label").to_numpy(), anchors.column("cluster").to_numpy()
            # Only rows of the anchor's label count, so each label has lists of its own.
            for group in np.unique(np.stack([cluster, mine]), axis=1).T.tolist():
                some = np.flatnonzero((cluster == group[0]) & (mine == group[1]))
                fits = np.flatnonzero(labels == group[1])
                best = _Best(len(some), limit, ids[fits])

                def take(which, where, scores):
                    ok = scores >= best.least[which][:, None]
                    ok &= ids[fits[where]][None, :] != own[some[which]][:, None]
                    i, j = np.nonzero(ok)
                    best.add(which[i], scores[i, j], where[j])

                _walk(u[some], x[fits], lambda: best.least, take)
                out[0].append(name[some[best.line]])
                out[1].append(best.score)
                out[2].append(best.ids[best.place])
        parts = [np.concatenate(p) if p else np.zeros(0, dtype=np.int64) for p in out]
        return pa.table([pa.array(p) for p in parts], names=names)

    return find


def _negatives(limit: int, low: int, high: int):
    names = ["a", "nth", "score", "ord"]

    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if len(rows) and len(anchors):
            x, u = _columns(rows, anchors)
            ids, labels = rows.column("ord").to_numpy(), rows.column("label").to_numpy()
            own, name = anchors.column("ord").to_numpy(), anchors.column("a").to_numpy()
            mine, cluster = anchors.column("label").to_numpy(), anchors.column("cluster").to_numpy()
            lists = anchors.column("scores").to_pylist()
            most = max(map(len, lists))
            # Python's integers: a percentage of a score may not fit 64 bits.
            least = np.array(
                [[-(-low * s // 100) for s in p] + [_NEVER] * (most - len(p)) for p in lists]
            )
            upto = np.array([[high * s // 100 for s in p] + [-_NEVER] * (most - len(p)) for p in lists])
            for c in np.unique(cluster).tolist():
                some = np.flatnonzero(cluster == c)
                lines = np.arange(len(some) * most).reshape(-1, most)
                best = _Best(lines.size, limit, ids)
                # A range without any score is never wanted.
                best.least = np.where(least[some] <= upto[some], least[some], _NEVER).ravel()

                def take(which, where, scores):
                    differs = labels[where][None, :] != mine[some[which]][:, None]
                    differs &= ids[where][None, :] != own[some[which]][:, None]
                    differs &= scores >= best.least[lines[which]].min(axis=1)[:, None]
                    i, j = np.nonzero(differs)
                    score, line, place = scores[i, j], lines[which[i]], where[j]
                    for k in range(most):
                        ok = score >= best.least[line[:, k]]
                        ok &= score <= upto[some[which[i]], k]
                        best.add(line[ok, k], score[ok], place[ok])

                _walk(u[some], x, lambda: best.least[lines].min(axis=1), take)
                out[0].append(name[some[best.line // most]])
                out[1].append(best.line % most)
                out[2].append(best.score)
                out[3].append(ids[best.place])
        parts = [np.concatenate(p) if p else np.zeros(0, dtype=np.int64) for p in out]
        return pa.table([pa.array(p) for p in parts], names=names)

    return find


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _ranked(found: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The best of all slices, with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "ord")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows`: vec_id, label, embedding; `anchor` says which of them are anchors. Rows take part as
    `integer_rows` says; a shorter vector counts as ending in zeros. An anchor's positives are its
    first rows of the same label, by score and then vec_id; a positive's negatives the first rows
    of another label with low * positive <= 100 * negative <= high * positive. A missing vec_id
    counts as larger than any other. Rows with the anchor's own vec_id serve it as neither. Rows
    that repeat take a place each, as candidates; anchors that are equal in all three columns count
    once. A positive without such a negative gives no row, nor does an anchor without positives;
    empty tables give none.
    """
    spark = prepare(rows.sparkSession)
    valid = durable(integer_rows(rows, anchor), "vectors")
    distinct = valid.where("anchor").select("ord", "label", "v").distinct()
    chosen = durable(distinct.withColumn("a", F.monotonically_increasing_id()), "anchors")
    size = F.coalesce(F.sum(F.size("v")), F.lit(0)) * 8
    n, n_bytes = valid.agg(F.count(F.lit(1)), size).first()
    m, m_bytes = chosen.agg(F.count(F.lit(1)), size).first()
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not m:
        return spark.createDataFrame([], names)

    sample = chosen.orderBy(F.xxhash64("ord", "label"), "v").limit(SAMPLE).select("v").toArrow()
    centres = learn_centres(_matrix(sample.column("v")), min(MOST_CLUSTERS, round(m**0.5)))
    chosen = chosen.mapInArrow(_assign(centres), "ord long, label long, v array<int>, a long, cluster int")

    # Enough slices for all cores, but none so small that lists are not worth sorting.
    spread = min(-(-n // PART_ROWS), 2 * spark.sparkContext.defaultParallelism)
    slices = max(1, spread, -(-n_bytes // PART_BYTES))
    blocks = max(1, -(-m_bytes // PART_BYTES))
    dealt = valid.select(
        F.pmod(F.xxhash64("ord", "v"), F.lit(slices)).cast("int").alias("slice"),
        _every(blocks).alias("block"), "ord", "label", "v",
    )
    block = F.pmod(F.col("a"), F.lit(blocks)).cast("int").alias("block")

    def met(anchors: DataFrame, find, schema: str) -> DataFrame:
        spread = anchors.withColumn("block", block).withColumn("slice", _every(slices))
        sides = [side.groupBy("slice", "block") for side in (dealt, spread)]
        return sides[0].cogroup(sides[1]).applyInArrow(find, schema)

    found = met(chosen, _positives(positives), "a long, score long, ord long")
    best = _ranked(found, ["a"], positives).groupBy("a").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", F.col("ord").alias("id")))).alias("p")
    )
    ready = durable(
        chosen.join(best, "a").select("a", "ord", "label", "v", "cluster", "p", F.col("p.score").alias("scores")),
        "positives",
    )
    found = met(ready.drop("p"), _negatives(negatives, low, high), "a long, nth long, score long, ord long")
    hard = _ranked(found, ["a", "nth"], negatives)
    pairs = ready.select("a", F.col("ord").alias("anchor"), F.posexplode("p").alias("nth", "p"))

    def known(column: str) -> Column:
        return F.when(F.col(column) != LAST, F.col(column))

    return hard.join(pairs, ["a", "nth"]).select(
        known("anchor").alias("anchor_id"),
        known("p.id").alias("positive_id"),
        "rank",
        known("ord").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
