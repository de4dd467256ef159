"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

1. Rows with the same shingle set form a class; its first row stands for it from here on. Copies
   are never expanded into pairs.
2. Classes whose sketches agree in a band share a bucket. Each bucket's most central member (the
   one with most bucket mates over all bands) is compared with every other member on full sets:
   as many pairs as members, not their square. Links give components.
3. Buckets that still span several components hold documents that resemble each other, but not
   enough to link: copies of one text with changes of their own, for instance, of which any two
   agree in less than the threshold. Listing their pairs would grow with the square of such a
   group. Instead the members around one centre are described by what sets them apart: the
   shingles that more than half of them have are their common ground, and each member has a
   difference from it. Two members link just if few shingles lie in only one of the two
   differences; so, unless both differences are small, linked members share much of theirs, while
   others share next to nothing. The differences are sketched and banded, and pairs that share a
   band are verified on full sets. Small differences are met by comparing every member with the
   one nearest to the common ground.

No bucket is capped. What decides is always the full sets; sketches only propose. With b bands of
r rows a pair of similarity s shares no band with probability (1 - s**r)**b: 2e-6 at 0.85 in step
2. In step 3, two differences of d shingles each, of documents of n shingles that just link, have
a similarity of (2d - t) / (2d + t), where t is 0.16 n. The smaller they are the fewer rows their
bands have: of pairs just at the threshold, a share of 1e-8 is lost at d = 0.24 n, 4e-4 at 0.18 n,
5e-2 at 0.12 n, 1e-6 just below that, 6e-4 at 0.1 n; below 0.08 n all link with the nearest member
if that has as few. Pairs above the threshold, or with another way between them, are lost less. A
test measures what is found. Copies with changes of their own agree in 0.01 to 0.04 of their
differences: of their pairs some thousandths are verified in vain, and a tenth of those between
copies that nearly link.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.components import components
from tripflow.llm.rows import (
    KEY,
    KEY_TYPES,
    LAST,
    doc_id,
    keyed,
    lists,
    packed,
    prepare,
    sieved,
    unpacked,
    with_key,
)
from tripflow.llm.sketch import SHINGLE, Sketcher, bands, shingle_sets
from tripflow.llm.text import Words, mix, signed, texts_of
from tripflow.session import durable

PERCENT = 85
ROWS = 6
BANDS = 28
#: Coordinates of the sketch of a difference in step 3, and rows of its bands: all differences have
#: bands of the first number of rows, those below the percentages of the document's shingles also
#: of the others. Each kind of band uses all coordinates.
APART_COORDINATES = 1200
APART_ROWS = {100: 4, 20: 3, 12: 2}


def _scan(shingle: int, rows: int, n_bands: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(rows * n_bands)
        for batch in batches:
            for first, data, offsets in texts_of(batch.column("text")):
                sets = shingle_sets(Words(data, offsets, lower=True), shingle)
                set1, set2, keys = [], [], []
                for elements in sets:
                    set1.append(int(mix(elements).sum(dtype=np.uint64)))
                    set2.append(int(mix(elements ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)))
                    if len(elements):
                        keys.append(bands(sketcher.sketch(elements), rows))
                    else:
                        keys.append(np.zeros(0, dtype=np.uint64))
                flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
                piece = batch.slice(first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(k) for k in KEY),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(signed(np.array(set1, dtype=np.uint64))),
                        pa.array(signed(np.array(set2, dtype=np.uint64))),
                        lists(np.array([len(k) for k in keys]), pa.array(signed(flat))),
                    ],
                    names=[*KEY, "n", "set1", "set2", "bands"],
                )

    return scan


def _sets(shingle: int):
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in texts_of(unpacked(batch.column("packed"))):
                found = shingle_sets(Words(data, offsets, lower=True), shingle)
                piece = batch.slice(first, len(found))
                flat = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(k) for k in KEY),
                        lists(np.array([len(x) for x in found]), pa.array(signed(flat))),
                    ],
                    names=[*KEY, "elements"],
                )

    return sets


def _apart_bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bands of each row's `apart`, in its place."""
    sketcher = Sketcher(APART_COORDINATES)
    for batch in batches:
        column, sizes = batch.column("apart"), batch.column("n").to_pylist()
        offsets = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
        keys, ends, taken = [np.zeros(0, dtype=np.uint64)], [0], 1
        for a, b, n in zip(offsets.tolist(), offsets[1:].tolist(), sizes):
            if a < b:
                sketch = sketcher.sketch(flat[a:b])
                for percent, size in APART_ROWS.items():
                    if percent == 100 or 100 * (b - a) < percent * n:
                        keys.append(bands(sketch, size))
            ends.append(ends[-1] + sum(map(len, keys[taken:])))
            taken = len(keys)
        held = lists(np.diff(ends), pa.array(signed(np.concatenate(keys))))
        rest = [n for n in batch.schema.names if n != "apart"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in rest), held], names=[*rest, "bands"]
        )


def _close(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b whose full sets reach the threshold."""
    one = sets.select(F.col("v").alias("a"), F.col("elements").alias("a_set"))
    two = sets.select(F.col("v").alias("b"), F.col("elements").alias("b_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    met = pairs.join(two, "b").join(one, "a").withColumn("both", both)
    union = F.size("a_set") + F.size("b_set") - F.col("both")
    return durable(met.where(100 * F.col("both") >= percent * union).select("a", "b"), "links")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))


_VERTEX = f"struct<{', '.join(x.replace(' ', ':') for x in KEY_TYPES.split(', '))}>"


def _pairs(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _apart(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of members of one group, of different components, that may link.

    `groups`: centre, v, n, label; `sets`: v, elements.
    """
    held = durable(groups.join(sets, "v"), "grouped")
    shingles = held.select("centre", F.explode("elements").alias("x"))
    sizes = held.groupBy("centre").agg(F.count(F.lit(1)).alias("members"))
    # What more than half of the members have is no more than twice a member's set on average.
    common = (
        shingles.groupBy("centre", "x")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(sizes, "centre")
        .where(2 * F.col("times") > F.col("members"))
        .groupBy("centre")
        .agg(F.collect_list("x").alias("common"))
    )
    ground = F.coalesce("common", F.array().cast("array<long>"))
    apart = F.array_union(F.array_except("elements", ground), F.array_except(ground, "elements"))
    away = durable(
        held.join(common, "centre", "left").select("centre", "v", "n", "label", apart.alias("apart")),
        "apart",
    )
    nearest = away.groupBy("centre").agg(
        F.min_by(F.struct("v", "n", "label"), F.struct(F.size("apart"), "v")).alias("o")
    )
    stars = (
        away.join(nearest, "centre")
        .where((F.col("label") != F.col("o.label")) & _close("n", "o.n", percent))
        .select(*_pairs("v", "o.v"))
    )
    # From here on centre and component are 64-bit hashes, for there is a row for every band.
    rows = away.select(
        F.xxhash64("centre").alias("centre"), "v", "n", F.xxhash64("label").alias("label"), "apart"
    )
    banded = rows.mapInArrow(
        _apart_bands, f"centre long, v {_VERTEX}, n long, label long, bands array<long>"
    )
    band = F.transform("bands", lambda x: F.xxhash64("centre", x))
    entries = durable(banded.select("v", "n", "label", F.explode(band).alias("band")), "entries")
    # Most bands hold one member, and many one component.
    mixed = (
        entries.groupBy("band")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
        .select("band")
    )
    entries = durable(entries.join(mixed, "band"), "mixed-entries")
    other = entries.select(
        "band", F.col("v").alias("w"), F.col("n").alias("m"), F.col("label").alias("l")
    )
    met = entries.join(other, "band").where("v < w AND label != l")
    return met.where(_close("n", "m", percent)).select(*_pairs("v", "w")).union(stars).distinct()


def _tops(members: DataFrame, centres: DataFrame) -> DataFrame:
    """c, top: where each centre ends that moves on to the most central one of its own buckets."""
    reached = centres.select("bucket", F.col("centre.v").alias("w"), "reach")
    own = centres.select(F.col("centre.v").alias("v")).distinct()
    best = F.max_by("w", F.struct("reach", "w")).alias("top")
    tops = members.join(own, "v").join(reached, "bucket").groupBy(F.col("v").alias("c")).agg(best)
    tops = durable(tops, "tops")
    while True:
        onward = tops.select(F.col("c").alias("top"), F.col("top").alias("next"))
        after = durable(
            tops.join(onward, "top").select("c", F.col("next").alias("top"), (F.col("next") != F.col("top")).alias("moved")),
            "tops",
        )
        tops = after.select("c", "top")
        if after.where("moved").isEmpty():
            return tops


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links enough to connect what the links of all pairs would connect.

    `members`: bucket, v, n, mates (members of the bucket).
    """
    central = members.groupBy("v").agg(F.sum("mates").alias("reach"))
    ranked = members.join(durable(central, "reach"), "v")
    centres = durable(
        ranked.groupBy("bucket").agg(
            F.max_by(F.struct("v", "n"), F.struct("reach", "v")).alias("centre"),
            F.max("reach").alias("reach"),
        ),
        "centres",
    )
    # Only what can pass by size is compared; the rest stays apart for the last step.
    stars = (
        members.join(centres, "bucket")
        .where(F.col("v") != F.col("centre.v"))
        .where(_close("n", "centre.n", percent))
        .select(*_pairs("v", "centre.v"))
        .distinct()
    )
    stars = durable(stars, "stars")
    links = _verified(stars, sets, percent)
    labels = components(links)

    # Buckets of two are settled; larger ones may hold more than one component.
    open_members = _labelled(members.where("mates > 2"), labels)
    mixed = durable(
        open_members.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
        .select("bucket"),
        "mixed",
    )
    # Buckets around the same members have several centres; groups are made around the last of them.
    tops = _tops(members, centres)
    groups = (
        open_members.join(mixed, "bucket")
        .join(centres.select("bucket", F.col("centre.v").alias("c")), "bucket")
        .join(tops, "c")
        .select(F.col("top").alias("centre"), "v", "n", "label")
        .distinct()
    )
    groups = durable(groups, "groups")
    if groups.isEmpty():
        return links
    pairs = durable(_apart(groups, sets, percent).join(stars, ["a", "b"], "left_anti"), "pairs")
    return links.union(_verified(pairs, sets, percent))


def near_duplicates(
    docs: DataFrame,
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    rows: int = ROWS,
    n_bands: int = BANDS,
) -> DataFrame:
    """doc_id, tkey, tsum, n_shingles, component_id, first: one row for each row of `docs`.

    A document's set are its different shingles of `shingle` words (A-Z lower-cased, words are runs
    of [^\\x20\\x09-\\x0D]); a shorter text is one shingle, a text without words has none and is
    linked with nothing. Documents are linked where 100 * intersection >= percent * union;
    `component_id` is the smallest doc_id reachable over links, the row's own included. A row
    without doc_id gets the component's smallest id, and none where no row there has one. `first`
    marks the component's first row by doc_id and checksum of the text (rows that repeat: each).
    """
    prepare(docs.sparkSession)
    keys = keyed(docs)
    scanned = durable(
        keys.mapInArrow(
            _scan(shingle, rows, n_bands),
            f"{KEY_TYPES}, n long, set1 long, set2 long, bands array<long>",
        ),
        "sketches",
    )
    same = ["set1", "set2", "n"]
    firsts = durable(
        scanned.where("n > 0")
        .groupBy(*same)
        .agg(F.min(F.struct(*KEY)).alias("v")),
        "classes",
    )
    # A row without words is a class of its own.
    placed = scanned.withColumn("own", F.struct(*KEY)).join(firsts, same, "left")
    placed = placed.withColumn("v", F.coalesce("v", "own"))
    heads = placed.where("n > 0 AND v = own").select("v", "n", "bands").dropDuplicates(["v"])
    heads = durable(heads, "heads")
    entries = heads.select("v", "n", F.explode("bands").alias("bucket"))
    counts = durable(
        entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1"), "buckets"
    )
    members = durable(entries.join(counts, "bucket"), "members")
    wanted = durable(members.select("v.*").distinct(), "wanted")
    found = durable(
        packed(sieved(keys, wanted))
        .join(wanted, KEY)
        .dropDuplicates(KEY)
        .mapInArrow(_sets(shingle), f"{KEY_TYPES}, elements array<long>")
        .select(F.struct(*KEY).alias("v"), "elements"),
        "sets",
    )
    # Several joins on v follow; dealt out once, the sets stay where they are.
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = found.repartition(width, "v").persist(StorageLevel.DISK_ONLY)
    links = _links(members, sets, percent)
    labels = components(links)
    sets.unpersist()
    final = placed.select("v", *KEY, "n").join(durable(labels, "final"), "v", "left")
    label = F.coalesce("label", "v")
    return final.select(
        doc_id(),
        "tkey",
        "tsum",
        F.col("n").alias("n_shingles"),
        F.nullif(label["ord"], F.lit(LAST)).alias("component_id"),
        (label == F.struct(*KEY)).alias("first"),
    )


def keep_one(docs: DataFrame, **options: int) -> DataFrame:
    """One row of `docs` for each component, with the columns of `docs`.

    Stays: the first by doc_id, then by checksum of the text. Rows without words are linked with
    nothing and stay, each different doc_id and text once.
    """
    found = near_duplicates(docs, **options).where("first")
    key = ["_ord", "_tkey", "_tsum"]
    firsts = found.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("_ord"),
        F.col("tkey").alias("_tkey"),
        F.col("tsum").alias("_tsum"),
    )
    kept = with_key(docs).join(firsts.distinct(), key, "left_semi")
    # Rows that repeat; the join has them sorted and together.
    repeat = Window.partitionBy(*key).orderBy(*key)
    kept = kept.withColumn("_repeat", F.row_number().over(repeat)).where("_repeat = 1")
    return kept.select(*docs.columns)
