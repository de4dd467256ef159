"""Removal of repeated byte strings, by prefix-free parsing of the corpus.

Texts are UTF-8 bytes. A rolling hash over `trigger` bytes picks triggers: in every string of
`length` bytes the place with the lowest hash. Strings that share a trigger form a phrase (with the
bytes around it that they cover), so equal strings lie in phrases around equal triggers, at the
same distance from them. The parse of a text is its sequence of phrases; the dictionary is the set
of different phrases.

1. A trigger that occurs once in the corpus has no repeated string around it, and nothing more is
   done there. For most text that is the end of it.
2. Phrases around repeated triggers are counted by content: the parse then says where a whole
   phrase occurred before, and all its strings but those of its first occurrence are repeats.
3. What is left are the first occurrences of phrases around a trigger that has several. The order
   of their suffixes before and after the trigger (how far two phrases agree to the left, and to
   the right) tells which strings two phrases share. Groups of up to PAIRWISE phrases are
   compared byte by byte, of up to GROUP by the hashes of their strings, both in one task; the
   strings of still larger ones are counted over the whole cluster, so that no group is gathered
   beyond a fixed size.

Whole suffix arrays would order the corpus beyond what is asked: only equality over `length` bytes
decides, so suffixes are compared around triggers instead of sorted globally.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import KEY, KEY_TYPES, doc_id, keyed, lists, packed, prepare, unpacked
from tripflow.llm.text import BYTES, CHUNK_BYTES, lowest_in_window, mix, signed, texts_of
from tripflow.session import durable

#: What tells rows apart but for texts of one checksum: enough to name places to look at.
ABOUT = ["ord", "tkey"]
LENGTH = 100
TRIGGER = 16
#: Bytes of text worked on at once: their hashes stay in a core's cache.
PIECE = 200_000
#: Phrases of one trigger that a task takes at once: some 2 MB. More are counted by the cluster.
GROUP = 8192
#: Phrases of one trigger that are compared byte by byte; more go by the hashes of their strings.
PAIRWISE = 64


class _Parse:
    """Phrases of a piece of texts: trigger, first string and number of strings of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, trigger: int):
        self.offsets = offsets
        self.prefix = BYTES.prefix(BYTES.letters[data])
        self.hashes = BYTES.windows(self.prefix, trigger)
        lowest = lowest_in_window(self.hashes, length - trigger + 1)
        inside = np.ones(len(lowest), dtype=bool)
        for end in offsets[1:]:
            # No string begins so late that it would leave its row.
            inside[max(0, end - length + 1) : end] = False
        strings = np.flatnonzero(inside)
        low = lowest[strings]
        new = np.ones(len(strings), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (strings[1:] != strings[:-1] + 1)
        begins = np.flatnonzero(new)
        self.trigger = low[begins]
        self.first = strings[begins]
        self.count = np.diff(np.append(begins, len(strings)))
        self.row = np.searchsorted(offsets, self.first, side="right") - 1


def _scan(length: int, trigger: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in texts_of(batch.column("text"), PIECE):
                parse = _Parse(data, offsets, length, trigger)
                row = pa.array(parse.row + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).take(row) for k in ABOUT),
                        pa.array(signed(parse.hashes[parse.trigger])),
                        pa.array((parse.trigger - offsets[parse.row]).astype(np.int32)),
                    ],
                    names=[*ABOUT, "trigger", "place"],
                )

    return scan


def _phrases(length: int, trigger: int):
    def phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            for first, data, offsets in texts_of(unpacked(batch.column("packed")), PIECE):
                parse = _Parse(data, offsets, length, trigger)
                piece = places.slice(first, len(offsets) - 1)
                lengths = np.asarray(piece.value_lengths())
                here = np.asarray(piece.flatten()) + np.repeat(offsets[:-1], lengths)
                wanted = np.zeros(len(data) + 1, dtype=bool)
                wanted[here[here < np.repeat(offsets[1:], lengths)]] = True
                chosen = np.flatnonzero(wanted[parse.trigger])
                begin, count = parse.first[chosen], parse.count[chosen]
                before = parse.trigger[chosen] - begin
                shape = mix((before * 1024 + count).astype(np.uint64))
                content = BYTES.ranges(parse.prefix, begin, begin + count + length - 1) ^ shape
                row = pa.array(parse.row[chosen] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).take(row) for k in KEY),
                        pa.array(signed(parse.hashes[parse.trigger[chosen]])),
                        pa.array(signed(content)),
                        pa.array((begin - offsets[parse.row[chosen]]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(before.astype(np.int32)),
                    ],
                    names=[*KEY, "trigger", "content", "begin", "count", "before"],
                )

    return phrases


def _flat(column: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Of a column of lists of structs: the row of each entry, and the entries by field."""
    entries = column.flatten()
    names = [field.name for field in entries.type]
    rows = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths()))
    return rows, dict(zip(names, entries.flatten()))


def _binary(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def _along(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for each of the sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _spell(length: int, most: int):
    """Adds the bytes of phrases; `most` phrases leave at once."""

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = batch.column("apart")
            for first, data, offsets in texts_of(unpacked(batch.column("packed")), PIECE):
                rows, entries = _flat(apart.slice(first, len(offsets) - 1))
                for k in range(0, len(rows), most):
                    some = {name: column.slice(k, most) for name, column in entries.items()}
                    row = rows[k : k + most]
                    starts = offsets[row] + np.asarray(some["begin"])
                    sizes = np.asarray(some["count"]).astype(np.int64) + length - 1
                    spelled = data[np.repeat(starts, sizes) + _along(sizes)]
                    which = pa.array(row + first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(name).take(which) for name in KEY),
                            *some.values(),
                            _binary(sizes, spelled),
                        ],
                        names=[*KEY, *some, "bytes"],
                    )

    return spell


class _Group:
    """Phrases in the order of their triggers and of the corpus, without repeats of one row."""

    def __init__(self, batches: list[pa.RecordBatch]):
        batch = pa.concat_batches(batches)
        new = np.ones(len(batch), dtype=bool)
        if len(batch):
            new[1:] = False
        for name in ("trigger", *KEY, "begin"):
            column = np.asarray(batch.column(name))
            new[1:] |= column[1:] != column[:-1]
        self.batch = batch if new.all() else batch.filter(pa.array(new))
        trigger = self.column("trigger")
        self.borders = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1], [True]]))

    def column(self, name: str) -> np.ndarray:
        return np.asarray(self.batch.column(name))


def _bytes_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("bytes")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset :][: len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8), offsets.astype(np.int64)


def _strings(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings of phrases: phrase, place in it, and hash."""
    data, offsets = _bytes_of(batch)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    windows = BYTES.windows(BYTES.prefix(BYTES.letters[data]), length)
    counts = np.diff(offsets) - length + 1
    row, along = np.repeat(np.arange(len(counts)), counts), _along(counts)
    return row, along, windows[offsets[:-1][row] + along]


def _found(batch: pa.RecordBatch, rows: np.ndarray, low, high, string=None) -> pa.RecordBatch:
    """Ranges of first bytes of strings, or strings that the cluster is to count."""
    which = pa.array(rows)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    trigger = pa.nulls(len(rows), pa.int64())
    if string is None:
        string = trigger
    else:
        trigger, string = batch.column("trigger").take(which), pa.array(signed(string))
    begin = np.asarray(batch.column("begin"))[rows]
    ends = [pa.array((begin + x).astype(np.int32)) for x in (low, high)]
    found = [x.cast(kind) for x, kind in zip([trigger, string, *ends], kinds)]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(name).take(which) for name in KEY), *found],
        names=[*KEY, "trigger", "string", "low", "high"],
    )


def _by_hash(batch: pa.RecordBatch, group: np.ndarray, length: int) -> pa.RecordBatch:
    """The same as comparing the phrases of each group, for many of them."""
    row, along, strings = _strings(batch, length)
    # Strings stand in the order of the groups and, there, of the corpus: the first of equal ones is
    # the earliest.
    order = np.argsort(strings, kind="stable")
    sorted_strings, of = strings[order], group[row[order]]
    gone = np.zeros(len(strings), dtype=bool)
    gone[order[1:]] = (sorted_strings[1:] == sorted_strings[:-1]) & (of[1:] == of[:-1])
    edge = np.concatenate([[True], row[1:] != row[:-1], [True]])
    begins = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
    ends = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone[1:], [False]])))
    return _found(batch, row[begins], along[begins], along[ends] + 1)


def _by_bytes(batch: pa.RecordBatch, rank: np.ndarray, length: int, trigger: int) -> pa.RecordBatch:
    """Compares each phrase with the `rank` ones of its group before it."""
    left = length - trigger
    before, count = (np.asarray(batch.column(name)) for name in ("before", "count"))
    data, offsets = _bytes_of(batch)
    # Bytes by their distance from the trigger; nothing equals what lies outside a phrase.
    around = np.empty((len(batch), left + length), dtype=np.int16)
    around[:] = -1 - (np.arange(len(batch)) % (1 << 14))[:, None]
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(batch)), sizes)
    around[row, np.repeat(left - before, sizes) + _along(sizes)] = data[offsets[0] : offsets[-1]]
    # A string that begins d bytes before the trigger is shared if d bytes to the left and
    # length - d to the right agree: where such ranges of d begin and where they have ended.
    edges = np.zeros((len(batch), left + 2), dtype=np.int16)
    stop = np.zeros((len(batch), 1), dtype=bool)
    for back in range(1, int(rank.max(initial=0)) + 1):
        here = np.flatnonzero(rank >= back)
        same = around[here] == around[here - back]
        end = stop[: len(here)]
        low = length - np.hstack([same[:, left:], end]).argmin(axis=1)
        high = np.hstack([same[:, :left][:, ::-1], end]).argmin(axis=1)
        some = np.flatnonzero(low <= high)
        edges[here[some], low[some]] += 1
        edges[here[some], high[some] + 1] -= 1
    gone = np.zeros((len(batch), left + 3), dtype=np.int8)
    gone[:, 1:-1] = edges[:, :-1].cumsum(axis=1) > 0
    turns = np.diff(gone, axis=1)
    row, near = np.nonzero(turns == 1)
    far = np.nonzero(turns == -1)[1]
    return _found(batch, row, before[row] - far + 1, before[row] - near + 1)


def _shared(length: int, trigger: int, pairwise: int):
    """Strings of each phrase of a group that an earlier phrase of the group also has.

    Phrases come in the order of their triggers. A few groups are looked at together, and one that
    may go on is held back; the strings of phrases that are `spread` are handed on.
    """

    def within(found: _Group, groups: int) -> Iterator[pa.RecordBatch]:
        borders = found.borders[: groups + 1]
        sizes = np.diff(borders)
        group, rank = np.repeat(np.arange(groups), sizes), _along(sizes)
        batch = found.batch.slice(0, borders[-1])
        few = np.repeat(sizes <= pairwise, sizes)
        if few.any():
            yield _by_bytes(batch.filter(pa.array(few)), rank[few], length, trigger)
        if not few.all():
            yield _by_hash(batch.filter(pa.array(~few)), group[~few], length)

    def shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            spread = np.asarray(batch.column("spread"))
            if spread.any():
                hot = batch.filter(pa.array(spread))
                row, along, strings = _strings(hot, length)
                yield _found(hot, row, along, along + 1, strings)
                batch = batch.filter(pa.array(~spread))
            held.append(batch)
            if sum(x.nbytes for x in held) >= CHUNK_BYTES:
                found = _Group(held)
                last = len(found.borders) - 2
                yield from within(found, last)
                held = [found.batch.slice(found.borders[last])]
        if sum(map(len, held)):
            found = _Group(held)
            yield from within(found, len(found.borders) - 1)

    return shared


def repeats(
    docs: DataFrame,
    length: int = LENGTH,
    trigger: int = TRIGGER,
    group: int = GROUP,
    pairwise: int = PAIRWISE,
) -> tuple[DataFrame, DataFrame]:
    """Ranges of first bytes of strings that also start earlier, from whole phrases and within them.

    First: ord, tkey, tsum, later (ranges low, high of each document).
    Second: ord, tkey, tsum, low, high.
    """
    prepare(docs.sparkSession)
    rows = keyed(docs)
    # Asked for twice below; reading it back costs less than parsing all texts again.
    parse = durable(
        rows.mapInArrow(_scan(length, trigger), "ord long, tkey int, trigger long, place int"), "scan"
    )
    seen = parse.groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = durable(seen.select("trigger"), "triggers")
    # Texts of one checksum get each other's places too: more phrases, the same repeats.
    places = parse.join(repeated, "trigger").groupBy(*ABOUT).agg(F.collect_set("place").alias("places"))
    fields = "trigger long, content long, begin int, count int, before int"
    phrases = durable(
        packed(rows).join(places, ABOUT).mapInArrow(_phrases(length, trigger), f"{KEY_TYPES}, {fields}"),
        "phrases",
    )
    firsts = phrases.groupBy("trigger", "content").agg(F.min(F.struct(*KEY, "begin")).alias("first"))
    dictionary = durable(firsts, "dictionary")
    several = dictionary.groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    known = dictionary.join(durable(several, "several"), "trigger", "left")
    # Per document: what occurred before as a whole, and first occurrences that may share strings
    # with other phrases around their trigger.
    here = F.struct(*KEY, "begin") == F.col("first")
    high = (F.col("begin") + F.col("count")).alias("high")
    spread = (F.col("n") > group).alias("spread")
    of_doc = durable(
        phrases.join(known, ["trigger", "content"])
        .where(~here | F.col("n").isNotNull())
        .select(
            *KEY,
            F.when(~here, F.struct(F.col("begin").alias("low"), high)).alias("later"),
            F.when(here, F.struct("trigger", spread, "begin", "count", "before")).alias("apart"),
        )
        .groupBy(*KEY)
        .agg(F.collect_set("later").alias("later"), F.collect_set("apart").alias("apart")),
        "parse",
    )
    spelled = (
        packed(rows)
        .join(of_doc.where(F.size("apart") > 0).select(*KEY, "apart"), KEY)
        .mapInArrow(
            _spell(length, GROUP),
            f"{KEY_TYPES}, trigger long, spread boolean, begin int, count int, before int, "
            "bytes binary",
        )
    )
    # Phrases of one trigger meet in one task, but for those of which only strings are counted.
    salt = F.when(F.col("spread"), F.xxhash64(*KEY, "begin"))
    found = durable(
        spelled.repartition("trigger", salt)
        .sortWithinPartitions("trigger", *KEY, "begin")
        .mapInArrow(
            _shared(length, trigger, pairwise),
            f"{KEY_TYPES}, trigger long, string long, low int, high int",
        ),
        "found",
    )
    in_place = found.where("trigger IS NULL").select(*KEY, "low", "high")
    strings = found.where("trigger IS NOT NULL").drop("high")
    earliest = durable(
        strings.groupBy("trigger", "string")
        .agg(F.min(F.struct(*KEY, "low")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "earliest",
    )
    counted = (
        strings.join(earliest, ["trigger", "string"])
        .where(F.struct(*KEY, "low") != F.col("first"))
        .select(*KEY, "low", (F.col("low") + 1).alias("high"))
    )
    return of_doc.select(*KEY, "later"), in_place.unionByName(counted)


def _cut(length: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            for first, data, offsets in texts_of(unpacked(batch.column("packed")), PIECE):
                n = len(offsets) - 1
                rows, entries = _flat(spans.slice(first, n))
                depth = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(depth, offsets[rows] + np.asarray(entries["low"]), 1)
                np.add.at(depth, offsets[rows] + np.asarray(entries["high"]) + length - 1, -1)
                keep = depth.cumsum()[:-1] == 0
                # Runs of removed bytes end with their text.
                border = np.zeros(len(data) + 1, dtype=bool)
                border[offsets] = True
                near = ~keep & (border[:-1] | np.concatenate([[True], keep])[:-1])
                far = ~keep & (border[1:] | np.concatenate([keep, [True]])[1:])
                starts, ends = np.flatnonzero(near), np.flatnonzero(far) + 1
                row = np.searchsorted(offsets, starts, side="right") - 1
                runs = [pa.array((x - offsets[row]).astype(np.int32)) for x in (starts, ends)]
                left = np.concatenate([[0], np.cumsum(keep)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(first, n) for k in KEY),
                        pa.array(np.diff(offsets)),
                        _binary(np.diff(left), data[keep]),
                        lists(
                            np.bincount(row, minlength=n),
                            pa.StructArray.from_arrays(runs, names=["start", "end"]),
                        ),
                    ],
                    names=[*KEY, "n_bytes", "kept", "removed"],
                )

    return cut


def byte_dedup(
    docs: DataFrame,
    length: int = LENGTH,
    trigger: int = TRIGGER,
    group: int = GROUP,
    pairwise: int = PAIRWISE,
) -> DataFrame:
    """doc_id, tkey, tsum, n_bytes, kept, removed: every row of `docs` without repeated strings.

    A byte goes if it is covered by a string of `length` bytes that also starts earlier: in a
    document with a smaller doc_id, or in the same one at a smaller offset, where both may overlap.
    Strings are judged on the input. `kept` are the remaining bytes (a cut may fall inside a
    character), `removed` the maximal runs of removed bytes as half-open ranges.

    Rows of one doc_id but different texts come in the order of their texts' checksums; equal rows
    are one document. Texts below `length` bytes, empty and missing texts lose nothing.
    """
    later, within = repeats(docs, length, trigger, group, pairwise)
    within = within.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("within"))
    schema = (
        f"{KEY_TYPES}, n_bytes long, kept binary, removed array<struct<start:int,end:int>>"
    )
    none = F.array().cast("array<struct<low:int,high:int>>")
    found = packed(keyed(docs)).join(later, KEY, "left").join(within, KEY, "left")
    found = found.withColumn(
        "spans", F.concat(F.coalesce("later", none), F.coalesce("within", none))
    )
    cut = found.select(*KEY, "packed", "spans").mapInArrow(_cut(length), schema)
    return cut.select(doc_id(), "tkey", "tsum", "n_bytes", "kept", "removed")
