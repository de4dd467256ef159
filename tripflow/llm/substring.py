"""Removal of long repeated passages, by compaction of a De Bruijn graph of the corpus.

The graph's edges are the token k-mers of `span` words (its nodes are the k-1 words that two
edges share). An edge that starts in two documents or more is repeated. Non-branching paths of
repeated edges compact into one path each, and a path's occurrences are the repeated passages.

What keeps it small at scale:

* Texts of equal words are compared whole; only the first of them enters the graph.
* Each edge is represented by its anchor, the sub-k-mer of `anchor` words with the lowest hash.
  Equal edges have equal anchors, so an edge whose anchor occurs in one document only cannot be
  repeated. Some 1 in (span - anchor) / 2 words are anchors; only edges with repeated anchors are
  ever written out.
* Hot passages are met by aggregates that combine before the shuffle and by joins between two
  plain shuffles, which adaptive execution splits.

Paths are cut where the graph branches and also where an occurrence begins or ends, so that each
occurrence holds whole paths only, and all edges of a path have the same documents. The order of a
path's edges is read off the documents that hold it, hence no rounds of pointer jumping.

Hashes have 64 bits, so each path's occurrences are verified at their source coordinates: a digest
of the words at each occurrence must equal that of the words at the first one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.rows import (
    KEY,
    KEY_TYPES,
    LAST,
    doc_id,
    keyed,
    lists,
    packed,
    prepare,
    unpacked,
    with_key,
)
from tripflow.llm.text import WORDS, Words, lowest_in_window, signed, texts_of
from tripflow.session import durable

SPAN = 50
ANCHOR = 20


class _Graph:
    """Edges of a piece of texts and the place of each edge's anchor."""

    def __init__(self, words: Words, span: int, anchor: int):
        self.rows = words.rows
        self.prefix = WORDS.prefix(words.hashes())
        anchors = WORDS.windows(self.prefix, anchor)
        self.anchors = anchors
        self.lowest = lowest_in_window(anchors, span - anchor + 1)
        self.row = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))
        first = np.arange(len(self.lowest))
        # An edge lies within one row.
        self.whole = first + span <= self.rows[1:][self.row[: len(first)]]


def _scan(span: int, anchor: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in texts_of(batch.column("text")):
                words = Words(data, offsets)
                graph = _Graph(words, span, anchor)
                rows = graph.rows
                # Copies of whole texts are not held against their source again, so their digests
                # have to tell any two texts apart, as sums of powers do not.
                whole = np.frombuffer(b"".join(words.digests()), dtype=np.int64).reshape(-1, 2)
                places = np.unique(graph.lowest[graph.whole])
                counts = np.diff(np.searchsorted(places, rows))
                starts = places - rows[:-1][graph.row[places]]
                piece = batch.slice(first, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(k) for k in KEY),
                        pa.array(np.diff(rows)),
                        pa.array(whole[:, 0]),
                        pa.array(whole[:, 1]),
                        lists(counts, pa.array(signed(graph.anchors[places]))),
                        lists(counts, pa.array(starts.astype(np.int32))),
                    ],
                    names=[*KEY, "n_words", "whole1", "whole2", "anchors", "starts"],
                )

    return scan


def _edges(span: int, anchor: int):
    def edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            for first, data, offsets in texts_of(unpacked(batch.column("packed"))):
                words = Words(data, offsets)
                graph = _Graph(words, span, anchor)
                piece = places.slice(first, len(offsets) - 1)
                base = np.repeat(graph.rows[:-1], np.asarray(piece.value_lengths()))
                repeated = np.zeros(len(graph.anchors) + 1, dtype=bool)
                repeated[np.asarray(piece.flatten()) + base] = True
                chosen = np.flatnonzero(graph.whole & repeated[graph.lowest])
                counts = np.diff(np.searchsorted(chosen, graph.rows))
                hashes = WORDS.windows(graph.prefix, span)[chosen]
                starts = chosen - graph.rows[:-1][graph.row[chosen]]
                piece = batch.slice(first, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(k) for k in KEY),
                        lists(counts, pa.array(signed(hashes))),
                        lists(counts, pa.array(starts.astype(np.int32))),
                    ],
                    names=[*KEY, "edges", "starts"],
                )

    return edges


def paths(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """The compacted repeated paths' occurrences, and the documents equal to an earlier one.

    First: ord, tkey, tsum, start, n_edges, path, source (ord and start of the path's first occurrence).
    Second: ord, tkey, tsum, n_words, source (ord of the first document of the same words).
    """
    prepare(docs.sparkSession)
    rows = keyed(docs)
    scanned = durable(
        rows.mapInArrow(
            _scan(span, anchor),
            f"{KEY_TYPES}, n_words long, whole1 long, whole2 long, "
            "anchors array<long>, starts array<int>",
        ),
        "anchors",
    )
    same = ["whole1", "whole2", "n_words"]
    firsts = durable(scanned.groupBy(*same).agg(F.min("ord").alias("source")), "firsts")
    placed = scanned.join(firsts, same)
    copies = placed.where("ord > source").select(*KEY, "n_words", "source")
    anchors = placed.where("ord = source").select(
        *KEY, F.expr("inline(arrays_zip(anchors, starts))").alias("anchor", "place")
    )
    repeated = durable(
        anchors.groupBy("anchor")
        .agg(F.min("ord").alias("low"), F.max("ord").alias("high"))
        .where("low < high")
        .select("anchor"),
        "repeated",
    )
    places = (
        anchors.join(repeated, "anchor").groupBy(*KEY).agg(F.collect_set("place").alias("places"))
    )
    edges = durable(
        packed(rows)
        .join(places, KEY)
        .mapInArrow(_edges(span, anchor), f"{KEY_TYPES}, edges array<long>, starts array<int>"),
        "edges",
    )
    # 0 stands for no neighbour.
    occurrences = edges.select(
        *KEY,
        F.expr(
            "inline(transform(starts, (s, i) -> struct(s AS start, edges[i] AS edge, "
            "if(i > 0 AND starts[i - 1] = s - 1, edges[i - 1], 0L) AS before, "
            "if(i + 1 < size(starts) AND starts[i + 1] = s + 1, edges[i + 1], 0L) AS after)))"
        ),
    )
    graph = durable(
        occurrences.groupBy("edge")
        .agg(
            F.min(F.struct("ord", "start")).alias("source"),
            F.max("ord").alias("high"),
            (F.min("before") != F.max("before")).alias("cut_before"),
            (F.min("after") != F.max("after")).alias("cut_after"),
        )
        .where("source.ord < high")
        .drop("high"),
        "graph",
    )
    along = Window.partitionBy(*KEY).orderBy("start")
    steps = occurrences.select(*KEY, "start", "edge").distinct().join(graph, "edge")
    steps = steps.withColumn(
        "begins",
        F.coalesce(
            F.col("cut_before")
            | F.lag("cut_after").over(along)
            | (F.lag("start").over(along) != F.col("start") - 1),
            F.lit(True),
        ).cast("int"),
    ).withColumn("number", F.sum("begins").over(along))
    found = steps.groupBy(*KEY, "number").agg(
        F.min("start").alias("start"),
        F.count(F.lit(1)).alias("n_edges"),
        F.min_by("edge", "start").alias("path"),
        F.min_by("source", "start").alias("source"),
    )
    return durable(found.drop("number"), "paths"), copies


def _cut(span: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("spans").to_pylist()
            for first, data, offsets in texts_of(unpacked(batch.column("packed"))):
                words = Words(data, offsets)
                out: dict[str, list] = {"n_words": [], "kept": [], "gone": [], "digests": []}
                for i in range(len(offsets) - 1):
                    a, b = words.rows[i], words.rows[i + 1]
                    keep = np.ones(b - a, dtype=bool)
                    digests = []
                    for s in found[first + i] or ():
                        end = b - a if s["n_edges"] == 0 else s["start"] + s["n_edges"] + span - 1
                        if s["removed"]:
                            keep[s["start"] : end] = False
                        if s["n_edges"]:
                            here = np.zeros(b - a, dtype=bool)
                            here[s["start"] : end] = True
                            text = words.joined(here, a, b)
                            digest = hashlib.blake2b(text, digest_size=16).digest()
                            digests.append((s["path"], s["n_edges"], not s["removed"], digest))
                    edges = np.flatnonzero(np.diff(np.concatenate(([1], keep, [1])).astype(np.int8)))
                    out["n_words"].append(b - a)
                    out["kept"].append(words.joined(keep, a, b).decode())
                    out["gone"].append(
                        [{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2])]
                    )
                    out["digests"].append(
                        [dict(zip(("path", "n_edges", "source", "digest"), d)) for d in digests]
                    )
                piece = batch.slice(first, len(offsets) - 1)
                ends = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                digest = pa.struct(
                    [
                        ("path", pa.int64()),
                        ("n_edges", pa.int64()),
                        ("source", pa.bool_()),
                        ("digest", pa.binary()),
                    ]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(k) for k in KEY),
                        pa.array(out["n_words"], pa.int64()),
                        pa.array(out["kept"], pa.string()),
                        pa.array(out["gone"], pa.list_(ends)),
                        pa.array(out["digests"], pa.list_(digest)),
                    ],
                    names=[*KEY, "n_words", "kept_text", "removed", "digests"],
                )

    return cut


def _apply(rows: DataFrame, spans: DataFrame, span: int, name: str) -> DataFrame:
    of_doc = spans.groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "n_edges", "path", "removed")).alias("spans")
    )
    schema = (
        f"{KEY_TYPES}, n_words long, kept_text string, removed array<struct<start:int,end:int>>, "
        "digests array<struct<path:long,n_edges:long,source:boolean,digest:binary>>"
    )
    return durable(packed(rows).join(of_doc, KEY, "left").mapInArrow(_cut(span), schema), name)


def substring_dedup(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, tkey, tsum, n_words, kept_text, removed: every row of `docs` without repeated passages.

    A word goes if one of the windows of `span` words over it also starts in a document with a
    smaller doc_id; windows are judged on the input. Words are runs of [^\\x20\\x09-\\x0D];
    `kept_text` has the kept ones joined by one space, `removed` the maximal runs of removed words
    as half-open ranges of word numbers, `tkey` and `tsum` tell texts apart.

    Rows with an equal doc_id do not remove each other's words. Texts below `span` words, empty and
    missing texts lose nothing. Rules for missing values and repeated rows: `tripflow.llm.rows`.
    """
    found, copies = paths(docs, span, anchor)
    removed = F.col("ord") > F.col("source.ord")
    # Sources keep their words; they come along for the digest of the words there.
    spans = found.select(
        *KEY, "start", F.col("n_edges").cast("int"), "path", removed.alias("removed")
    ).unionByName(
        copies.where(F.col("n_words") >= span).select(
            *KEY,
            F.lit(0).alias("start"),
            F.lit(0).alias("n_edges"),
            F.lit(0).cast("long").alias("path"),
            F.lit(True).alias("removed"),
        )
    )
    rows = keyed(docs)
    cut = _apply(rows, spans, span, "cut")
    # Verification at the source coordinates.
    digests = cut.select(*KEY, F.explode("digests").alias("d")).select(*KEY, "d.*")
    mixed = (
        digests.groupBy("path", "n_edges")
        .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("low != high")
        .select("path", "n_edges")
    )
    mixed = durable(mixed, "mixed")
    if not mixed.isEmpty():
        # Two passages share a hash: what does not equal the words at the source stays.
        at_source = (
            digests.join(mixed, ["path", "n_edges"])
            .where("source")
            .select("path", "n_edges", "digest")
            .distinct()
        )
        wrong = (
            digests.where("NOT source")
            .join(mixed, ["path", "n_edges"])
            .join(at_source, ["path", "n_edges", "digest"], "left_anti")
            .select(*KEY, "path", "n_edges")
            .distinct()
        )
        cut = _apply(rows, spans.join(wrong, [*KEY, "path", "n_edges"], "left_anti"), span, "cut")
    return cut.select(doc_id(), "tkey", "tsum", "n_words", "kept_text", "removed")


def cut_repeats(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR) -> DataFrame:
    """The rows of `docs` without repeated passages, with the columns of `docs`.

    A text that loses words becomes its kept words joined by one space, and `n_chars`, where there
    is such a column, the length of that; other rows stay as they are. Rows that lose all words go.
    """
    done = substring_dedup(docs, span, anchor).where(F.size("removed") > 0)
    changed = done.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("_ord"),
        F.col("tkey").alias("_tkey"),
        F.col("tsum").alias("_tsum"),
        F.col("kept_text").alias("_kept"),
    ).dropDuplicates(["_ord", "_tkey", "_tsum"])
    new = {"text": F.coalesce("_kept", "text")}
    if "n_chars" in docs.columns:
        length = F.length("_kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(length, "n_chars")
    met = with_key(docs).join(changed, ["_ord", "_tkey", "_tsum"], "left")
    met = met.where("_kept IS NULL OR _kept != ''")
    return met.withColumns(new).select(*docs.columns)
