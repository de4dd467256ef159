"""Packing of documents into sequences of equal length, related ones together, by BM25.

1. Every document is encoded once, whole, and written as ids. The same pass counts in how many
   documents each token occurs; these counts, one per token of the vocabulary, weigh the terms.
2. Documents are ranged over partitions by the two terms that say most about them, so that those
   which share a rare term lie together. A frequent term is spread over as many partitions as it
   needs, as the range goes on by id.
3. A partition is packed as a stream. Full windows of a document are sequences of their own; what
   is left of it joins a shard. Once a shard has SHARD_TOKENS, a BM25 inverted index over it gives
   each seed document its neighbours in order of score; the unused ones fill the seed's window one
   after the other, and the last is cut so that the window is full. Its rest is the next seed. Where
   no neighbour is left, the next documents in order follow. What does not fill a window joins the
   next shard, so that one sequence of a partition is short at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import KEY, KEY_TYPES, doc_id, keyed, prepare
from tripflow.llm.tokens import encoder, ids_of
from tripflow.session import durable

#: Vocabulary of byte-level tokens as ranks; on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of the contract: tokens of a sequence, the id that ends a document, and the special
# token that the vocabulary knows by name.
WINDOW = 2048
END = 1
SPECIAL = {"<|endoftext|>": 50256}
#: Ids have 16 bits.
IDS = 1 << 16
#: Tokens that an index spans, and those of a partition, which bound what a task holds.
SHARD_TOKENS = 1 << 19
PARTITION_TOKENS = 1 << 25
LEAST_PARTITION = 1 << 21
#: Saturation of term counts and share of the length in BM25.
K1, B = 1.2, 0.75
#: Neighbours that are sorted by score at first; all if these do not fill a window.
NEIGHBOURS = 64


def token_ids(vocabulary: str, text: str) -> np.ndarray:
    """Ids of a document: those of the text, and END."""
    encoding = encoder(vocabulary)
    out: list[int] = []
    name, special = next(iter(SPECIAL.items()))
    for i, part in enumerate(text.split(name)):
        out += [special] * (i > 0) + ids_of(encoding, part)
    return np.array([*out, END], dtype=np.uint16)


def _distinct(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, terms and counts of the different terms of each document, in order."""
    rows = np.repeat(np.arange(len(ids), dtype=np.uint64), [len(x) for x in ids])
    keys = np.sort(rows * np.uint64(IDS) + np.concatenate(ids))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(IDS - 1)).astype(np.int64), counts


def _encode(vocabulary: str):
    """Ids and the two most telling terms of each document; at the end of a task, the number of
    documents it saw each term in."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(IDS, dtype=np.int64)
        names = [*KEY, "n_tokens", "ids", "first", "second", "terms", "counts"]
        none = pa.array([None], pa.list_(pa.int64()))
        # Tokens are ranked by how early they were merged, so a high id stands for a rare one.
        rarity = np.log1p(np.arange(IDS))
        for batch in batches:
            ids = [token_ids(vocabulary, x) for x in batch.column("text").to_pylist()]
            if not ids:
                continue
            rows, terms, counts = _distinct(ids)
            seen += np.bincount(terms, minlength=IDS)
            weight = rarity[terms] * counts / (counts + K1)
            order = np.lexsort((-weight, rows))
            start = np.searchsorted(rows, np.arange(len(ids)))
            size = np.bincount(rows, minlength=len(ids))
            first = terms[order[start]]
            second = np.where(size > 1, terms[order[np.minimum(start + 1, len(order) - 1)]], first)
            nothing = none.take(pa.array(np.zeros(len(ids), dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in KEY),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                    pa.array(first.astype(np.int32)),
                    pa.array(second.astype(np.int32)),
                    nothing,
                    nothing,
                ],
                names=names,
            )
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([None], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())),
                *(pa.array([None], t) for t in (pa.binary(), pa.int32(), pa.int32())),
                *(pa.array([x.tolist()], pa.list_(pa.int64())) for x in (found, seen[found])),
            ],
            names=names,
        )

    return encode


class Shard:
    """Documents, or what is left of them, and a BM25 index over them."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        rows, terms, counts = _distinct(ids)
        lengths = np.array([len(x) for x in ids])
        kept = idf[terms] > 0
        rows, terms, counts = rows[kept], terms[kept], counts[kept]
        norm = K1 * (1 - B + B * lengths / mean)
        weights = idf[terms] * counts * (K1 + 1) / (counts + norm[rows])
        self.n = len(ids)
        # Terms of each document, and, sorted by term, the documents of each.
        self.of = np.searchsorted(rows, np.arange(self.n + 1))
        self.terms = terms
        order = np.argsort(terms, kind="stable")
        self.rows, self.weights = rows[order], weights[order]
        self.start = np.searchsorted(terms[order], np.arange(IDS + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the terms of `seed`."""
        terms = self.terms[self.of[seed] : self.of[seed + 1]]
        first, sizes = self.start[terms], self.start[terms + 1] - self.start[terms]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)
        return np.bincount(self.rows[places], self.weights[places], minlength=self.n)

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents by score, then in order."""
        scores = np.where(unused, self.scores(seed), -1.0)
        few = min(NEIGHBOURS, self.n - 1)
        best = np.argpartition(-scores, few)[:few] if few else np.zeros(0, dtype=np.int64)
        best = best[scores[best] > 0]
        # Equal scores in order; those equal to the last of the few come with the others.
        best = best[np.lexsort((best, -scores[best]))]
        given = set(best.tolist())
        yield from best.tolist()
        for place in np.lexsort((np.arange(self.n), -scores)).tolist():
            if unused[place] and place not in given:
                yield place


Piece = tuple[int, int, int, int, int]


def fill(ids: list[np.ndarray], shard: Shard, window: int) -> tuple[list[Piece], list[tuple[int, int]]]:
    """Pieces (sequence, document, start, length, offset) of full windows; what is left over.

    The left-overs, (document, start), are fewer tokens than a window.
    """
    at = np.zeros(len(ids), dtype=np.int64)
    left = np.array([len(x) for x in ids])
    unused = left > 0
    total, sequence, seed = int(left.sum()), 0, 0
    pieces: list[Piece] = []
    while total >= window:
        while not unused[seed]:
            seed = (seed + 1) % len(ids)
        offset = 0
        places: Iterator[int] | None = None
        place = seed
        unused[seed] = False
        while True:
            length = min(int(left[place]), window - offset)
            pieces.append((sequence, place, int(at[place]), length, offset))
            at[place] += length
            left[place] -= length
            unused[place] = left[place] > 0
            offset += length
            if offset == window:
                break
            places = places or shard.neighbours(seed, unused)
            place = next(places)
        # The rest of what was cut goes on in the next window.
        seed = place
        total -= window
        sequence += 1
    return pieces, [(i, int(at[i])) for i in np.flatnonzero(left > 0).tolist()]


class _Packer:
    """Takes documents one by one and gives out pieces."""

    def __init__(self, task: int, idf: np.ndarray, mean: float, window: int, shard_tokens: int):
        self.idf, self.mean, self.window, self.limit = idf, mean, window, shard_tokens
        self.next = task << 32
        self.keys: list[tuple] = []
        self.starts: list[int] = []
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.out: list[tuple] = []

    def _give(self, key: tuple, start: int, ids: np.ndarray, sequence: int, offset: int) -> None:
        check = zlib.crc32(ids.astype("<u4").tobytes())
        self.out.append((*key, start, len(ids), check, sequence, offset))

    def add(self, key: tuple, ids: np.ndarray) -> None:
        full = len(ids) // self.window * self.window
        for start in range(0, full, self.window):
            self._give(key, start, ids[start : start + self.window], self.next, 0)
            self.next += 1
        if full < len(ids):
            self.keys.append(key)
            self.starts.append(full)
            self.ids.append(ids[full:])
            self.held += len(ids) - full
            if self.held >= self.limit:
                self.pack()

    def pack(self) -> None:
        if not self.ids:
            return
        pieces, left = fill(self.ids, Shard(self.ids, self.idf, self.mean), self.window)
        for sequence, i, start, length, offset in pieces:
            ids = self.ids[i][start : start + length]
            self._give(self.keys[i], self.starts[i] + start, ids, self.next + sequence, offset)
        self.next += pieces[-1][0] + 1 if pieces else 0
        self.keys = [self.keys[i] for i, _ in left]
        self.starts = [self.starts[i] + start for i, start in left]
        self.ids = [self.ids[i][start:] for i, start in left]
        self.held = sum(map(len, self.ids))

    def finish(self) -> None:
        """The last sequence, which may be short."""
        self.pack()
        offset = 0
        for key, start, ids in zip(self.keys, self.starts, self.ids):
            self._give(key, start, ids, self.next, offset)
            offset += len(ids)

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * 9
        self.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES
        )


_NAMES = [*KEY, "doc_tokens", "start", "length", "ids_crc32", "sequence_id", "offset"]
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 7]
_SCHEMA = f"{KEY_TYPES}, " + ", ".join(f"{name} long" for name in _NAMES[3:])


def _pack(idf: np.ndarray, mean: float, window: int, shard_tokens: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), idf, mean, window, shard_tokens)
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in [*KEY, "n_tokens"]))
            for key, ids in zip(keys, batch.column("ids")):
                packer.add(key, np.frombuffer(ids.as_buffer(), dtype=np.uint16))
            yield packer.taken()
        packer.finish()
        yield packer.taken()

    return pack


def pack_documents(
    docs: DataFrame,
    window: int = WINDOW,
    vocabulary: str = VOCABULARY,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """doc_id, tkey, tsum, start, length, ids_crc32, doc_tokens, sequence_id, offset: all pieces.

    A document's ids are those of its text by the vocabulary, and END; a missing or empty text has
    END alone. Every id lies in exactly one piece: `start` is its document's ids before it, `offset`
    the tokens before it in its sequence, `ids_crc32` the checksum of its ids as unsigned
    little-endian 32-bit numbers, `doc_tokens` all ids of the document. Sequences hold `window`
    tokens, but for one of each partition. Rows that repeat are packed each. An empty table gives
    no pieces.
    """
    spark = prepare(docs.sparkSession)
    table = durable(
        keyed(docs).mapInArrow(
            _encode(vocabulary),
            f"{KEY_TYPES}, n_tokens long, ids binary, first int, second int, terms array<long>, counts array<long>",
        ),
        "ids",
    )
    rows = table.where("ids IS NOT NULL").select(*KEY, "n_tokens", "ids", "first", "second")
    n, tokens = rows.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    # One row per term of the vocabulary at most.
    seen = (
        table.where("ids IS NULL")
        .select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        .groupBy(F.col("x.terms").alias("term"))
        .agg(F.sum("x.counts").alias("n"))
    ).toArrow()
    held = np.zeros(IDS)
    held[seen.column("term").to_numpy()] = seen.column("n").to_numpy()
    idf = np.log((n - held + 0.5) / (held + 0.5))
    few = min(2 * spark.sparkContext.defaultParallelism, -(-(tokens or 0) // LEAST_PARTITION))
    parts = max(1, few, -(-(tokens or 0) // PARTITION_TOKENS))
    order = ["first", "second", *KEY]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Least length that counts: rests of documents, half a window on average.
    mean = min(window / 2, (tokens or 0) / max(n, 1)) or 1.0
    packed = ranged.mapInArrow(_pack(idf, mean, window, shard_tokens), _SCHEMA)
    return packed.select(
        doc_id(), "tkey", "tsum", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
