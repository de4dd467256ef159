"""Benchmark items inside documents, by CGK embedding and bit-sampling LSH.

Item and text are sequences of words (runs of letters and digits, A-Z lower-cased). A document
leaks an item of m words if some passage of it is fewer than m / 5 word edits away.

1. Windows of the item's length are placed where the document holds one of d + 1 disjoint pieces
   of the item, d being the most edits allowed: of so many pieces at least one survives d edits,
   so no leak is left out.
2. The CGK embedding walks over a sequence, writes down the word it stands on at every step, and
   moves on or not by a random bit of (step, word): sequences with few edits fall into step again,
   so edit distance becomes Hamming distance of what was written. A repetition of bit sampling
   compares K steps of one walk; a window and an item that agree in all K steps of any repetition
   are candidates. The repetitions needed for the target recall come from walks over simulated
   leaks with d edits. Where d is 0, every window is a candidate.
3. Candidates are verified by the exact edit distance of the item to the best passage around the
   window.

Documents are read once and not shuffled. Items reach the tasks in blocks of bounded size, each
block a pass over the documents; a larger benchmark means more passes, not a larger broadcast.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import doc_id, keyed, prepare, text_of
from tripflow.llm.text import WORDS, Words, mix, texts_of

RECALL = 0.99
#: One edit for every so many words is too many.
WORDS_PER_EDIT = 5
#: Longest piece of an item that is looked up.
PIECE = 4
WALKS = 3
SAMPLED = 2
#: Characters of items in one block.
BLOCK_CHARS = 20_000_000
#: Windows that walk at once, places looked up at once, and words of a text verified at once.
WALKED = 1 << 13
LOOKED = 1 << 18
VERIFIED = 1 << 18
_NONE = np.uint64(0)


def max_edits(words: int) -> int:
    return max(0, math.ceil(words / WORDS_PER_EDIT) - 1)


def _steps(words: int) -> int:
    """Steps of a walk that are compared: most walks have not left the sequence by then."""
    return 2 * words


def _walk(tokens: np.ndarray, bases: np.ndarray, sizes: np.ndarray, low, high, walk: int, steps: int):
    """Words under the walker at each step, one row per sequence.

    Sequence i are `sizes[i]` tokens from `bases[i]`; what lies outside [low, high) is empty.
    """
    out = np.zeros((len(bases), steps), dtype=np.uint64)
    at = np.zeros(len(bases), dtype=np.int64)
    seeds = mix(np.arange(1, steps + 1, dtype=np.uint64) + np.uint64(walk << 32))
    last = len(tokens) - 1
    for step in range(steps):
        place = bases + at
        inside = (at < sizes) & (place >= low) & (place < high)
        here = np.where(inside, tokens[np.clip(place, 0, last)], _NONE)
        out[:, step] = here
        # Outside a sequence the walker goes on as over any other word.
        at += (mix(here ^ seeds[step]) & np.uint64(1)).astype(np.int64)
    return out


@functools.cache
def repetitions(words: int, recall: float = RECALL) -> int:
    """Repetitions of bit sampling per walk that find a leak with most edits at this recall.

    Edits are drawn at random places of sequences of different words; the share of agreeing steps
    that 95 of 100 simulated pairs exceed is taken as that of a leak.
    """
    edits, steps = max_edits(words), _steps(words)
    if edits == 0:
        return 1
    rng = np.random.default_rng(words)
    texts = []
    for _ in range(100):
        item = rng.integers(1, 1 << 62, words).tolist()
        text = list(item)
        for _ in range(edits):
            kind, place = int(rng.integers(3)), int(rng.integers(len(text)))
            if kind == 0:
                text[place] = int(rng.integers(1, 1 << 62))
            elif kind == 1:
                text.insert(place, int(rng.integers(1, 1 << 62)))
            else:
                del text[place]
        texts += [item, (text + [7] * words)[:words]]
    flat = np.array(texts, dtype=np.uint64).ravel()
    bases, sizes = np.arange(len(texts)) * words, np.full(len(texts), words)
    shares = []
    for walk in range(WALKS):
        seen = _walk(flat, bases, sizes, bases, bases + words, walk, steps)
        shares += list(((seen[::2] == seen[1::2]) & (seen[::2] != _NONE)).mean(axis=1))
    share = max(0.02, float(np.quantile(shares, 0.05)))
    needed = math.log(1 - recall) / math.log(1 - share**SAMPLED)
    return max(1, math.ceil(needed / WALKS))


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest edits that turn `item` into a passage of `text`, and the passage's first end."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    places = np.arange(len(text) + 1)
    for i, word in enumerate(item, 1):
        best = np.empty_like(row)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(best - places) + places
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """A block of items, ready to be looked up in texts."""

    def __init__(self, ids: list[int], texts: list[str], recall: float):
        self.ids = ids
        column = pa.array(texts, pa.string())
        parts = [
            np.split(w.hashes(), w.rows[1:-1])
            for _, data, offsets in texts_of(column)
            for w in (Words(data, offsets, lower=True, letters=True),)
        ]
        self.items = [x for part in parts for x in part]
        self.sizes = np.array([len(x) for x in self.items], dtype=np.int64)
        self.pieces = {}
        found: dict[int, list] = {}
        for number, words in enumerate(self.items):
            if not len(words):
                continue
            every = len(words) // (max_edits(len(words)) + 1)
            width = min(PIECE, every)
            windows = WORDS.windows(WORDS.prefix(words), width)
            for piece in range(max_edits(len(words)) + 1):
                found.setdefault(width, []).append((windows[piece * every], number, piece * every))
        for width, entries in found.items():
            entries.sort(key=lambda e: int(e[0]))
            hashes, numbers, offsets = zip(*entries)
            hashes = np.array(hashes, dtype=np.uint64)
            bits = np.zeros(1 << 20, dtype=bool)
            bits[hashes & np.uint64((1 << 20) - 1)] = True
            self.pieces[width] = (hashes, np.array(numbers), np.array(offsets), bits)
        self.flat = np.concatenate(self.items) if self.items else np.zeros(0, dtype=np.uint64)
        self.bases = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.turns = {m: repetitions(m, recall) for m in set(self.sizes[self.sizes > 0].tolist())}

    def _placed(self, prefix: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Windows (row, item, first word) that hold a piece of the item at its place, in order."""
        # The furthest that a window starts before its row's words, and the span of all starts.
        before = int(self.sizes.max())
        span = before + len(prefix)
        ends = np.repeat(rows[1:], np.diff(rows))
        out = [np.zeros(0, dtype=np.int64)]
        for width, (hashes, numbers, offsets, bits) in self.pieces.items():
            grams = WORDS.windows(prefix, width)
            near = np.flatnonzero(bits[grams & np.uint64((1 << 20) - 1)])
            near = near[near + width <= ends[near]]
            for at in range(0, len(near), LOOKED):
                some = near[at : at + LOOKED]
                first = np.searchsorted(hashes, grams[some], side="left")
                count = np.searchsorted(hashes, grams[some], side="right") - first
                places = np.repeat(some, count)
                entry = np.repeat(first, count) + np.arange(len(places))
                entry -= np.repeat(np.cumsum(count) - count, count)
                row = np.searchsorted(rows, places, side="right") - 1
                pair = row * len(self.items) + numbers[entry]
                out.append(np.unique(pair * span + (places - offsets[entry] + before)))
        found = np.unique(np.concatenate(out))
        pair, start = found // span, found % span - before
        return np.stack([pair // len(self.items), pair % len(self.items), start], axis=1)

    def _candidates(self, tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
        prefix = WORDS.prefix(tokens)
        placed = self._placed(prefix, rows)
        sizes = self.sizes[placed[:, 1]]
        # Walks may have left items this short; without edits there is nothing to choose by.
        chosen = sizes <= WORDS_PER_EDIT
        # Windows of similar length walk together.
        lengths = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
        for group in np.unique(lengths[~chosen]):
            members = np.flatnonzero((lengths == group) & ~chosen)
            row, item, start = placed[members].T
            low, high, m = rows[row], rows[row + 1], sizes[members]
            begin, end = np.clip(start, low, high), np.clip(start + m, low, high)
            # What a walker sees of the window: its words, and how many are missing before them.
            seen = mix(WORDS.ranges(prefix, begin, end) ^ mix((item << 32 | (begin - start)) + 1))
            _, first, same = np.unique(seen, return_index=True, return_inverse=True)
            met = np.zeros(len(first), dtype=bool)
            for at in range(0, len(first), WALKED):
                some = first[at : at + WALKED]
                met[at : at + WALKED] = self._agree(tokens, item[some], start[some], low[some], high[some])
            chosen[members] = met[same]
        return placed[chosen]

    def _agree(self, tokens: np.ndarray, items: np.ndarray, starts: np.ndarray, low, high) -> np.ndarray:
        """Whether window and item agree in all sampled steps of some repetition."""
        sizes, bases = self.sizes[items], self.bases[items]
        steps = _steps(int(sizes.max()))
        met = np.zeros(len(items), dtype=bool)
        for walk in range(WALKS):
            text = _walk(tokens, starts, sizes, low, high, walk, steps)
            item = _walk(self.flat, bases, sizes, bases, bases + sizes, walk, steps)
            agree = (text == item) & (item != _NONE)
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                rng = np.random.default_rng([walk, int(size)])
                shape = (self.turns[int(size)], min(SAMPLED, _steps(int(size))))
                sampled = rng.integers(0, _steps(int(size)), shape)
                met[same] |= agree[same][:, sampled].all(axis=2).any(axis=1)
        return met

    def _best(self, tokens: np.ndarray, item: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, first word, end word) of the item's best passage in [low, high), if a leak."""
        wanted = self.items[item]
        slack = max_edits(len(wanted))
        longest = len(wanted) + slack
        best = None
        for at in range(low, high, VERIFIED):
            edits, end = distance(wanted, tokens[at : min(high, at + VERIFIED + longest)])
            if edits > slack or (best and edits >= best[0]):
                continue
            end += at
            begin = max(low, end - longest)
            _, length = distance(wanted[::-1], tokens[begin:end][::-1])
            best = (edits, end - length, end)
        return best

    def leaks(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, edits, first word, end word) of the best passage of each row and item."""
        if not len(self.flat):
            return
        for first, data, offsets in texts_of(column):
            words = Words(data, offsets, lower=True, letters=True)
            if not len(words.starts):
                continue
            tokens, rows = words.hashes(), words.rows
            row, item, place = self._candidates(tokens, rows).T
            slack = np.array([max_edits(int(n)) for n in self.sizes])[item]
            low = np.maximum(rows[row], place - slack)
            high = np.minimum(rows[row + 1], place + self.sizes[item] + slack)
            # Candidates are in order of row, item, place: those that overlap follow each other.
            apart = (np.diff(row) != 0) | (np.diff(item) != 0) | (low[1:] >= high[:-1])
            starts = np.flatnonzero(np.concatenate([[True], apart])) if len(row) else row
            ends = np.append(starts[1:], len(row))[: len(starts)] - 1
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for a, b in zip(starts.tolist(), ends.tolist()):
                key, origin = (int(row[a]), int(item[a])), int(rows[row[a]])
                found = self._best(tokens, key[1], int(low[a]), int(high[b]))
                if found:
                    found = (found[0], found[1] - origin, found[2] - origin)
                    best[key] = min(found, best.get(key, found))
            for key, found in sorted(best.items()):
                yield first + key[0], key[1], *found


def _blocks(benchmark: DataFrame, recall: float) -> Iterator[Items]:
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")
    ).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / (BLOCK_CHARS / 2)))
    for block in range(blocks):
        # About half the bound on average; a block is a share of the items by hash.
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield Items([r.item_id for r in rows], [r.text for r in rows], recall)


def find_leaks(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, tkey, item_id, item_words, edits, start, end: documents and the items they leak.

    One row for each row of `docs` and each item of which it holds a passage fewer than
    item_words / 5 edits away, with the best passage as a half-open range of words (of equal ones
    about the earliest: in a run of overlapping windows the first to end, and the shortest). Items without words leak nowhere; equal items are reported each under its id, and
    a missing item_id stays missing. Columns other than doc_id, text, item_id are ignored.
    """
    spark = prepare(docs.sparkSession)
    rows = keyed(docs)
    schema = "ord long, tkey int, item_id long, item_words int, edits int, start int, end int"
    found = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, recall):
        sent = spark.sparkContext.broadcast(items)

        def look(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                hits = list(items.leaks(batch.column("text")))
                which = pa.array([h[0] for h in hits], pa.int64())
                numbers = [h[1] for h in hits]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ord").take(which),
                        batch.column("tkey").take(which),
                        pa.array([items.ids[n] for n in numbers], pa.int64()),
                        pa.array([int(items.sizes[n]) for n in numbers], pa.int32()),
                        *(pa.array([h[k] for h in hits], pa.int32()) for k in (2, 3, 4)),
                    ],
                    names=["ord", "tkey", "item_id", "item_words", "edits", "start", "end"],
                )

        found = found.unionByName(rows.mapInArrow(look, schema))
    return found.select(doc_id(), "tkey", "item_id", "item_words", "edits", "start", "end")


def decontaminate(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """The rows of `docs` that leak no item, with the columns of `docs`; nothing is shuffled."""
    prepare(docs.sparkSession)
    for items in _blocks(benchmark, recall):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for hit in sent.value.leaks(batch.column("text")):
                    clean[hit[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
