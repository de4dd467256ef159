"""Spelling variants of frequent words, by blocked Gram matrices of letter counts.

1. Words are counted in the scan tasks before the shuffle.
2. A word's letters go to CLASSES classes; the number of letters in each is its cell, and their sum
   its length. One inserted letter raises one class by one, a replaced one moves one letter from a
   class to another or stays within it, so near words lie in the same cell or in one of a few
   around it: no pair is lost, and only blocks of the same or the next length meet.
3. A block of a cell's words is multiplied with the words of the cells around it: with letter
   counts x and y, |x|^2 + |y|^2 - 2xy is their squared distance, 1 for an insertion, 2 for a
   replacement. Only pairs at most two apart leave the product, and their spelling decides.
4. Forms are followed to the last by doubling: a form is five times as frequent as its word, so
   chains are short.

Cells of any size are split: their words into blocks, the words around them into slices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import prepare, text_of
from tripflow.session import durable

# Fixed values of the contract: letters, and the least length and number of a word.
RUN = r"[A-Za-zÀ-ÿ]+"
LETTERS = [*map(chr, range(0x61, 0x7B)), *map(chr, range(0xC0, 0x100))]
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: How many times more frequent a word's form is than the word.
FACTOR = 5
#: Classes of letters; a letter's class is its code point modulo this.
CLASSES = 5
#: Words and letters of a block, and of a slice of the words around it.
BLOCK_WORDS = 1024
SLICE_WORDS = 8192
BLOCK_LETTERS = 1 << 22
#: Up to this length, products of letter counts are exact in single precision.
SINGLE = 4000

_UPPER = "".join(map(chr, range(65, 91)))


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, run: every maximal run of letters of every text, A-Z lower-cased.

    Rows that repeat give their runs again; a missing or empty text gives none.
    """
    text = F.translate(text_of(), _UPPER, _UPPER.lower())
    found = F.regexp_extract_all(text, F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def without_letter(word: Column, place: Column) -> Column:
    """`word` without its code point at `place`, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))


def counted(
    words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """word, n: the different values of column `word`, counted; short and rare ones left out."""
    long_enough = words.where(F.char_length("word") >= least_letters)
    counts = long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced between `a` and `b`."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:  # the length of the longest common beginning
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    rest = b[low + 1 :]
    return a[low:] == rest if len(a) < len(b) else a[low + 1 :] == rest


_PLACES = np.zeros(0x100, dtype=np.int64)
_PLACES[[ord(x) for x in LETTERS]] = np.arange(len(LETTERS))


def letter_counts(words: list[str]) -> np.ndarray:
    """One row per word, one column per letter."""
    lengths = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    rows = np.repeat(np.arange(len(words)), lengths)
    flat = np.bincount(
        rows * len(LETTERS) + _PLACES[codes], minlength=len(words) * len(LETTERS)
    )
    kind = np.float32 if lengths.max(initial=0) <= SINGLE else np.float64
    return flat.reshape(len(words), -1).astype(kind)


# Parts a word plays in a block.
INSIDE, AROUND, SAME_CELL = 0, 1, 2


def _near_pairs(block: pa.Table) -> pa.Table:
    """Near pairs of one block and one slice of the words around it.

    Words of one cell meet in both orders, of which one is kept.
    """
    names = block.column("word").combine_chunks()
    words, counts = names.to_pylist(), block.column("n").to_numpy()
    role = block.column("role").to_numpy()
    left, right = np.flatnonzero(role == INSIDE), np.flatnonzero(role != INSIDE)
    vectors = letter_counts(words)
    squares = (vectors * vectors).sum(axis=1)
    found: list[tuple[int, int]] = []
    for first in range(0, len(right), BLOCK_WORDS):
        part = right[first : first + BLOCK_WORDS]
        distance = squares[left][:, None] + squares[part][None, :]
        distance -= 2 * (vectors[left] @ vectors[part].T)
        i, j = np.nonzero((distance > 0) & (distance <= 2))
        for a, b in zip(left[i].tolist(), part[j].tolist()):
            once = role[b] == AROUND or words[a] < words[b]
            if once and one_edit(words[a], words[b]):
                found.append((a, b))
    a, b = (np.array([pair[k] for pair in found], dtype=np.int64) for k in (0, 1))
    return pa.table(
        [names.take(pa.array(a)), pa.array(counts[a]), names.take(pa.array(b)), pa.array(counts[b])],
        names=["a", "a_n", "b", "b_n"],
    )


def _cell() -> Column:
    """Letters of the word in each class."""
    classes = ["".join(x for x in LETTERS if ord(x) % CLASSES == i) for i in range(CLASSES)]
    length = F.char_length("word")
    return F.array(*[length - F.char_length(F.translate("word", x, "")) for x in classes])


def _centres() -> Column:
    """The cells around which a cell's words lie: its own, and those one edit below it."""

    def moved(change: dict[int, int]) -> Column:
        return F.array(*[F.col("cell")[i] + change.get(i, 0) for i in range(CLASSES)])

    changes: list[dict[int, int]] = [{}]
    changes += [{i: -1} for i in range(CLASSES)]
    changes += [{i: -1, j: 1} for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    return F.array(*map(moved, changes))


def near_words(counts: DataFrame) -> DataFrame:
    """word, n, near, near_n: every near word of every word. `counts`: word, n, each word once."""
    placed = durable(counts.select("word", "n", _cell().alias("cell")), "words")
    share = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_WORDS, F.sum(F.length("word")) / BLOCK_LETTERS))
    sizes = placed.groupBy("cell").agg(share.alias("blocks"), F.count(F.lit(1)).alias("held"))
    sizes = durable(sizes.withColumn("id", F.monotonically_increasing_id()), "cells")
    # Which cells lie around which, and how many words that makes: rows of cells, not of words.
    links = sizes.select("cell", "held", F.explode(_centres()).alias("centre"))
    links = links.join(
        sizes.select(F.col("cell").alias("centre"), "id", "blocks"), "centre"
    )
    slices = F.ceil(F.sum("held") / SLICE_WORDS)
    cut = links.groupBy("id").agg(slices.alias("slices"))
    links = durable(links.join(cut, "id").select("cell", "centre", "id", "blocks", "slices"), "links")

    def part(n: str) -> Column:
        return F.pmod(F.xxhash64("word"), F.col(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    role = F.when(F.col("cell") == F.col("centre"), SAME_CELL).otherwise(AROUND)
    around = placed.join(links, "cell").select(
        "id", every("blocks").alias("block"), part("slices").alias("slice"), "word", "n",
        role.alias("role"),
    )
    inside = placed.join(links.where("cell = centre"), "cell").select(
        "id", part("blocks").alias("block"), every("slices").alias("slice"), "word", "n",
        F.lit(INSIDE).alias("role"),
    )
    pairs = durable(
        inside.union(around)
        .groupBy("id", "block", "slice")
        .applyInArrow(_near_pairs, "a string, a_n long, b string, b_n long"),
        "near",
    )
    return pairs.toDF("word", "n", "near", "near_n").union(pairs.select("b", "b_n", "a", "a_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: each word with a form, and the last of the forms that follow."""
    roots = durable(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = durable(
            roots.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        roots = after.select("word", "root")
        if after.where("moved").isEmpty():
            return roots


def spelling_variants(counts: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each row of `counts` (word, n).

    `word` is made of LETTERS, not null, and occurs once in `counts`. Words are near if exactly one
    code point is inserted, deleted or replaced; `n_near` counts a word's near words. Its `form` is
    the near word of largest n, the first in code-point order of equal ones, if that is at least
    `factor` times the word's own; `form_n` its n; both null if there is none. `root` follows forms
    to the last, and is the word itself where there is none. An empty table gives an empty one.
    """
    prepare(counts.sparkSession)
    counts = durable(counts.select("word", "n"), "counts")
    first = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    best = near_words(counts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("top"))
    chosen = F.when(-F.col("top.order") >= factor * F.col("n"), F.col("top"))
    joined = counts.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        chosen["near"].alias("form"),
        (-chosen["order"]).alias("form_n"),
    )
    found = durable(joined, "forms")
    roots = _roots(found.where("form IS NOT NULL"))
    last = F.coalesce("root", "word").alias("root")
    return found.join(roots, "word", "left").select("word", "form", last, "n", "n_near", "form_n")
