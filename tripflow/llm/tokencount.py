"""Token counts of sections, from one encoding of each whole document.

A document is encoded once, as a whole; encoding its sections one by one would change the tokens at
their borders. Byte-level tokens spell the text, so the lengths of a document's tokens add up to
their spans, and joining these to the sections' spans attributes every token. A token that lies
across a border goes by an explicit rule:

`first`     to the section of its first byte;
`largest`   to the section that holds most of its bytes, the earlier of equal ones;
`split`     to each section by its share of the bytes (the only rule with fractions).

Under each rule the counts of a document's sections add up to its tokens.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import doc_id, keyed, prepare
from tripflow.llm.text import texts_of
from tripflow.llm.tokens import encoder, ids_of

#: Vocabulary of byte-level tokens as ranks. Files of this form are on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RULES = ("first", "largest", "split")


@functools.cache
def _encoder(vocabulary: str):
    encoding = encoder(vocabulary)
    sizes = np.zeros(encoding.max_token_value + 1, dtype=np.int64)
    for rank in range(len(sizes)):
        with contextlib.suppress(KeyError):  # a rank that no token has
            sizes[rank] = len(encoding.decode_single_token_bytes(rank))
    return encoding, sizes


def lines_of(raw: np.ndarray) -> np.ndarray:
    """Ends of the lines of a text; a line break belongs to the line it ends."""
    ends = np.flatnonzero(raw == 10) + 1
    if len(raw) and (not len(ends) or ends[-1] != len(raw)):
        ends = np.append(ends, len(raw))
    return ends


def attribute(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; both kinds of spans cover the text without gaps or overlaps."""
    n = len(section_ends)
    if not len(token_ends) or not n:
        return np.zeros(n)
    token_starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, token_starts, side="right")
    last = np.searchsorted(section_ends, token_ends, side="left")
    counts = np.bincount(first[first == last], minlength=n).astype(float)
    section_starts = np.concatenate([[0], section_ends[:-1]])
    for token in np.flatnonzero(first != last):
        over = np.arange(first[token], last[token] + 1)
        shared = np.minimum(section_ends[over], token_ends[token]) - np.maximum(
            section_starts[over], token_starts[token]
        )
        if rule == "split":
            counts[over] += shared / shared.sum()
        else:
            counts[over[0] if rule == "first" else over[int(shared.argmax())]] += 1
    return counts


def token_counts(
    docs: DataFrame,
    rule: str = "largest",
    vocabulary: str = VOCABULARY,
    sections: Callable[[np.ndarray], np.ndarray] = lines_of,
) -> DataFrame:
    """doc_id, tkey, section, start, end, n_tokens: tokens of each section of each row.

    `sections` gives the ends of the sections of a text in UTF-8 bytes; they cover the text, and a
    section is never empty. `start` and `end` are byte offsets, sections are numbered from 0. A
    text without bytes has one section, 0, of no tokens. Rows that repeat are reported each.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    prepare(docs.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = _encoder(vocabulary)
        for batch in batches:
            column = batch.column("text")
            for first, data, offsets in texts_of(column):
                rows, parts = [], []
                for i in range(len(offsets) - 1):
                    raw = data[offsets[i] : offsets[i + 1]]
                    text = raw.tobytes().decode()
                    tokens = np.array(ids_of(encoding, text), dtype=np.int64)
                    ends = sections(raw) if len(raw) else np.zeros(1, dtype=np.int64)
                    counts = attribute(np.cumsum(sizes[tokens]), ends, rule)
                    starts = np.concatenate([[0], ends[:-1]])
                    rows.append(np.full(len(ends), first + i))
                    parts.append(np.stack([np.arange(len(ends)), starts, ends, counts]))
                which = pa.array(np.concatenate(rows))
                number, start, end, counts = np.concatenate(parts, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ord").take(which),
                        batch.column("tkey").take(which),
                        pa.array(number.astype(np.int32)),
                        pa.array(start.astype(np.int64)),
                        pa.array(end.astype(np.int64)),
                        pa.array(counts),
                    ],
                    names=["ord", "tkey", "section", "start", "end", "n_tokens"],
                )

    schema = "ord long, tkey int, section int, start long, end long, n_tokens double"
    out = keyed(docs).mapInArrow(count, schema)
    number = F.col("n_tokens") if rule == "split" else F.col("n_tokens").cast("long")
    return out.select(doc_id(), "tkey", "section", "start", "end", number.alias("n_tokens"))
