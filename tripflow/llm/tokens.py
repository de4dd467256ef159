"""Token ids of whole texts by a byte-level vocabulary."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

#: How texts are cut before tokens merge. Fixed value that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# What \s stands for there, and a run of it for which the pattern's look-ahead would need more
# stack than the encoder has.
_BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG = 50_000
_LONG_RUN = re.compile(f"{_BLANK}{{{LONG},}}")


@functools.cache
def encoder(vocabulary: str):
    """The encoder of a file of ranks (base64 token and rank on each line)."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _pieces(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of a text, cut where the pattern cuts anyway; true for a long run of blanks.

    Before a word the pattern leaves a run's last blank to what follows.
    """
    at = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        yield text[at : run.start()], False
        yield text[run.start() : end], True
        at = end
    yield text[at:], False


def ids_of(encoding, text: str) -> list[int]:
    """Ids of a text, in which the names of special tokens are ordinary text."""
    if len(text) < LONG:
        return encoding.encode_ordinary(text)
    out: list[int] = []
    for piece, blank in _pieces(text):
        if blank:
            out += encoding._core_bpe.encode_single_piece(piece.encode())
        else:
            out += encoding.encode_ordinary(piece)
    return out
