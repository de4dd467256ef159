"""Rows of one doc_id whose texts differ and have the same checksum."""

import hashlib
import zlib

import pytest
from test_operators import prose

from tripflow.llm.near_dup import keep_one
from tripflow.llm.parsing import byte_dedup
from tripflow.llm.quality import judged
from tripflow.llm.rows import prepare
from tripflow.llm.substring import cut_repeats, substring_dedup


def with_one_checksum(one, two):
    """Both texts with a word added, after which their checksums are equal."""
    base, other = zlib.crc32(f"{one} ".encode()), zlib.crc32(f"{two} ".encode())
    words = [hashlib.md5(b"%d" % n).hexdigest()[:10] for n in range(400_000)]
    ends = {zlib.crc32(w.encode(), base): w for w in words}
    word = next(w for w in words if zlib.crc32(w.encode(), other) in ends)
    return f"{one} {ends[zlib.crc32(word.encode(), other)]}", f"{two} {word}"


REPEATED = prose(80, 51)
ONE, TWO = with_one_checksum(prose(90, 52), REPEATED)
CLEAN, JUNK = with_one_checksum(prose(90, 53), "word " * 90)


def rows_of(spark, rows):
    return prepare(spark).createDataFrame(rows, "doc_id long, text string")


def texts(frame):
    return sorted(r.text for r in frame.collect())


def test_texts_have_one_checksum():
    for a, b in ((ONE, TWO), (CLEAN, JUNK)):
        assert a != b and zlib.crc32(a.encode()) == zlib.crc32(b.encode())


@pytest.mark.parametrize("doc_id", [None, 9])
def test_each_text_is_a_document(spark, doc_id):
    docs = rows_of(spark, [(doc_id, ONE), (doc_id, TWO), (doc_id, ONE)])
    assert texts(keep_one(docs)) == sorted([ONE, TWO])


@pytest.mark.parametrize("doc_id", [None, 9])
def test_a_text_is_judged_by_itself(spark, doc_id):
    docs = rows_of(spark, [(doc_id, CLEAN), (doc_id, JUNK), (1, CLEAN)])
    assert texts(judged(docs)) == [CLEAN, CLEAN]


@pytest.mark.parametrize("doc_id", [None, 9])
def test_a_text_loses_its_own_passages_only(spark, doc_id):
    docs = rows_of(spark, [(1, REPEATED), (doc_id, ONE), (doc_id, TWO)])
    last = TWO.rsplit(" ", 1)[1]
    assert texts(cut_repeats(docs)) == sorted([REPEATED, ONE, last])
    kept = [(r.n_words, r.kept_text) for r in substring_dedup(docs).where("n_words > 80").collect()]
    assert sorted(kept) == sorted([(91, ONE), (81, last)])


@pytest.mark.parametrize("group, pairwise", [(1, 1), (100, 64)])
def test_a_text_loses_its_own_bytes_only(spark, group, pairwise):
    docs = rows_of(spark, [(1, REPEATED), (None, ONE), (None, TWO)])
    found = [bytes(r.kept).decode() for r in byte_dedup(docs, group=group, pairwise=pairwise).collect()]
    assert sorted(found) == sorted([REPEATED, ONE, TWO[len(REPEATED) :]])
