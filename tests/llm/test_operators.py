"""Operators on texts against brute force, and on rows that are missing, empty, long or repeated."""

import hashlib
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import TESTDATA
from tripflow.llm import classifier, queries, toxicity
from tripflow.llm.components import components
from tripflow.llm.decontaminate import decontaminate, distance, find_leaks, max_edits
from tripflow.llm.mixing import mix_sources, schedule, source_weights
from tripflow.llm.near_dup import keep_one, near_duplicates
from tripflow.llm.parsing import byte_dedup
from tripflow.llm.quality import ablation, judged, ledger, passes
from tripflow.llm.rows import prepare
from tripflow.llm.sketch import Sketcher
from tripflow.llm.substring import cut_repeats, substring_dedup
from tripflow.llm.text import WORD, lowest_in_window
from tripflow.llm.tokencount import attribute, token_counts
from tripflow.llm.urls import candidates, intervals, judge

SMALL = str(TESTDATA / "sf0.001")
rng = np.random.default_rng(5)
VOCABULARY = ["".join(rng.choice(list(string.ascii_lowercase), 5)) for _ in range(400)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


LONG = prose(20_000, 1)
SHARED = prose(120, 2)
ITEM = prose(30, 3)
BASE = prose(200, 4)


def changed(text, places, word="zzzzz"):
    words = text.split(" ")
    for place in places:
        words[place] = word
    return " ".join(words)


ROWS = [
    (1, BASE, "en", "a"),
    (2, changed(BASE, [10]), "en", "a"),
    (3, changed(BASE, [150]), "en", "b"),
    (3, changed(BASE, [150]), "en", "b"),
    (4, None, None, None),
    (5, "", "en", "a"),
    (6, " \t\n ", "en", ""),
    (None, prose(60, 6), "en", "a"),
    (None, None, None, None),
    (7, LONG, "en", "a"),
    (8, LONG, "en", "c"),
    (9, prose(30, 7) + " " + SHARED + " " + prose(40, 8), "en", "a"),
    (10, prose(35, 9) + " " + SHARED, "en", "a"),
    (10, SHARED + " " + prose(25, 10), "en", "a"),
    (11, prose(50, 11) + " " + changed(ITEM, [4, 17]) + " " + prose(50, 12), "en", "b"),
    (12, "one two", "en", "b"),
    (13, "ONE two", "en", "b"),
    (14, (prose(12, 13) + "\n") * 9, "en", "b"),
    (15, "caf\u00e9 \u2603 " * 60, "fr", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    """Also columns whose names the operators use themselves."""
    rows = prepare(spark).createDataFrame(ROWS, SCHEMA)
    return rows.withColumns(
        {n: F.lit(7) for n in ("ord", "tkey", "share", "slot", "label", "n", "bucket", "words", "n_chars")}
    )


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def words_of(text):
    return re.findall(WORD, text or "")


def test_substrings_against_brute_force(docs, none):
    first = {}
    order = lambda i: 1 << 62 if i is None else i
    for i, text, *_ in ROWS:
        w = words_of(text)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(order(i), first.get(key, 1 << 62))
    expected = []
    for i, text, *_ in ROWS:
        w = words_of(text)
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < order(i):
                keep[k : k + 50] = [False] * 50
        expected.append((i, len(w), " ".join(x for x, y in zip(w, keep) if y)))
    found = [(r.doc_id, r.n_words, r.kept_text) for r in substring_dedup(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert substring_dedup(none).count() == 0
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns
    assert cut.where("doc_id = 8").count() == 0 and cut.where("doc_id = 3").count() == 2


@pytest.mark.parametrize("group, pairwise", [(1, 1), (2, 2), (100, 1), (100, 64)])
def test_bytes_against_brute_force(docs, none, group, pairwise):
    data = {(i, t or "") for i, t, *_ in ROWS}
    order = sorted(data, key=lambda r: (1 << 62 if r[0] is None else r[0], _checksum(r[1])))
    seen, expected = set(), {}
    for i, text in order:
        raw = text.encode()
        keep = np.ones(len(raw), dtype=bool)
        for k in range(len(raw) - 99):
            piece = raw[k : k + 100]
            if piece in seen:
                keep[k : k + 100] = False
            seen.add(piece)
        expected[i, len(raw), _checksum(text)] = np.frombuffer(raw, np.uint8)[keep].tobytes()
    found = byte_dedup(docs, group=group, pairwise=pairwise).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert bytes(r.kept) == expected[r.doc_id, r.n_bytes, r.tkey]
        assert r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.removed)
    assert byte_dedup(none).count() == 0


def _checksum(text):
    import zlib

    return zlib.crc32(text.encode()) - (1 << 31)


def shingles(text):
    w = words_of((text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = {}
    for (i, _), x in zip(rows, label):
        ids[x] = min(ids.get(x, 1 << 62), 1 << 62 if i is None else i)
    return [(i, len(s), None if ids[x] == 1 << 62 else ids[x]) for (i, _), s, x in zip(rows, sets, label)]


def test_components_against_brute_force(docs, none):
    rows = [(i, t) for i, t, *_ in ROWS]
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(found, key=repr) == sorted(brute_components(rows), key=repr)
    assert near_duplicates(none).count() == 0
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(1) == 1 and not {2, 3, 8, 13} & set(ids) and 7 in ids and 12 in ids


def test_groups_without_a_centre(spark):
    """Chains and rings: members link to some of the group only."""
    rows, number = [], 0
    for group in range(6):
        base = prose(120, 100 + group)
        text = base
        for step in range(14):
            rows.append((number, text))
            number += 1
            text = changed(text, [(7 * step) % 120], f"new{step}")
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(frame).collect()]
    assert sorted(found) == sorted(brute_components(rows))


def test_sketch_estimates_similarity():
    sketcher = Sketcher(504)
    for n in (1, 3, 40, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut = max(1, n * 9 // 10)
        b = np.concatenate([a[:cut], rng.integers(0, 1 << 63, n - cut).astype(np.uint64)])
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        assert abs((sketcher.sketch(a) == sketcher.sketch(b)).mean() - true) < 0.09


def test_components_of_a_long_path(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(links.union(spark.createDataFrame([(500, 501)], "a long, b long")))
    assert {(r.label, r["count"]) for r in found.groupBy("label").count().collect()} == {(0, 201), (500, 2)}


def test_lowest_in_window():
    values = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    found = lowest_in_window(values, 31)
    assert found.tolist() == [k + int(values[k : k + 31].argmin()) for k in range(470)]
    assert len(lowest_in_window(values[:30], 31)) == 0


def test_leaks_against_brute_force(spark, docs, none):
    items = [(1, ITEM), (2, "one two"), (3, None), (4, ""), (None, prose(40, 77)), (6, ITEM.upper() + "!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("ord", F.lit(1))
    tokens = lambda t: [int.from_bytes(hashlib.md5(w.encode()).digest()[:7], "big") for w in re.findall(
        r"[0-9A-Za-z\x80-\U0010ffff]+", (t or "").lower())]
    expected = set()
    for i, text, *_ in ROWS:
        for number, item in items:
            w, t = np.array(tokens(item), dtype=np.uint64), np.array(tokens(text), dtype=np.uint64)
            if len(w) and distance(w, t)[0] <= max_edits(len(w)):
                expected.add((i, number, distance(w, t)[0]))
    found = find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in found} == expected
    assert (11, 1, 2) in expected and (12, 2, 0) in expected
    assert find_leaks(none, benchmark).count() == 0
    assert find_leaks(docs, benchmark.where("false")).count() == 0
    left = decontaminate(docs, benchmark)
    gone = {i for i, *_ in expected}
    assert left.columns == docs.columns
    assert left.count() == sum(i not in gone for i, *_ in ROWS)


@pytest.mark.parametrize("kind", ["swap", "insert", "delete"])
def test_recall_of_edited_items(spark, kind):
    items = [(n, prose(25 + n, 200 + n)) for n in range(12)]
    rows = []
    for n, item in items:
        words = item.split(" ")
        for k in range(max_edits(len(words))):
            place = (3 + 6 * k) % (len(words) - 1)
            if kind == "swap":
                words[place] = f"other{k}"
            elif kind == "insert":
                words.insert(place, f"other{k}")
            else:
                del words[place]
        rows.append((n, prose(80, 300 + n) + " " + " ".join(words) + " " + prose(80, 400 + n)))
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()}
    assert found == {(n, n) for n, _ in items}


def test_quality_ledger(docs, none):
    entries = ledger(docs)
    found = {r.doc_id: r for r in entries.collect()}
    assert found[5].n_words == 0 and found[5].failures & 1 and found[4].n_words == 0
    assert found[14].n_repeat_words == 108 and found[14].n_dup_lines == 8
    assert found[7].n_words == 20_000 and found[7].n_repeat_words == 0
    kept = judged(docs)
    assert kept.columns == docs.columns
    assert kept.count() == entries.where(passes()).count()
    table = {r.rule: r for r in ablation(entries).collect()}
    assert table["few_words"].failing == entries.where("n_words < 20").count()
    assert ledger(none).count() == 0 and judged(none).count() == 0


def test_mixing_stays_within_a_block_of_its_targets(spark, docs, none):
    sizes = {"a": 900, "b": 300, "c": 50, "d": 2}
    rows = [(n, s) for s, size in sizes.items() for n in range(size)]
    frame = spark.createDataFrame(rows, "doc_id long, source string").withColumn("text", F.lit("x"))
    weights = source_weights(frame, 100)
    share = {r.source: r.share for r in weights.collect()}
    assert sum(share.values()) == 100
    plan = schedule(weights, 100).orderBy("slot").collect()
    assert [r.slot for r in plan] == list(range(100))
    given = dict.fromkeys(sizes, 0)
    for done, r in enumerate(plan, 1):
        given[r.source] += 1
        assert all(abs(given[s] - share[s] * done / 100) < 1 for s in sizes)
    mixed = mix_sources(frame, weights, period=100, block=4)
    assert mixed.count() == len(rows)
    assert mixed.select("mix_slot", "mix_row").distinct().count() == len(rows)
    assert mix_sources(docs).count() == len(ROWS)
    assert mix_sources(docs).columns[: len(docs.columns)] == docs.columns
    assert mix_sources(none).count() == 0
    with pytest.raises(Exception, match="period"):
        source_weights(frame, 6).collect()


def test_token_counts_add_up(docs, none):
    whole = {}
    for rule in ("first", "largest", "split"):
        found = token_counts(docs, rule)
        rows = found.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "tkey", "section"])
        sums = {(r.doc_id, r.tkey): (r.n, r.e) for r in rows.groupBy("doc_id", "tkey").agg(
            F.round(F.sum("n_tokens"), 6).alias("n"), F.max("end").alias("e")).collect()}
        whole.setdefault("first", sums)
        assert {k: float(v[0]) for k, v in sums.items()} == {k: float(v[0]) for k, v in whole["first"].items()}
    assert {k[0]: v[1] for k, v in sums.items()}[7] == len(LONG.encode())
    assert token_counts(none).count() == 0
    with pytest.raises(ValueError):
        token_counts(docs, "other")


def test_tokens_across_borders():
    ends, sections = np.array([2, 5, 9]), np.array([3, 4, 9])
    assert attribute(ends, sections, "first").tolist() == [2, 0, 1]
    assert attribute(ends, sections, "largest").tolist() == [2, 0, 1]
    assert np.allclose(attribute(ends, sections, "split"), [1 + 1 / 3, 1 / 3, 1 + 1 / 3])


def test_intervals_and_captures(spark):
    at = lambda d: f"2024-01-{d:02d} 00:00:00"
    actions = [
        ("Bad.com", "x", "add", at(2)), ("bad.com", "x", "add", at(3)), ("bad.com", "x", "remove", at(5)),
        ("bad.com", "x", "add", at(9)), ("site.org/en", None, "add", at(1)), (None, "x", "add", at(1)),
        ("bad.com", "x", "other", at(1)), ("bad.com", "x", "add", None), ("late.net", "x", "remove", at(1)),
    ]
    actions = spark.createDataFrame(actions, "entry string, category string, action string, at string")
    actions = actions.withColumn("at", F.to_timestamp("at"))
    spans = {(r.entry, r.valid_from.day, r.valid_to and r.valid_to.day) for r in intervals(actions).collect()}
    assert spans == {("bad.com", 2, 5), ("bad.com", 9, None), ("site.org/en", 1, None)}
    pages = [
        (1, "http://www.BAD.com/a?b", at(4)), (2, "http://bad.com", at(5)), (3, "http://user@bad.com:8/", at(20)),
        (4, "https://site.org/en/1", at(2)), (5, "https://site.org/english", at(2)), (6, None, at(2)),
        (7, "no url", at(2)), (8, "http://bad.com/", None), (None, None, None), (1, "http://www.BAD.com/a?b", at(4)),
    ]
    captures = spark.createDataFrame(pages, "page_id long, url string, fetched_at string")
    captures = captures.withColumn("fetched_at", F.to_timestamp("fetched_at")).withColumn("entry", F.lit(1))
    found = {r.page_id: (r.categories, r.matches) for r in judge(captures, actions).collect()}
    hit, miss = (["x"], 1), ([], 0)
    assert found == {1: hit, 2: miss, 3: hit, 4: ([""], 1), 5: miss, 6: miss, 7: miss, 8: miss, None: miss}
    assert judge(captures.where("false"), actions).count() == 0
    assert judge(captures, actions.where("false")).where("matches > 0").count() == 0
    assert candidates(captures.where("page_id = 4")).first().entries[-1] == "org/en/1"


def test_folding_and_exceptions():
    assert toxicity.fold("1D10T, tr\u00e0sh $TUP\u0406D!!") == " idiot trash stupid "
    lexicon = toxicity.Lexicon({"idiot": 3.0, "trash": 3.0})
    automaton = lexicon.automaton()
    assert lexicon.features(automaton, "what an 1d10t")[0] == 3.0
    assert lexicon.features(automaton, "\u0456di\u043et")[0] == 3.0
    assert lexicon.features(automaton, "put it in the trash can")[0] == 0
    assert lexicon.features(automaton, "")[0] == 0
    assert lexicon.features(automaton, "idiot")[1] > lexicon.features(automaton, "idiot " + LONG)[1]


@pytest.mark.parametrize("name", ["op5_toxicity", "op9_quality_classifier"])
def test_held_out_accuracy(spark, name):
    folder = str(TESTDATA / "sf0.1")
    column = "toxic" if name == "op5_toxicity" else "quality"
    scored = queries.QUERIES[name](spark, folder).where("held_out")
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    both = scored.join(truth, "doc_id").select(F.col(column).alias("y"), "score", "predicted").toPandas()
    assert (both.y == both.predicted).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_models_without_labels(spark, docs, none):
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    model = classifier.learn(docs, labels)
    assert {r.score for r in classifier.quality_scores(docs, model).collect()} == {0.5}
    lexicon = toxicity.learn(docs, labels)
    assert toxicity.toxicity(docs, lexicon).count() == len(ROWS)
    assert toxicity.toxicity(none, lexicon).count() == 0
    assert classifier.quality_scores(none, classifier.learn(none, labels)).count() == 0


def test_pipeline_against_brute_force(spark):
    """Each stage on what the one before it kept."""
    docs = prepare(spark).read.parquet(f"{SMALL}/documents.parquet")
    kept = judged(docs).collect()
    rows = sorted((r.doc_id, r.text) for r in kept)
    heads = {c for _, _, c in brute_components([(i, t) for i, t in rows])}
    first, left = {}, []
    for i, text in rows:
        if i not in heads:
            continue
        w = words_of(text)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) < i:
                gone[k : k + 50] = [True] * 50
        if any(gone):
            text = " ".join(x for x, y in zip(w, gone) if not y)
        if not any(gone) or text:
            left.append((i, text))
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    frame = spark.createDataFrame(left, "doc_id long, text string")
    leaky = {r.doc_id for r in find_leaks(frame, benchmark).collect()}
    found = corpus_pipeline.run(spark, SMALL)
    assert {(r.doc_id, r.text) for r in found.collect()} == {r for r in left if r[0] not in leaky}
    assert found.select("mix_slot", "mix_row").distinct().count() == found.count()
