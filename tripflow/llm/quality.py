"""Quality rules as a ledger of failure bits, and policies over it.

Every rule is evaluated once per document: its measurements and one bit per failed rule are
stored. A policy is a version and the rules it enforces, as a mask; applying one, or asking what a
rule alone costs, is bitwise work over the ledger and never reads a text again.

All of it is Spark expressions, no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import KEY, doc_id, keyed, prepare, with_key
from tripflow.session import durable

WINDOW = 8
#: Number of each rule's bit, its name, and the condition under which a document fails it.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_shouts > 30 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
)
#: Policies by version: the rules they enforce.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "shouting", "word_length"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "shouting", "word_length"),
}
POLICY = "v2"


def mask(rules: tuple[str, ...]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once: an expression named twice is computed twice."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(windows: Column, width: int) -> Column:
    """Words in windows whose hash is found twice or more.

    Numbers sort fast, so texts that repeat nothing are settled by sorting the bare hashes.
    """
    zero = F.lit(0).cast("long")

    def same_as_before(ranked: Column) -> Column:
        return F.exists(
            F.sequence(F.lit(2), F.size(ranked)),
            lambda i: F.get(ranked, i - 1) == F.get(ranked, i - 2),
        )

    def places(ranked: Column) -> Column:
        """Sorted places of windows equal to a neighbour in (hash, place) order."""
        n = F.size(ranked)
        twin = F.filter(
            ranked,
            lambda x, i: ((i > 0) & (F.get(ranked, i - 1)["h"] == x["h"]))
            | ((i + 1 < n) & (F.get(ranked, i + 1)["h"] == x["h"])),
        )
        return F.sort_array(F.transform(twin, lambda x: x["i"]))

    def total(found: Column) -> Column:
        start = F.struct(zero.alias("words"), F.lit(-width).alias("last"))
        return F.aggregate(
            found,
            start,
            lambda a, i: F.struct(
                (a["words"] + F.least(F.lit(width), i - a["last"])).alias("words"), i.alias("last")
            ),
            lambda a: a["words"],
        )

    def of(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        repeats = (F.size(hashes) > 1) & _let(F.sort_array(hashes), same_as_before)
        return F.when(repeats, _let(_let(F.sort_array(pairs), places), total)).otherwise(zero)

    return _let(windows, of)


def measured(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """ord, tkey, tsum and doc_id of `docs`' rows with what the rules measure.

    n_words, word_chars (code points in words), n_symbols (of `#*$%&|<>`), n_lines and n_dup_lines
    (lines with a word; those equal to an earlier one), n_repeat_words (words in windows of `width`
    words found twice or more in the text), n_shouts (words ending in "!!").

    Equal windows are found by 64-bit hashes within one text.
    """
    spaces = r"[\x20\x09-\x0D]+"
    rows = keyed(docs)
    rows = rows.withColumn("words", F.filter(F.split("text", spaces), lambda w: w != ""))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("hashes", i + k) for k in range(width)])

    n = F.size("words")
    windows = F.when(
        n >= width, F.transform(F.sequence(F.lit(0), n - width), window)
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def sizes(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    return rows.select(
        *KEY,
        doc_id(),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, sizes).alias("lines"),
        _covered(windows, width).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.endswith("!!"))).cast("long").alias("n_shouts"),
    ).select("*", "lines.*").drop("lines")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, tsum, measurements and `failures`, the bits of the rules that the row fails.

    The ledger is written to the shared folder and read back: policies and ablations over it do
    not evaluate a rule again (left in one plan, Spark would push a policy's filter below the
    measurements and evaluate them twice). `tkey` and `tsum` tell rows of one doc_id apart.

    Empty and missing texts have no words and fail `few_words`; a row without doc_id is kept as it
    is; rows that repeat get equal entries.
    """
    bits = [F.when(F.expr(rule), 1 << i).otherwise(0) for i, (_, rule) in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    prepare(docs.sparkSession)
    entries = measured(docs).withColumn("failures", failures.cast("long"))
    return durable(entries, "ledger")


def judged(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The rows of `docs` that pass a policy, with the columns of `docs`.

    The ledger has one entry for each different doc_id and text; entries that fail are what is
    joined, so that rows are neither lost nor repeated.
    """
    failed = ledger(docs).where(~passes(policy)).select(*KEY).distinct()
    key = [f"_{k}" for k in KEY]
    kept = with_key(docs).join(failed.toDF(*key), key, "left_anti")
    return kept.select(*docs.columns)


def passes(policy: str = POLICY) -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablation(entries: DataFrame, policy: str = POLICY) -> DataFrame:
    """rule, failing, alone: what each rule of a policy rejects, and what only it rejects.

    One pass over the ledger; the sums of all rules are combined before the shuffle.
    """
    enforced = POLICIES[policy]
    hit = F.col("failures").bitwiseAND(F.lit(mask(enforced)))
    sums = []
    for rule in enforced:
        bit = F.lit(mask((rule,)))
        sums += [
            F.count_if(hit.bitwiseAND(bit) != 0).alias(f"{rule}_failing"),
            F.count_if(hit == bit).alias(f"{rule}_alone"),
        ]
    both = ", ".join(f"struct('{r}' AS rule, {r}_failing AS failing, {r}_alone AS alone)" for r in enforced)
    return entries.agg(*sums).select(F.expr(f"inline(array({both}))"))
