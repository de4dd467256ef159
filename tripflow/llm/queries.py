"""Queries over the driver's tables, one per operator of this subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripflow.llm import classifier, toxicity
from tripflow.llm.decontaminate import find_leaks
from tripflow.llm.labelled import held_out
from tripflow.llm.mixing import PERIOD, mix_sources
from tripflow.llm.mixing import BLOCK as MIX_BLOCK
from tripflow.llm.near_dup import near_duplicates
from tripflow.llm.negatives import hard_negatives
from tripflow.llm.packing import pack_documents
from tripflow.llm.parsing import byte_dedup
from tripflow.llm.quality import WINDOW, ledger, mask, passes
from tripflow.llm.rows import documents, prepare
from tripflow.llm.substring import substring_dedup
from tripflow.llm.tokencount import token_counts
from tripflow.llm.urls import judge
from tripflow.llm.variants import counted, runs, spelling_variants, without_letter


def op1_benchmark_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(documents(spark, sf_dir), benchmark).drop("tkey")


def op2_substring_dedup(spark, sf_dir):
    done = substring_dedup(documents(spark, sf_dir))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return done.select(
        "doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


# Captures and list actions out of the pages: fetch times and dates follow page ids.
CAPTURES = """
    SELECT page_id, url, TIMESTAMP '2024-01-01' + (page_id * 7919 % 2592000) * INTERVAL 1 SECOND
        AS fetched_at
    FROM pages"""
HOSTS = """
    SELECT regexp_replace(regexp_extract(url, '://([^/?#:]*)', 1), '^(www|m|blog)[.]', '') AS host,
           regexp_extract(url, '://[^/?#]*/([a-z]+)', 1) AS head, min(page_id) AS k
    FROM pages GROUP BY ALL"""
LISTED = """
    SELECT host AS entry, 'blocked' AS category, 'add' AS action, k % 20 AS day FROM hosts
    WHERE k % 2 = 0
    UNION ALL SELECT host, 'blocked', 'remove', k % 20 + 3 + k % 7 FROM hosts WHERE k % 2 = 0
    UNION ALL SELECT host, 'blocked', 'add', k % 20 + 6 + k % 7 FROM hosts WHERE k % 6 = 0
    UNION ALL SELECT host || '/' || head, 'section', 'add', k % 10 FROM hosts
    WHERE k % 5 = 0 AND head != ''
    UNION ALL SELECT 'example.org', 'domain', 'add', 25"""


def op3_url_filters(spark, sf_dir):
    prepare(spark).read.parquet(f"{sf_dir}/pages.parquet").createOrReplaceTempView("llm_pages")
    captures = spark.sql(CAPTURES.replace("FROM pages", "FROM llm_pages"))
    hosts = HOSTS.replace("FROM pages", "FROM llm_pages")
    day = "TIMESTAMP '2024-01-01' + day * INTERVAL 1 DAY AS at"
    actions = spark.sql(f"WITH hosts AS ({hosts}), listed AS ({LISTED}) SELECT *, {day} FROM listed")
    judged = judge(captures, actions)
    return judged.select(
        "page_id", F.array_join("categories", ",").alias("categories"), "matches"
    )


def op4_quality_rules(spark, sf_dir):
    base = F.col("failures").bitwiseAND(F.lit(mask(("few_words", "repeated_windows")))) != 0
    return ledger(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & passes()).alias("kept"),
    )


def _predictions(scored, threshold):
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op5_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _predictions(toxicity.toxicity(docs, lexicon), 0.3)


def op6_pfair_mixing(spark, sf_dir):
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "source", "mix_block", "mix_slot", "mix_row")


def op7_prefix_free_dedup(spark, sf_dir):
    done = byte_dedup(documents(spark, sf_dir))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return done.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir)).drop("tkey")


def op9_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = classifier.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _predictions(classifier.quality_scores(docs, model), 0.7)


def op10_minhash_near_dedup(spark, sf_dir):
    found = near_duplicates(documents(spark, sf_dir))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


# One vector in seven gets the next label; the anchors are the vectors of round numbers.
MISLABELLED, ANCHORS, LABELS = 7, 100, 10


def op11_hard_negatives(spark, sf_dir):
    rows = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    turned = F.when(F.col("vec_id") % MISLABELLED == 0, (label + 1) % LABELS).otherwise(label)
    return hard_negatives(rows.withColumn("label", turned), F.col("vec_id") % ANCHORS == 0)


def op12_retrieval_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir)).drop("tkey", "tsum")


#: One run of letters in so many loses a letter, so that there are variants to find.
DAMAGED = 199


def op13_spelling_variants(spark, sf_dir):
    found = runs(documents(spark, sf_dir)).where(F.char_length("run") >= 6)
    # A row without doc_id hashes as if its id were empty.
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    hashed = F.crc32(name.cast("binary"))
    place = (hashed % F.char_length("run")).cast("int")
    damaged = without_letter(F.col("run"), place)
    word = F.when(hashed % DAMAGED == 0, damaged).otherwise(F.col("run"))
    return spelling_variants(counted(found.select(word.alias("word"))))


OPERATORS = (
    op1_benchmark_decontamination,
    op2_substring_dedup,
    op3_url_filters,
    op4_quality_rules,
    op5_toxicity,
    op6_pfair_mixing,
    op7_prefix_free_dedup,
    op8_token_counts,
    op9_quality_classifier,
    op10_minhash_near_dedup,
    op11_hard_negatives,
    op12_retrieval_packing,
    op13_spelling_variants,
)
QUERIES = {f.__name__: f for f in OPERATORS}

# SQL

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op3_url_filters": rf"""
        WITH hosts AS ({HOSTS}), listed AS ({LISTED}),
        turned AS (SELECT * FROM (SELECT *, lag(action) OVER w AS before FROM listed
                                  WINDOW w AS (PARTITION BY entry, category ORDER BY day, action))
                   WHERE coalesce(before, 'remove') != action),
        spans AS (SELECT *, lead(day) OVER (PARTITION BY entry, category ORDER BY day, action)
                    AS until FROM turned),
        valid AS (SELECT entry, category, split_part(entry, '/', 1) AS domain,
                         CASE WHEN entry LIKE '%/%' THEN '/' || split_part(entry, '/', 2) || '/'
                              ELSE '/' END AS head,
                         TIMESTAMP '2024-01-01' + day * INTERVAL 1 DAY AS valid_from,
                         TIMESTAMP '2024-01-01' + until * INTERVAL 1 DAY AS valid_to
                  FROM spans WHERE action = 'add'),
        asked AS (SELECT DISTINCT *, lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS host,
                         lower(regexp_extract(url, '://[^/?#]*([^?#]*)', 1)) || '/' AS path
                  FROM ({CAPTURES})),
        hits AS (SELECT page_id, url, fetched_at, entry, category FROM asked JOIN valid
                 ON (host = domain OR ends_with(host, '.' || domain))
                    AND starts_with(path, head) AND valid_from <= fetched_at
                    AND (valid_to IS NULL OR fetched_at < valid_to))
        SELECT page_id, coalesce(string_agg(DISTINCT category, ',' ORDER BY category), '')
                 AS categories, count(DISTINCT entry) AS matches
        FROM asked LEFT JOIN hits USING (page_id, url, fetched_at)
        GROUP BY page_id, url, fetched_at""",
    "op4_quality_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w
                   FROM documents),
        spans AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
                  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
        twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM spans)
                  WHERE n > 1),
        covered AS (SELECT r, count(DISTINCT i + k) AS n
                    FROM twice, (SELECT unnest(range({WINDOW})) AS k) GROUP BY r),
        lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
        dup AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM lines
                WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
        m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                     CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                     CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT)
                       AS n_symbols,
                     coalesce(dup.n, 0) AS n_lines, coalesce(dup.dup, 0) AS n_dup_lines,
                     coalesce(covered.n, 0) AS n_repeat_words,
                     len(list_filter(w, lambda x: ends_with(x, '!!'))) AS shouts
              FROM d LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > 3 * n_words
                    OR 100 * n_dup_lines > 50 * n_lines OR 100 * shouts > 30 * n_words
                    OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
        FROM b""",
    "op11_hard_negatives": f"""
        WITH e AS (
          SELECT vec_id, CAST(CASE WHEN vec_id % {MISLABELLED} = 0 THEN (label + 1) % {LABELS}
                              ELSE label END AS BIGINT) AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
                     CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
              FROM e a JOIN e b ON a.vec_id % {ANCHORS} = 0 AND a.vec_id != b.vec_id),
        p AS (SELECT a, b, score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
        SELECT p.a AS anchor_id, p.b AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER)
                 AS rank,
               s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.a = p.a AND NOT s.same
          AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
        QUALIFY rank <= 5""",
    "op6_pfair_mixing": f"""
        WITH RECURSIVE
        d AS (SELECT doc_id, source, coalesce(source, '') AS s, coalesce(text, '') AS t,
                     md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS p FROM documents),
        c AS (SELECT s, CAST(floor(sqrt(CAST(count(*) AS DOUBLE)) * 1000) AS BIGINT) AS raw,
                     count(*) OVER () AS sources FROM d GROUP BY s),
        f AS (SELECT s, row_number() OVER (ORDER BY s) AS number, {PERIOD} - sources AS rest,
                     CAST(raw * ({PERIOD} - sources) AS BIGINT) AS part,
                     CAST(sum(raw) OVER () AS BIGINT) AS total FROM c),
        w AS (SELECT s, number, 1 + part // total
                       + CASE WHEN row_number() OVER (ORDER BY part % total DESC, s)
                                <= rest - sum(part // total) OVER () THEN 1 ELSE 0 END AS share
              FROM f),
        l AS (SELECT list(CAST(share AS BIGINT) ORDER BY number) AS shares FROM w),
        pat AS (
          SELECT CAST(-1 AS BIGINT) AS slot, list_transform(shares, lambda x: CAST(0 AS BIGINT))
                   AS given, CAST(-1 AS BIGINT) AS who FROM l
          UNION ALL
          SELECT slot + 1,
                 list_transform(given, lambda g, i: g + CASE WHEN i = next THEN 1 ELSE 0 END), next
          FROM (SELECT slot, given, CAST(list_min(list_filter(list_transform(given, lambda g, i:
                         CASE WHEN g * {PERIOD} < (slot + 2) * shares[i]
                              THEN {{'due': ceil((g + 1) * {PERIOD} / shares[i]), 'who': i}} END),
                         lambda x: x IS NOT NULL))['who'] AS BIGINT) AS next
                FROM pat, l WHERE slot < {PERIOD - 1})),
        turns AS (SELECT who, slot, row_number() OVER (PARTITION BY who ORDER BY slot) - 1 AS nth
                  FROM pat WHERE slot >= 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p, t) - 1 AS row FROM d),
        b AS (SELECT *, row // {MIX_BLOCK} AS mix_block, row % {MIX_BLOCK} AS mix_row FROM n)
        SELECT doc_id, source, mix_block, (mix_block // share) * {PERIOD} + slot AS mix_slot, mix_row
        FROM b JOIN w USING (s) JOIN turns ON who = number AND nth = mix_block % share""",
}
