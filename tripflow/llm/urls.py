"""URL filters by dated lists: an as-of join of captures with the entries active when fetched.

Lists change. A list is given as dated actions (`add` or `remove` of an entry); they become
intervals of validity, and a capture is judged by the entries in force at its fetch time, not by
today's list. An entry is a host or a parent domain ("example.com" covers "www.example.com"), with
or without the start of a path after it ("example.com/en").

A capture's candidate entries are its parent domains, each with the leading parts of its path; each
is an equality, so the join needs no range condition beyond the dates. Only domains of as many
labels, and paths of as many parts, as some listed entry has are asked for: the numbers that occur
come from the list, so a URL with thousands of parts gives few candidates. Both sides are
plain shuffles, which adaptive execution splits for hosts that hold a large share of all captures.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import durable

ACTIONS = ("add", "remove")


def intervals(actions: DataFrame) -> DataFrame:
    """entry, category, valid_from, valid_to from entry, category, action, at.

    An entry is valid in a category from an `add` until the next `remove` of it, the end excluded;
    without one `valid_to` is missing. Of actions at the same time `remove` counts as the later;
    repeated adds or removes change nothing. Rows with a missing entry, action or time, and other
    actions, are ignored; a missing category is a category. Entries compare in lower case.
    """
    clean = actions.select(
        F.lower(F.col("entry")).alias("entry"), "category", F.lower("action").alias("action"), "at"
    ).where(F.col("action").isin(*ACTIONS) & F.col("entry").isNotNull() & F.col("at").isNotNull())
    line = Window.partitionBy("entry", "category").orderBy("at", "action")
    turned = clean.withColumn("before", F.lag("action").over(line)).where(
        F.coalesce("before", F.lit("remove")) != F.col("action")
    )
    spans = turned.withColumn("until", F.lead("at").over(line)).where("action = 'add'")
    return spans.where("until IS NULL OR until > at").select(
        "entry", "category", F.col("at").alias("valid_from"), F.col("until").alias("valid_to")
    )


def shapes(entries: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels of the domains in `entries`, and of path parts: all that occur."""
    slashes = F.size(F.split("entry", "/")) - 1
    dots = F.size(F.split(F.substring_index("entry", "/", 1), r"\.")) - 1
    row = entries.agg(
        F.sort_array(F.collect_set(dots + 1)).alias("labels"),
        F.sort_array(F.collect_set(slashes)).alias("parts"),
    ).first()
    return list(row["labels"]), list(row["parts"])


def _occurring(numbers: Collection[int] | None, first: int, most: Column) -> Column:
    """The numbers from `first` to `most`; with `numbers`, those among them."""
    if numbers is None:
        return F.when(most >= first, F.sequence(F.lit(first), most)).otherwise(F.array().cast("array<int>"))
    listed = F.array(*(F.lit(int(n)) for n in numbers)).cast("array<int>")
    return F.filter(listed, lambda n: (n >= first) & (n <= most))


def candidates(
    urls: DataFrame,
    url: str = "url",
    labels: Collection[int] | None = None,
    parts: Collection[int] | None = None,
) -> DataFrame:
    """`urls` with `entries`: every list entry that would cover the URL.

    With `labels` and `parts` (see `shapes`), only entries whose domain has as many labels, and whose
    path has as many parts. Scheme, user, port, query and fragment do not matter; hosts compare in
    lower case and without a final dot. A missing URL, or one without a host, has none.
    """
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^?#\s]*)", 1)
    host = F.lower(
        F.regexp_replace(F.regexp_extract(rest, r"^(?:[^/@]*@)?([^/:]*)", 1), r"\.+$", "")
    )
    path = F.lower(F.regexp_extract(rest, r"^[^/]*(/.*)$", 1))
    names = F.split(host, r"\.")
    steps = F.filter(F.split(path, "/"), lambda p: p != "")
    domains = F.transform(
        F.reverse(_occurring(labels, 1, F.size("_labels"))),
        lambda n: F.array_join(F.slice("_labels", F.size("_labels") - n + 1, n), "."),
    )
    heads = F.transform(
        _occurring(parts, 0, F.size("_parts")),
        lambda n: F.when(n == 0, F.lit("")).otherwise(
            F.concat(F.lit("/"), F.array_join(F.slice("_parts", F.lit(1), n), "/"))
        ),
    )
    every = F.flatten(F.transform(domains, lambda d: F.transform(heads, lambda h: F.concat(d, h))))
    return (
        urls.withColumns({"_host": host, "_labels": names, "_parts": steps})
        .withColumn(
            "entries", F.when(F.col("_host") != "", every).otherwise(F.array().cast("array<string>"))
        )
        .drop("_host", "_labels", "_parts")
    )


def judge(captures: DataFrame, actions: DataFrame) -> DataFrame:
    """page_id, url, fetched_at, categories, matches: one row for each different capture.

    `captures` has page_id, url, fetched_at; rows equal in all three count once. `categories` are
    the sorted categories of the entries in force when the page was fetched (a missing category
    as the empty string), `matches` their number of entries; a capture without a fetch time, or
    whose URL has no host, matches none.
    """
    spans = durable(intervals(actions), "intervals")
    rows = captures.select("page_id", "url", "fetched_at").distinct()
    labels, parts = shapes(spans)
    asked = candidates(rows, "url", labels, parts).select("page_id", "url", "fetched_at", F.explode("entries").alias("entry"))
    active = (F.col("valid_from") <= F.col("fetched_at")) & (
        F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))
    )
    hits = (
        asked.join(spans, "entry")
        .where(active)
        .groupBy("page_id", "url", "fetched_at")
        .agg(
            F.sort_array(F.collect_set(F.coalesce("category", F.lit("")))).alias("categories"),
            F.count_distinct("entry").alias("matches"),
        )
    )
    keys = ("page_id", "url", "fetched_at")
    hits = hits.withColumnsRenamed({c: f"hit_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"hit_{c}")) for c in keys]
    return rows.join(hits, same, "left").select(
        *keys,
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
        F.coalesce("matches", F.lit(0)).cast("long").alias("matches"),
    )
