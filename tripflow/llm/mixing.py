"""Sources interleaved to target weights by Pfair scheduling.

Documents of a source are put in a random but fixed order (by digest of doc_id) and cut into
blocks. Time is a row of slots, one block each. With weight w, a source's block number j (from 0)
is released at slot floor(j / w) and due by slot ceil((j + 1) / w); in each slot the released block
with the earliest deadline goes first, ties by the order of sources. With weights that add up to 1
every block meets its deadline, so after any number of slots each source is less than one block
from its target, as long as no source has run out.

Weights are shares of a period of slots, hence the schedule repeats with the period: it is worked
out once for one period, and its rows (one per slot) are joined to the blocks. A period has PERIOD
slots, or two for each source where there are more than half as many sources. When a source has no more blocks its slots are skipped and
the others go on in the same proportions; no document is dropped or repeated.

All of it is Spark expressions, no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.rows import prepare, text_of
from tripflow.session import durable

#: Fewest slots of a period; a period has at least twice as many slots as there are sources.
PERIOD = 1000
#: Documents of a block.
BLOCK = 16
#: Hexadecimal digits by which a source is cut into parts that are numbered on their own.
DIGITS = 3


def period_of(sources: int) -> int:
    """Slots of a period for so many sources."""
    return max(PERIOD, 2 * sources)


def source_weights(docs: DataFrame, period: int | None = None) -> DataFrame:
    """source, number, share: target shares in proportion to the square root of a source's size.

    Shares are whole slots of the period, one at least, by largest remainder (ties by source). The
    result has one row per source. The period is `period_of` the sources; for more sources than half
    of a `period` asked for this raises, as a slot is then too coarse: ask for a longer one.
    """
    counts = docs.groupBy(_source().alias("source")).agg(F.count(F.lit(1)).alias("docs"))
    raw = F.floor(F.sqrt(F.col("docs").cast("double")) * 1000)
    everything = Window.partitionBy(F.lit(0))
    sources = F.count(F.lit(1)).over(everything)
    slots = F.greatest(F.lit(PERIOD), 2 * sources) if period is None else F.lit(period)
    # One slot each, the rest in proportion.
    rest = slots - sources
    sized = counts.withColumn("raw", raw.cast("long")).select(
        "source",
        (F.col("raw") * rest).alias("part"),
        F.sum("raw").over(everything).alias("total"),
        sources.alias("sources"),
        slots.alias("slots"),
        rest.alias("rest"),
    )
    floors = sized.withColumn("low", F.expr("part div total")).withColumn(
        "left", F.expr("part % total")
    )
    by_left = Window.partitionBy(F.lit(0)).orderBy(F.desc("left"), "source")
    by_name = Window.partitionBy(F.lit(0)).orderBy("source")
    extra = F.row_number().over(by_left) <= F.col("rest") - F.sum("low").over(everything)
    too_many = F.raise_error(F.lit("more sources than half the period: ask for a longer period"))
    return floors.select(
        "source",
        (F.row_number().over(by_name) - 1).alias("number"),
        F.when(F.col("sources") * 2 > F.col("slots"), too_many.cast("long"))
        .otherwise(1 + F.col("low") + extra.cast("long"))
        .alias("share"),
    )


def schedule(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """source, share, nth, slot: earliest deadline first over one period.

    `nth` numbers a source's slots in the period from 0. `weights` (source, number, share) must add
    up to the period. Longer periods than PERIOD are worked out by `halved`, not slot by slot.
    """
    if period > PERIOD:
        return halved(weights, period)
    one = weights.agg(
        F.sort_array(F.collect_list(F.struct("number", "source", "share"))).alias("sources"),
        F.sum("share").alias("total"),
    ).where("total IS NOT NULL")
    one = one.select(
        F.transform("sources", lambda s: s["share"]).alias("shares"),
        F.when(F.col("total") == period, F.col("sources"))
        .otherwise(F.raise_error(F.lit("shares do not add up to the period")).cast(one.schema["sources"].dataType))
        .alias("sources"),
    )

    def step(done: Column, slot: Column) -> Column:
        """`done`: slots given to each source so far, and which source had each slot."""
        deadlines = F.zip_with(
            done["given"],
            F.sequence(F.lit(0), F.size("shares") - 1),
            lambda c, i: F.when(
                c * period < (slot + 1) * F.get("shares", i),
                F.struct(
                    F.ceil((c + 1) * period / F.get("shares", i)).alias("due"), i.alias("who")
                ),
            ),
        )
        who = F.array_min(F.filter(deadlines, lambda d: d.isNotNull()))["who"]
        return F.element_at(
            F.transform(
                F.array(who),
                lambda w: F.struct(
                    F.transform(
                        done["given"], lambda c, i: c + F.when(i == w, 1).otherwise(0).cast("long")
                    ).alias("given"),
                    F.concat(done["order"], F.array(w)).alias("order"),
                ),
            ),
            1,
        )

    start = F.struct(
        F.transform("shares", lambda s: F.lit(0).cast("long")).alias("given"),
        F.array().cast("array<int>").alias("order"),
    )
    slots = F.sequence(F.lit(0).cast("long"), F.lit(period - 1).cast("long"))
    order = F.aggregate(slots, start, step, lambda done: done["order"])
    flat = one.withColumn("order", order).select("sources", F.posexplode("order").alias("slot", "who"))
    turns = Window.partitionBy("who").orderBy("slot")
    return flat.select(
        F.get("sources", F.col("who"))["source"].alias("source"),
        F.get("sources", F.col("who"))["share"].alias("share"),
        (F.row_number().over(turns) - 1).cast("long").alias("nth"),
        F.col("slot").cast("long").alias("slot"),
    )


def halved(weights: DataFrame, period: int) -> DataFrame:
    """What `schedule` gives, in as many rounds as the logarithm of the period.

    Blocks are ranked by deadline, then by number. The slots that the better half of them takes do
    not depend on the others: it leaves a slot idle where more slots than released blocks have gone
    by than ever before. The other half has the idle slots, and each half is halved again with its
    slots, until every block is alone with its slot.
    """
    everything = Window.partitionBy(F.lit(0))
    blocks = weights.select(
        "number",
        F.col("share").cast("long").alias("share"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("share").cast("long") - 1)).alias("nth"),
    )
    wrong = F.raise_error(F.lit("shares do not add up to the period")).cast("long")
    rank = F.row_number().over(everything.orderBy("due", "number")).cast("long") - 1
    blocks = blocks.withColumn("due", F.expr(f"((nth + 1) * {period} + share - 1) div share")).select(
        F.lit(0).cast("long").alias("part"),
        F.expr(f"nth * {period} div share").alias("at"),
        F.when(F.count(F.lit(1)).over(everything) == period, rank).otherwise(wrong).alias("rank"),
        "number",
        "nth",
    )
    slots = weights.sparkSession.range(period).select(
        F.lit(0).cast("long").alias("part"), F.col("id").alias("at")
    )
    rows = blocks.unionByName(slots, allowMissingColumns=True)
    is_slot = F.col("rank").isNull()
    # Blocks come before the slot they are released in.
    along = Window.partitionBy("part").orderBy("at", is_slot)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    for bit in reversed(range((period - 1).bit_length())):
        half = F.expr(f"shiftright(rank, {bit}) & 1")
        step = F.when(is_slot, 1).when(half == 0, -1).otherwise(0)
        rows = rows.withColumn("lead", F.sum(step).over(so_far))
        most = F.max(F.when(is_slot, F.col("lead"))).over(before)
        idle = F.col("lead") > F.greatest(F.coalesce(most, F.lit(0)), F.lit(0))
        rows = rows.withColumn("idle", idle.cast("long")).select(
            (F.col("part") * 2 + F.coalesce(half, "idle")).alias("part"), "at", "rank", "number", "nth"
        )
    met = rows.groupBy("part").agg(
        F.max("number").alias("number"),
        F.max("nth").alias("nth"),
        F.max(F.when(is_slot, F.col("at"))).alias("slot"),
    )
    return met.join(weights, "number").select("source", "share", "nth", "slot")


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    period: int | None = None,
    block: int = BLOCK,
    digits: int = DIGITS,
) -> DataFrame:
    """`docs` with mix_source, mix_block, mix_slot and mix_row: their place in the mixture.

    Sorting by (mix_slot, mix_row) gives the mixture. Documents of a source are ordered by the MD5
    of doc_id, then by text; rows equal in both are interchangeable. A missing source counts as the
    empty one, a missing doc_id as the word "null". Columns of `docs` stay as they are; those named
    like one of the four new ones are replaced. Without `period` it is `period_of` the sources. A
    source that `weights` leaves out fails the query, which names it.

    No source is numbered in one piece: each is cut into 16**digits parts by the first digits of
    the MD5, parts are counted before the shuffle, and the offset of each part comes from a window
    over the counts. Rows that share one doc_id share a part, as they are ties.
    """
    prepare(docs.sparkSession)
    if weights is None:
        weights = durable(source_weights(docs, period), "weights")
    if period is None:
        period = period_of(weights.count())
    # As many rows as a period has slots; a period of many sources is not broadcast.
    small = F.broadcast if period <= PERIOD else lambda rows: rows
    plan = durable(schedule(weights, period), "schedule")
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    rows = docs.drop("mix_source", "mix_block", "mix_slot", "mix_row")
    rows = rows.withColumns({"mix_source": _source(), "_place": place})
    rows = rows.withColumn("_part", F.substring("_place", 1, digits))
    counts = rows.groupBy("mix_source", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("mix_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "mix_source", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    in_part = Window.partitionBy("mix_source", "_part").orderBy("_place", text_of())
    numbered = rows.withColumn("_row", F.row_number().over(in_part) - 1)
    numbered = numbered.join(counts, ["mix_source", "_part"]).withColumn(
        "_row", F.col("_row") + F.col("_before")
    )
    numbered = numbered.withColumn("mix_block", F.expr(f"_row div {block}")).withColumn(
        "mix_row", (F.col("_row") % block).cast("long")
    )
    turns = plan.select(
        F.col("source").alias("_source"),
        F.col("share").alias("_share"),
        F.col("nth").alias("_nth"),
        F.col("slot").alias("_slot"),
    )
    shares = turns.select(F.col("_source").alias("mix_source"), "_share").distinct()
    # A source without a weight has no place, and its documents are not to vanish.
    missing = F.raise_error(F.concat(F.lit("no weight for source "), "mix_source")).cast("long")
    placed = numbered.join(small(shares), "mix_source", "left")
    placed = placed.withColumn("_share", F.coalesce("_share", missing))
    placed = placed.withColumn("_turn", F.col("mix_block") % F.col("_share"))
    placed = placed.join(
        small(turns.drop("_share")),
        (F.col("mix_source") == F.col("_source")) & (F.col("_turn") == F.col("_nth")),
    )
    slot = F.expr(f"(mix_block div _share) * {period} + _slot")
    new = ["mix_source", "mix_block", "mix_slot", "mix_row"]
    return placed.withColumn("mix_slot", slot).select(
        *[c for c in docs.columns if c not in new], *new
    )
