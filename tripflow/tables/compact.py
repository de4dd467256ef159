"""Rewriting badly sized files of a Parquet table into files near a target size."""

from __future__ import annotations

import uuid
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.session import durable
from tripflow.tables.binpack import badly_sized, file_groups
from tripflow.tables.catalog import location, partition_columns
from tripflow.tables.files import Files

# File size aimed at, files a partition needs to be worth it.
TARGET_FILE_BYTES = 134217728
MIN_INPUT_FILES = 3

WORK = "_compaction"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and partition columns of the Parquet files; lists, but opens none of them."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .drop("content", "modificationTime")
    )


def _within_table(path: Column, depth: int) -> Column:
    """The path below the table folder: partition folders and file name."""
    return F.substring_index(path, "/", -(depth + 1))


def plan_rewrite(spark: SparkSession, table: str, target: int, min_files: int) -> DataFrame:
    """The files to rewrite: partition, its columns, file, length, pieces, first_part.

    Files of one group become new file `first_part`, a file of several pieces that one and those
    after it. Numbering the new files runs over one row per group.
    """
    columns = partition_columns(spark, table)
    files = list_files(spark, location(spark, table)).select(
        F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in columns]).alias("partition"),
        _within_table(F.col("path"), len(columns)).alias("file"),
        "length",
        *columns,
    )
    chosen = durable(file_groups(files, target, min_files), "groups")
    keys = ["partition", "chunk", "bin"]
    groups = chosen.groupBy(*keys).agg(F.max("pieces").alias("parts"))
    upto = F.sum("parts").over(W.orderBy(*keys).rowsBetween(W.unboundedPreceding, 0))
    numbered = groups.withColumn("first_part", (upto - F.col("parts")).cast("int"))
    named = chosen.join(numbered, keys).select("file", "pieces", "first_part")
    return files.join(named, "file")


def _swap(spark: SparkSession, root: str, run: str, depth: int) -> None:
    """Partition by partition, old files out and new files in.

    May be repeated after a crash at any point. At any time one partition at most is incomplete.
    """
    files = Files(spark, root)
    old = spark.read.parquet(f"{run}/inputs").select("file", F.lit(False).alias("new"))
    new = list_files(spark, f"{run}/new").select(
        _within_table(F.col("path"), depth).alias("file"), F.lit(True).alias("new")
    )
    # Written out first, as the moves take files out of the folder that is listed.
    moves = durable(
        old.union(new).withColumn("folder", F.substring_index("file", "/", depth)), "moves"
    )
    rows = moves.orderBy("folder", "new").toLocalIterator(True)
    for (_, staged), group in groupby(rows, lambda r: (r["folder"], r["new"])):
        source, target = (f"{run}/new", root) if staged else (root, f"{run}/old")
        files.move_all((f"{source}/{r['file']}", f"{target}/{r['file']}") for r in group)
    # The mark goes first: from here on the run is only waste.
    files.delete(f"{run}/READY")
    files.delete(run)


def recover(spark: SparkSession, table: str) -> None:
    """Finish the swap of an interrupted run; drop what a run staged but did not check."""
    root = location(spark, table)
    files = Files(spark, root)
    for name in files.names(f"{root}/{WORK}"):
        run = f"{root}/{WORK}/{name}"
        if files.exists(f"{run}/READY"):
            _swap(spark, root, run, len(partition_columns(spark, table)))
        else:
            files.delete(run)
    spark.catalog.refreshTable(table)


def compact(
    spark: SparkSession,
    table: str,
    target_file_size_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
) -> DataFrame:
    """Rewrite the files far from the target size, in groups near it.

    Small files of a partition are packed into groups, first fit by decreasing size, if there are
    enough of them, and each group becomes one file. A file that is too large is split into even
    runs of rows, also where it is the only one. Files of good size, and files that fit no group,
    are not read. One task writes one new file. The new files are written beside the table, counted against the old ones, and only then moved in. Run one
    compaction of a table at a time; appends may go on meanwhile, overwrites may not. Returns
    partition, rewritten_files, rewritten_bytes, added_files, added_bytes.
    """
    recover(spark, table)
    root, columns = location(spark, table), partition_columns(spark, table)
    run = f"{root}/{WORK}/{uuid.uuid4().hex}"
    plan_rewrite(spark, table, target_file_size_bytes, min_input_files).write.parquet(
        f"{run}/inputs"
    )
    inputs = spark.read.parquet(f"{run}/inputs")
    tasks = inputs.agg(F.max(F.col("first_part") + F.col("pieces"))).first()[0]
    if tasks:
        old = chosen_rows(spark, table, inputs, target_file_size_bytes)
        _stage(spark, table, old, run, tasks)
    report = durable(_report(spark, inputs, run, columns, bool(tasks)), "compact")
    if tasks:
        Files(spark, root).mark(f"{run}/READY")
    recover(spark, table)
    return report


def _within_span(inputs: DataFrame, columns: list[str]) -> Column:
    """True for every partition chosen: each of `columns` between its least and greatest value.

    Known before the scan, so that the scan lists no partitions outside of it.
    """
    bounds = [f(c) for c in columns for f in (F.min, F.max)]
    holes = [F.count_if(F.col(c).isNull()) for c in columns]
    # One row, whatever the number of files.
    found = inputs.agg(F.lit(0), *bounds, *holes).first()[1:]
    within = F.lit(True)
    for i, c in enumerate(columns):
        low, high, null = found[2 * i], found[2 * i + 1], found[2 * len(columns) + i]
        if not null:
            within = within & F.col(c).between(low, high)
    return within


def chosen_rows(spark: SparkSession, table: str, inputs: DataFrame, target: int) -> DataFrame:
    """The rows of the files in `inputs`, with file, position, pieces and first_part.

    The scan reads the badly sized files of the partitions between the first and the last one
    chosen; the join keeps those of the files.
    """
    columns = partition_columns(spark, table)
    return (
        spark.table(table)
        .filter(_within_span(inputs, columns))
        .filter(badly_sized(F.col("_metadata.file_size"), target))
        .withColumns(
            {
                "file": _within_table(F.col("_metadata.file_path"), len(columns)),
                "position": F.col("_metadata.row_index"),
            }
        )
        .join(inputs.select("file", "pieces", "first_part"), "file")
    )


def _stage(spark: SparkSession, table: str, old: DataFrame, run: str, tasks: int) -> None:
    """Write the rows of the chosen files, read from exactly these, to `tasks` new files."""
    rows, columns = spark.table(table), partition_columns(spark, table)
    # Only files to be split are counted, from their footers.
    split = old.where("pieces > 1").groupBy("file").agg((F.max("position") + 1).alias("rows"))
    sized = old.join(durable(split, "split"), "file", "left")
    run_of = F.floor(F.col("position") * F.col("pieces") / F.col("rows"))
    part = (F.col("first_part") + F.coalesce(run_of, F.lit(0))).cast("int")
    staged = sized.repartitionById(tasks, part).select(*rows.columns)
    staged.write.partitionBy(*columns).parquet(f"{run}/new")

    expected = old.count()
    written = spark.read.schema(rows.schema).parquet(f"{run}/new").count()
    if expected != written:
        raise RuntimeError(f"{table}: {written} rows staged for {expected}; table left as it was")


def _report(
    spark: SparkSession, inputs: DataFrame, run: str, columns: list[str], staged: bool
) -> DataFrame:
    before = inputs.groupBy("partition").agg(
        F.count(F.lit(1)).alias("rewritten_files"), F.sum("length").alias("rewritten_bytes")
    )
    if staged:
        folder = F.substring_index(_within_table(F.col("path"), len(columns)), "/", len(columns))
        added = list_files(spark, f"{run}/new").select(folder.alias("partition"), "length")
    else:
        added = inputs.select("partition", "length")
    after = added.groupBy("partition").agg(
        F.count(F.lit(1)).alias("added_files"), F.sum("length").alias("added_bytes")
    )
    return before.join(after, "partition")
