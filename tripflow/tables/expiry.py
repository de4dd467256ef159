"""Removing what runs have left behind, once it is old enough and nothing needs it.

Three kinds of folders outlive their run: intermediate results in the shared scratch folder,
versions of replaced tables, and work folders of compactions. A register lists them with the time
of their last change, taken from their files; a clock, not a counter, decides what is old.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import scratch
from tripflow.tables.catalog import location, versions_root
from tripflow.tables.compact import WORK
from tripflow.tables.files import Files
from tripflow.tables.versions import DONE, Versions

# Fixed value: what is older goes.
KEEP = timedelta(days=7)
SCRATCH, VERSION, COMPACTION = "scratch", "version", "compaction"
REGISTER = "kind string, path string, changed timestamp, bytes long, in_use boolean"


def _entries(files: Files, root: str) -> list[str]:
    return [f"{root}/{name}" for name in files.names(root) if not name.endswith(DONE)]


def _candidates(spark: SparkSession, tables: Sequence[str], scratch_root: str | None) -> list[tuple]:
    """kind, path, whether it is in use; one entry for each folder, not for each file."""
    found = []
    for table in tables:
        place = location(spark, table)
        files = Files(spark, place)
        root = versions_root(spark, table)
        if root:
            # The version the catalog points to, and the last one, which a new catalog would take.
            last = Versions(spark, root).last()
            used = {place, Versions(spark, root).path(last) if last is not None else place}
            found += [(VERSION, path, path in used) for path in _entries(files, root)]
        for path in _entries(files, f"{place}/{WORK}"):
            # A run with this mark is half way through its swap and still to be finished.
            found.append((COMPACTION, path, files.exists(f"{path}/READY")))
    if scratch_root:
        files = Files(spark, scratch_root)
        tables_at = [location(spark, t) for t in tables]
        for path in _entries(files, scratch_root):
            found.append((SCRATCH, path, any(t == path or t.startswith(f"{path}/") for t in tables_at)))
    return found


def register(
    spark: SparkSession, tables: Sequence[str] = (), scratch_root: str | None = None
) -> DataFrame:
    """kind, path, changed, bytes, in_use: every folder that runs have left.

    `tables`: whose versions and work folders are listed. `scratch_root`: a folder of intermediate
    results; every folder directly below it is one. `changed` is the time of the newest file in it,
    or of the folder where it has none.
    """
    found = _candidates(spark, tables, scratch_root)
    rows = []
    for kind, path, used in found:
        changed, size = Files(spark, path).age_and_size(path)
        rows.append((kind, path, datetime.fromtimestamp(changed / 1000, timezone.utc), size, used))
    return spark.createDataFrame(rows, REGISTER)


def expired(found: DataFrame, at: datetime, keep: timedelta = KEEP) -> DataFrame:
    """The entries of a register that are not in use and older than `keep` at the time `at`."""
    before = F.lit(at - keep).cast("timestamp")
    return found.where(~F.col("in_use") & (F.col("changed") < before))


def expire(
    spark: SparkSession,
    tables: Sequence[str] = (),
    scratch_root: str | None = None,
    at: datetime | None = None,
    keep: timedelta = KEEP,
    dry: bool = False,
) -> DataFrame:
    """Remove what is expired at the time `at` (now); gives the register with a column `removed`.

    A version goes mark first, so that nobody takes it for whole while it goes. Run it while no job
    older than `keep` is still working: what such a job has written long ago looks unused. `dry`
    only tells.
    """
    at = at or datetime.now(timezone.utc)
    found = register(spark, tables, scratch_root)
    gone = expired(found, at, keep).select("path").withColumn("removed", F.lit(True))
    told = found.join(gone, "path", "left").withColumn("removed", F.coalesce("removed", F.lit(False)))
    # Worked out before anything goes; one row per folder.
    rows = told.select("kind", "path", "changed", "bytes", "in_use", "removed").collect()
    if not dry:
        for row in rows:
            if row["removed"]:
                files = Files(spark, row["path"])
                files.delete(row["path"] + DONE)
                files.delete(row["path"])
    return spark.createDataFrame(rows, f"{REGISTER}, removed boolean")


def scratch_root(spark: SparkSession) -> str:
    """The folder that holds this session's intermediate results."""
    return scratch(spark, "any").rsplit("/", 1)[0]
