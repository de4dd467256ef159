"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Calendar columns depend on the session zone, so it is pinned.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The percentile sketch runs in an object hash aggregate, which by default turns into a sort
    # of the task's input at 128 groups. A scan task that packs several days passes that; 1,024
    # (hour, day) sketches stay well below an executor's memory.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
}


def build_session(app: str = "tripflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; the shuffle width is left to the cluster and AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every column expression takes longer than small queries do.
        builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared checkpoint folder.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        active = spark.sparkContext.getCheckpointDir()
        if active:
            base = active
        elif spark.sparkContext.master.startswith("local"):
            base = tempfile.mkdtemp(prefix="tripflow-")
            spark.sparkContext.setCheckpointDir(base)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str) -> DataFrame:
    """`df` computed once into the shared folder, then read back.

    Used where two branches must see the very same rows, and to end a lineage: a lost executor
    costs a re-read of files, not a re-run of the job.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for one write only."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
