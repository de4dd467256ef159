import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.sql.warehouse.dir": "/tmp/tripflow-warehouse"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from tripflow.session import scratch

    return scratch(spark, "test")


@pytest.fixture
def namespace(spark):
    """Fresh tables at a place of their own."""
    import uuid

    from tripflow.session import scratch
    from tripflow.tables.catalog import create_tables

    name = f"tests_{uuid.uuid4().hex[:10]}"
    create_tables(spark, name, scratch(spark, "tables"))
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(str(TESTDATA / "sf0.01/events.parquet"))


@pytest.fixture(scope="session")
def trips(events):
    from pyspark.sql import functions as F

    from tripflow.operators.clean import clean
    from tripflow.sources.events import raw_trips

    return clean(raw_trips(events), F.col("event_id"))
