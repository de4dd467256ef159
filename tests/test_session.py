"""Settings and the scratch folder."""

import pytest

from tripflow import session
from tripflow.session import SETTINGS, configure, durable, scratch


def test_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    configure(spark)
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())


def test_scratch_follows_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda *a: "hdfs://shared/work/")
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one.startswith("hdfs://shared/work/x-") and one != two


class Cluster:
    """A session on a cluster with no shared folder set."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch(Cluster, "x")


def test_durable(spark):
    rows = durable(spark.range(100).selectExpr("id", "rand() AS r"), "rows")
    assert rows.count() == 100 and rows.exceptAll(rows).count() == 0
