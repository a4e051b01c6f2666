"""What goes through the driver does not grow with the pages."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.registry import QUERIES
from tessera.sources import commit

FOLDER = "/root/testdata/sf0.001"
SETTINGS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def broadcasts(spark, since):
    """(execution, description) of hash tables that were sent to all executors after the execution ``since``, if it is given, else the last one."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    executions = [store.executionsList().apply(i) for i in range(store.executionsList().size())]
    if since is None:
        return max((e.executionId() for e in executions), default=-1)
    out = []
    for e in executions:
        nodes = store.planGraph(e.executionId()).allNodes()
        out += [nodes.apply(i).desc() for i in range(nodes.size()) if e.executionId() > since and nodes.apply(i).name() == "BroadcastExchange"]
    return [d for d in out if "HashedRelation" in d]


def test_a_side_is_broadcast_by_its_measured_size(spark, monkeypatch):
    """Files of repeated values are a fraction of their rows; settings come back, also behind an error."""
    before = [spark.conf.get(name, None) for name in SETTINGS]
    rows = spark.range(60_000).select((F.col("id") % 50).alias("k"), F.lit("a value of some length" * 9).alias("v"))
    small, path = commit.staged(rows, "small")
    large, _ = commit.staged(spark.range(90_000).select((F.col("id") * 40).alias("k")), "large")

    def joined(spark):
        since = broadcasts(spark, None)
        out, _ = commit.staged(large.join(small, "k"), "joined")
        return out.count(), broadcasts(spark, since)

    assert sum(os.path.getsize(f"{path.removeprefix('file:')}/{f}") for f in os.listdir(path.removeprefix("file:"))) < commit.MEASURED_BYTES
    n, sent = joined(spark)
    assert sent and commit.measured_joins(joined)(spark) == (n, [])
    monkeypatch.setattr(commit, "MEASURED_BYTES", 64 << 20)
    n_again, sent = commit.measured_joins(joined)(spark)
    assert n_again == n and sent
    with pytest.raises(ZeroDivisionError):
        commit.measured_joins(lambda spark: 1 / 0)(spark)
    assert [spark.conf.get(name, None) for name in SETTINGS] == before


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", ["extract_complex", "second_complex_bodies"])
def test_complex_pages_send_nothing_through_the_driver_that_was_not_measured(spark, monkeypatch, name):
    """Where nothing counts as small, no table of the plan is broadcast, nor when its result is read."""
    monkeypatch.setattr(commit, "MEASURED_BYTES", 0, raising=False)
    since = broadcasts(spark, None)
    assert QUERIES[name](spark, FOLDER).count() > 0
    assert broadcasts(spark, since) == []
