"""Replacing parts of a layer, published versions, and bucketed layers."""

import pytest
from pyspark.sql import functions as F

from loglattice.operators.dedupe import dedupe
from loglattice.operators.joins import attach_bucketed_labels
from loglattice.sinks import versions as N


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_other_partitions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    N.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string"), path, ["p"])
    N.replace_partitions(spark.createDataFrame([(3, "b"), (4, "c")], "n int, p string"), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("n", "p").collect()) == [(1, "a"), (3, "b"), (4, "c")]


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        N.read_published(spark, path)
    assert N.publish(spark.range(3), path) == 1
    opened = N.read_published(spark, path)
    # a run that died before its mark
    spark.range(99).write.parquet(f"{path}/version=2")
    assert N.read_published(spark, path).count() == 3
    assert N.publish(spark.range(5), path) == 2
    assert opened.count() == 3 and N.read_published(spark, path).count() == 5 and N.read_published(spark, path, 1).count() == 3


def test_bucketed_layers_join_and_group_without_a_shuffle(spark):
    events = spark.createDataFrame(
        [(str(i % 40), f"i{i % 9}" if i % 3 else None, i) for i in range(200)], "event_id string, instance_id string, kafka_offset long")
    N.write_bucketed(events, "bucketed_ids", "event_id", 4)
    N.write_bucketed(events, "bucketed_instances", "instance_id", 4)
    N.write_bucketed(spark.createDataFrame([("i1",), ("i4",)], "instance_id string"), "bucketed_labels", "instance_id", 4)
    joined = attach_bucketed_labels(spark.table("bucketed_instances"), spark.table("bucketed_labels"))
    first = dedupe(spark.table("bucketed_ids"), "spread_key")
    for df in (joined, first):
        assert "Exchange" not in plan(df)
    assert joined.count() == 200
    assert joined.agg(F.sum("is_anomaly")).first()[0] == events.where("instance_id IN ('i1', 'i4')").count()
    assert sorted(r.kafka_offset for r in first.collect()) == list(range(40))
    for name in ("bucketed_ids", "bucketed_instances", "bucketed_labels"):
        spark.sql(f"DROP TABLE {name}")
