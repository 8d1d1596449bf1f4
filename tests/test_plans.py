"""Physical plans: where rows are shuffled, what reaches the scan, and what must never appear."""

import re

import pytest

from loglattice.operators import joins as J
from loglattice.operators.dedupe import dedupe
from loglattice.plans import gold as G, rollup as R, views as V
from loglattice.registry import CASES
from loglattice.registry.fixture import labels, logs, silver

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "silver")
    silver(spark, SMALL).write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def test_gold_is_one_shuffle_after_a_partial_aggregate(stored):
    text = plan(G.service_performance(stored))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert text.count("HashAggregate") == 2 and "partial_count" in text


def test_views_read_only_their_columns(stored):
    text = plan(V.hourly_trend(stored))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == {"event_timestamp", "log_level", "status_code", "is_anomaly"}


def test_latency_filters_reach_the_scan(stored):
    text = plan(V.service_latency(stored))
    assert "IsNotNull(status_code)" in text and "IsNotNull(response_time)" in text


def test_dates_prune_partitions(stored):
    text = plan(V.daily_trend(stored).where("event_date = date'2024-01-03'"))
    assert re.search(r"PartitionFilters: \[.*event_date.*2024-01-03", text)


def test_small_label_list_is_broadcast_and_events_are_not_shuffled(spark):
    text = plan(J.attach_labels(logs(spark, SMALL), labels(spark, SMALL)))
    assert "BroadcastHashJoin" in text and not re.search(r"Exchange hashpartitioning\(event", text)


def test_duplicates_are_cut_before_the_shuffle(spark):
    text = plan(dedupe(logs(spark, SMALL)))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_rollup_views_share_one_shape(stored):
    text = plan(R.service_overview(R.hourly_rollup(stored)))
    assert text.count("FileScan") == 1


# these run jobs while they are built
FITS = ("fit", "anomaly_logistic", "anomaly_decision", "anomaly_random", "anomaly_feature", "health_", "stream_", "label_index")


def plain_cases():
    return [c for c in CASES if not c.name.startswith(FITS)]


@pytest.mark.parametrize("case", plain_cases(), ids=lambda c: c.name)
def test_no_python_rows_and_no_cross_join(spark, case):
    text = plan(case.run(spark, SMALL))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
        assert operator not in text, operator
