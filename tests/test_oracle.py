"""Registered queries against the other engine on the smallest tables.

A few of each kind by default; all of them with ALL_QUERIES=1, which takes several minutes.
"""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import compare, connect

from loglattice.registry import CASES

SMALL = "/root/testdata/sf0.001"


DEFAULT = """
service_overview service_latency http_status hourly_trend rollup_service_overview gold_service_risk feature_dataset
label_join_large_list dedupe silver_events parse_lines decode_records encode_series null_profile cardinality co_missing
estate_kpis service_cards pattern_summary early_warning_base evaluate undersample leakage_report service_insights
chosen_texts number_grounding stream_silver
""".split()


def chosen():
    return [c for c in CASES if c.sql is not None and (os.environ.get("ALL_QUERIES") or c.name in DEFAULT)]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("case", chosen(), ids=lambda c: c.name)
def test_query_equals_oracle(spark, duck, case):
    assert compare(spark, duck, case, SMALL)[2] == "ok"


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() == 12
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
