"""Registered queries hand whole tables to their operators."""

import pytest

from loglattice.registry import CASES, parse_cases
from loglattice.registry.fixture import logs, table
from tests.test_oracle import SMALL, compare, connect

QUERIES = {c.name: c for c in CASES}


@pytest.mark.parametrize("name", ["decode_key_value", "decode_key_value_all"])
def test_broken_messages_reach_the_decoder(spark, monkeypatch, name):
    given, decode = [], parse_cases.K.decode_kv
    monkeypatch.setattr(parse_cases.K, "decode_kv", lambda df: given.append(df) or decode(df))
    QUERIES[name].run(spark, SMALL)
    assert given[0].count() == logs(spark, SMALL).count()


def test_broken_messages_come_back_with_null_fields(spark):
    out = QUERIES["decode_key_value_all"].run(spark, SMALL)
    assert out.count() == logs(spark, SMALL).count()
    assert out.where("service IS NULL AND id_length IS NULL AND key IS NOT NULL").count() > 0


def test_audits_take_every_column(spark):
    items = table(spark, SMALL, "lineitem")
    names = [r.column_name for r in QUERIES["cardinality_line_items_all"].run(spark, SMALL).collect()]
    assert sorted(names) == sorted(items.columns)


@pytest.mark.parametrize(
    "name", ["decode_key_value", "decode_key_value_all", "cardinality_line_items_all", "describe_line_items_all"])
def test_query_equals_oracle(spark, name):
    assert compare(spark, connect(SMALL), QUERIES[name], SMALL)[2] == "ok"
