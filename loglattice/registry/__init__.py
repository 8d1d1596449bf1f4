"""Every registered query."""

from loglattice.registry import (
    audit_cases,
    gold_cases,
    insight_cases,
    model_cases,
    parse_cases,
    serving_cases,
    silver_cases,
    sketch_cases,
    storage_cases,
    stream_cases,
    upkeep_cases,
)
from loglattice.registry.case import Case

CASES: list[Case] = [
    *gold_cases.CASES,
    *silver_cases.CASES,
    *parse_cases.CASES,
    *audit_cases.CASES,
    *serving_cases.CASES,
    *model_cases.CASES,
    *insight_cases.CASES,
    *sketch_cases.CASES,
    *storage_cases.CASES,
    *stream_cases.CASES,
    *upkeep_cases.CASES,
]

assert len({c.name for c in CASES}) == len(CASES), "query names must be unique"
