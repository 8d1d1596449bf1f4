"""A registered query: the Spark side, the other engine's SQL where there is one, and what it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Case:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Cases(list):
    """Collects cases through a decorator, so that each query sits next to its SQL."""

    def add(self, name: str, covers: str, sql: str | None = None):
        def keep(run: Callable[[SparkSession, str], DataFrame]):
            self.append(Case(name, covers, run, sql))
            return run

        return keep
