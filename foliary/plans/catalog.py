"""Named queries over the driver's tables: each a DataFrame plan and, where SQL has the operator, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def add(run):
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return add
