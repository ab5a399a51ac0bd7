"""All queries by name, with their SQL twins, and the shipping of this package to executors."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliary.plans import catalog, catalog_all  # noqa: F401

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors, unless their Python path has it already."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="foliary-ship-"), "foliary"), "zip", _ROOT, "foliary")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in catalog.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in catalog.QUERIES.items() if q.sql}
