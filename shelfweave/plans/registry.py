"""Named queries and, next to each, the SQL that says what it must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfweave.plans.oracle_views import with_views
from shelfweave.sources.catalog import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of the catalogue under a name, with its check query."""

    def keep(build: Callable[[Catalog], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Catalog(spark, sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return build

    return keep
