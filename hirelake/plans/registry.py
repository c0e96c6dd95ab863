"""Named queries over the given tables, each with its SQL counterpart if it has one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirelake.plans.sql import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder); `sql` may name any table of `plans.sql`."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register
