"""Registration of named queries with the SQL that checks them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from standwise.sources.binding import Tables

PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the given tables, and the SQL with the same result."""

    def register(plan: Callable[[Tables], DataFrame]):
        PLANS[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


def runner(plan: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plan(Tables(spark, folder))

    return run
