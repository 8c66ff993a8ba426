"""Daily state: counts per round are kept, and a day works through its own rounds only.

The state is small, one row per round and team, whatever the number of matches. A day's rounds
take the place of what was stored for them, so a day that is run again, or was broken off
between its two tables, gives the same state.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from standwise.operators import stats
from standwise.schemas import ROUND_GOALS, ROUND_TOTALS
from standwise.sources.files import has_version, read_version, write_version

TABLES = {
    "round_totals": (ROUND_TOTALS, stats.round_totals),
    "round_goals": (ROUND_GOALS, stats.round_goals),
}


def add_rounds(spark: SparkSession, finished: DataFrame, which: Column, root: str) -> None:
    """Work out the rounds for which ``which`` holds and store them in place of older ones.

    ``which`` is a condition on ``round`` alone: the other rounds' matches are not read, only
    their stored counts. Name every round with a new, changed or withdrawn match; a round
    that has no matches left is dropped. A condition that is null does not hold, so matches
    without a round are taken by ``F.col("round").isNull()`` only.
    """
    of_day = F.coalesce(which, F.lit(False))
    day = finished.filter(which)
    for name, (schema, work) in TABLES.items():
        path = f"{root}/{name}"
        fresh = work(day).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if has_version(spark, path):
            fresh = read_version(spark, path, schema).filter(~of_day).unionByName(fresh)
        write_version(fresh, path)


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema, _ = TABLES[name]
    path = f"{root}/{name}"
    if not has_version(spark, path):
        return spark.createDataFrame([], schema)
    return read_version(spark, path, schema)


def team_stats(spark: SparkSession, root: str, standings: DataFrame) -> DataFrame:
    """``stats.team_stats`` of all matches stored so far, from their counts."""
    return stats.measured(stats.merged_totals(_stored(spark, root, "round_totals")), standings)


def round_goals(spark: SparkSession, root: str) -> DataFrame:
    """``stats.round_goals`` of all matches stored so far."""
    return _stored(spark, root, "round_goals")
