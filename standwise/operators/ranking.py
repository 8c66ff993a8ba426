"""Ranks over a whole table without bringing it into one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from standwise.sources.staging import stage

# monotonically_increasing_id holds the partition above bit 33 and the row within below.
ROW_BITS = 33


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of each row in the order given.

    One range shuffle sorts the table; the sorted rows are staged with their place in
    their partition, and the partition sizes, one row per sort task, give the offsets.
    End ``order`` with a column that tells copies apart, so that a large group of equal
    rows can be split over partitions.
    """
    row = "_row"
    staged = stage(df.orderBy(*order).withColumn(row, F.monotonically_increasing_id()))
    part = F.shiftright(row, ROW_BITS)
    sizes = staged.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = F.col(row).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # At most one row per sort task, so the broadcast is bounded.
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_part", "_offset", row)
    )


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of the order."""
    return df.orderBy(*order).limit(n)


def ranked_top(df: DataFrame, order: list[Column], n: int, name: str) -> DataFrame:
    """First ``n`` rows with their 1-based rank; the rank window sees ``n`` rows only."""
    rank = F.row_number().over(Window.orderBy(*order))
    return top(df, order, n).withColumn(name, rank)


def rank_teams(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based rank in a table that holds one row per team of a league.

    One task sees the whole table; ``global_rank`` is for tables without such a bound.
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
