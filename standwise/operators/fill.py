"""Carrying the last known value forward along a sequence."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 100_000


def carry_forward(
    df: DataFrame,
    key: str,
    seq: str,
    value: Column,
    name: str,
    block: int = BLOCK,
    rest: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before each row of the key.

    The sequence is cut into blocks so that a long key is filled by many tasks: each
    block fills itself, and the last value of the blocks before it fills its start.  Only
    one row per block meets in the window over a whole key.

    The rows are shuffled once: the last row of a block, which no other follows, is taken
    from the shuffled rows. It goes on with all its columns, so that both uses need the same
    ones and Spark runs one shuffle for both. Name in ``rest`` the columns that are used
    afterwards, if these are not all: one that is dropped behind this would be left out of one
    use alone.
    """
    # The key goes into a struct: equal also when null, and by plain equality, so that the
    # join finds the rows where the window over the blocks has put them.
    rows = df.select(
        F.struct(key).alias("_key"),
        F.floor(F.col(seq) / block).alias("_block"),
        F.col(seq).alias("_seq"),
        value.alias("_value"),
        F.struct(*(df.columns if rest is None else rest)).alias("_row"),
    )
    in_block = (
        Window.partitionBy("_key", "_block")
        .orderBy("_seq")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    following = Window.partitionBy("_key", "_block").orderBy("_seq")
    filled = rows.withColumns(
        {
            "_own": F.last("_value", ignorenulls=True).over(in_block),
            "_ends": F.lead(F.lit(True)).over(following).isNull(),
        }
    )
    earlier = (
        Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    known = F.when(F.col("_own").isNotNull(), F.struct("_own", "_row"))
    before = F.last(known, ignorenulls=True).over(earlier)
    carried = filled.where("_ends").select("_key", "_block", before.alias("_before"))
    carried = carried.select("_key", "_block", F.col("_before._own").alias("_carried"))
    joined = filled.join(carried, ["_key", "_block"], "left")
    return joined.select("_row.*", F.coalesce("_own", "_carried").alias(name))
