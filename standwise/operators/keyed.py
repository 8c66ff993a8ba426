"""First or last row per key, and keyed merges of tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pick(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # Filtering row_number to 1 lets Spark cut each key to one row per map task before the
    # shuffle, so a key that holds a large share of all rows never meets in one task.
    per_key = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(per_key))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first by ``order``; null keys form one group."""
    return _pick(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by ``order``; null keys form one group.

    A row without a place in the order comes before all that have one.
    """
    return _pick(df, keys, [F.col(c).desc_nulls_last() for c in order])


def has_keys(keys: Sequence[str]) -> Column:
    """True for rows whose key columns are all present."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def conform(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Source columns the target knows, the others null, all in target order and type."""
    known = set(source.columns)
    return source.select(
        *[
            (F.col(f.name) if f.name in known else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def _stamp(df: DataFrame, now: Column | None) -> DataFrame:
    if "updated_at" not in df.columns:
        return df
    return df.withColumn("updated_at", now if now is not None else F.current_timestamp())


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    now: Column | None = None,
) -> DataFrame:
    """Target with every source row put in place of the target row of the same key.

    The last source row by ``order`` wins within a key.  A replaced row takes over all
    columns: those the source lacks become null, and ``updated_at`` is set to ``now``.
    Source rows with a missing key part cannot be stored; ``has_keys`` tells them apart.
    Target rows are kept as they are where no source row has their key.

    Both tables go through one shuffle: per key, source rows rank before target rows, and
    all target rows of a key rank alike.
    """
    places = {f"_place{i}": F.col(c) for i, c in enumerate(order)}
    usable = source.filter(has_keys(keys)).withColumns(places)
    fresh = _stamp(conform(usable, T.StructType(target.schema.fields + _fields(usable, places))), now)
    fresh = fresh.withColumns({"_new": F.lit(1), "_tie": F.monotonically_increasing_id()})
    # A target row without a full key is a key of its own: nothing replaces it.
    alone = F.when(has_keys(keys), F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    old = target.withColumns({"_new": F.lit(0), "_alone": alone})
    both = fresh.withColumn("_alone", F.lit(-1).cast("long")).unionByName(old, allowMissingColumns=True)
    last = [F.col(c).desc_nulls_last() for c in ("_new", *places, "_tie")]
    per_key = Window.partitionBy(*keys, "_alone").orderBy(*last)
    ranked = both.withColumn("_rank", F.rank().over(per_key)).filter(F.col("_rank") == 1)
    return ranked.select(*target.columns)


def _fields(df: DataFrame, names) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name in names]


def replace(
    target_schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    now: Column | None = None,
) -> DataFrame:
    """The full refresh form of ``upsert``: nothing of the old table stays."""
    last = keep_last(source.filter(has_keys(keys)), keys, order)
    return _stamp(conform(last, target_schema), now)
