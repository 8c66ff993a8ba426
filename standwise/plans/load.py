"""Loading result tables: storage types, keyed merges and a status row per table."""

from collections.abc import Collection, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standwise.operators.keyed import has_keys, replace, upsert
from standwise.operators.matches import coerce
from standwise.schemas import DECIMALS, STAMPED, TARGETS, TEXT_LIMITS
from standwise.sources.files import has_version, read_version, write_version
from standwise.sources.staging import stage

# Tables loaded at the same time; the last tasks of one leave cores to the next.
AT_ONCE = 3

STATUS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("detail", T.StringType()),
    ]
)


def stored_schema(name: str) -> T.StructType:
    """Schema of a table at rest: rounded measures as decimals, load time where kept."""
    schema, _, _ = TARGETS[name]
    fields = [
        T.StructField(f.name, T.DecimalType(*DECIMALS[f.name]) if f.name in DECIMALS else f.dataType)
        for f in schema.fields
    ]
    if name in STAMPED:
        fields.append(T.StructField("updated_at", T.TimestampType()))
    return T.StructType(fields)


def as_stored(df: DataFrame) -> DataFrame:
    """Measures as the decimals they are stored in, ties rounded away from zero."""
    return df.withColumns(
        {c: F.col(c).cast(T.DecimalType(*DECIMALS[c])) for c in df.columns if c in DECIMALS}
    )


def text_overflow(columns: list[str]) -> Column:
    """Names of the text columns whose value is longer than the table allows."""
    none = F.array().cast("array<string>")

    def check(name: str) -> Column:
        # A text has no more characters than bytes, which are known without counting.
        limit = TEXT_LIMITS[name]
        too_long = (F.octet_length(name) > limit) & (F.length(name) > limit)
        return F.when(too_long, F.array(F.lit(name))).otherwise(none)

    return F.concat(none, *[check(c) for c in columns if c in TEXT_LIMITS])


def prepared(df: DataFrame, name: str, order: Sequence[str] = ()) -> DataFrame:
    """Columns the table knows, in its types, with the texts it cannot hold marked.

    The columns of ``order`` are kept as ``order_0``, ``order_1`` and so on.
    """
    schema, _, _ = TARGETS[name]
    places = {f"order_{i}": F.col(c) for i, c in enumerate(order)}
    names = [c for c in df.columns if c in schema.names]
    known = df.withColumns(places).select(*names, *places)
    return as_stored(coerce(known, schema)).withColumn("overflow", text_overflow(names))


def storable(df: DataFrame, keys: list[str]) -> Column:
    return has_keys(keys) & (F.size("overflow") == 0)


def load_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    root: str,
    now: Column | None = None,
    order: Sequence[str] = (),
    stored: bool = False,
) -> tuple[int, int]:
    """Merge the rows into the stored table as its next version.

    ``order`` names the columns that tell the order of the source rows: the last row of a
    key is stored. Without it, or between rows of one place, the row with the greatest
    values is, and a value counts for more than none.
    ``stored`` tells that the rows are read from a stored table, with nothing but columns and
    filters of one row between: they are read twice then instead of being written once more.

    Returns the stored rows and the rows rejected for a missing key or a too long text;
    the rejected ones are kept next to the table. The new version counts from the moment
    it is written to its end; a failed load leaves the table as it was.
    """
    _, keys, mode = TARGETS[name]
    schema, path = stored_schema(name), f"{root}/{name}"
    rows = prepared(df, name, order)
    if not stored:
        # Both the good and the bad rows are read from it, so the input is worked out once.
        rows = stage(rows)
    good = rows.filter(storable(rows, keys)).drop("overflow")
    bad = rows.filter(~storable(rows, keys))
    places = [f"order_{i}" for i in range(len(order))]
    by = places + [c for c in good.columns if c not in (*keys, *places)]
    if mode == "replace":
        merged = replace(schema, good, keys, by, now)
    else:
        stored = read_version(spark, path, schema) if has_version(spark, path) else None
        target = stored if stored is not None else spark.createDataFrame([], schema)
        merged = upsert(target, good, keys, by, now)
    write_version(merged, path)
    write_version(bad, f"{root}/_rejected/{name}")
    kept = read_version(spark, path, schema).count()
    dropped = read_version(spark, f"{root}/_rejected/{name}", bad.schema).count()
    return kept, dropped


def load_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    now: Column | None = None,
    orders: Mapping[str, Sequence[str]] | None = None,
    stored: Collection[str] = (),
) -> DataFrame:
    """Load every known table; missing inputs are skipped and a failure stops no other.

    ``orders`` holds the order of a table's source rows and ``stored`` names the tables whose
    rows are read from stored ones, see ``load_table``.
    """
    orders = orders or {}

    def status(name: str) -> tuple:
        if name not in tables:
            return name, "skipped", None, None, None
        try:
            kept, dropped = load_table(
                spark, tables[name], name, root, now, orders.get(name, ()), name in stored
            )
            return name, "loaded", kept, dropped, None
        except Exception as error:
            return name, "failed", None, None, str(error)

    # Hands the session back where threads need nothing.
    inherit = inheritable_thread_target(spark)
    with ThreadPool(AT_ONCE) as pool:
        rows = pool.map(status if inherit is spark else inherit(status), TARGETS, chunksize=1)
    return spark.createDataFrame(rows, STATUS)
