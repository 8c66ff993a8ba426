"""Helpers of the operators in this package."""

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A batch of rows that a Python worker gets at once; one longer text makes its own batch.
BATCH_BYTES = 16 << 20


def column(name: str) -> Column:
    """A column by its plain name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def bounded(spark: SparkSession) -> None:
    """Make ready for Python workers: batches of at most BATCH_BYTES, however long the texts
    are, and this library on their path, wherever the session was started."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if not getattr(context, "has_library", False):
        context.addPyFile(_library())
        context.has_library = True


def _library() -> str:
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="library-"), "standwise.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    return path


def texts(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, body, more...): ids and the UTF-8 bytes of whole texts; a null text is empty.

    Only these columns are read, so further columns of any name do no harm.
    """
    bounded(df.sparkSession)
    body = F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary")
    return df.select(column(id_col).cast("long").alias("id"), body.alias("body"), *more)


def per_batch(
    df: DataFrame, schema: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], dict]]
) -> DataFrame:
    """Columns from a function of Arrow batches; ``make`` builds it once per task."""
    fields = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                found = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[f.name], f.type) for f in fields], schema=fields
                )

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def carried(df: DataFrame) -> DataFrame:
    """All columns of a table packed into ``row``: what an operator adds can't clash with them."""
    bounded(df.sparkSession)
    return df.select(F.struct("*").alias("row"))
