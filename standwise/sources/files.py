"""Text files, dated snapshots, versioned tables and JSON records."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that stand for a missing value in a text file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Cells may hold quotes (doubled), line breaks, and blanks on either side.
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# What a finished write leaves in its folder; a folder without it is not read.
DONE = "_SUCCESS"


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True
) -> DataFrame:
    """Rows of text files as columns of an all-text schema, found by the names in the header.

    Columns that the file lacks are null, further ones are left out, and tokens become null.
    A file whose cells may hold line breaks is read by one task; without ``line_breaks``
    large files are split.
    """
    rows = spark.read.options(**CSV, multiLine=line_breaks).csv(path)
    rows = rows.toDF(*[c.lstrip("\ufeff") for c in rows.columns])

    def cell(name: str) -> Column:
        if name not in rows.columns:
            return F.lit(None).cast("string")
        return F.when(~F.col(f"`{name}`").isin(*NULL_TOKENS), F.col(f"`{name}`"))

    return rows.select(*[cell(f.name).alias(f.name) for f in schema.fields])


def write_snapshot(df: DataFrame, path: str, day: str) -> None:
    """Write the rows as the snapshot of a day.

    A day's later snapshot stands next to its earlier one and takes its place once it is
    finished; nothing is deleted, so a failed write changes nothing.
    """
    taken = [n for n in folders(df.sparkSession, path) if n.startswith(f"snapshot_date={day}.")]
    df.write.parquet(f"{path}/snapshot_date={day}.{len(taken) + 1:04d}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a path; none when the path does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def newest(spark: SparkSession, path: str, column: str) -> str | None:
    """The last value of a partition column, by name, among the folders written to the end."""
    values = [name for name in folders(spark, path) if name.startswith(f"{column}=")]
    for name in reversed(values):
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/{DONE}")
        if mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
            return name.split("=", 1)[1]
    return None


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, column: str = "snapshot_date"
) -> DataFrame:
    """Rows of the newest snapshot; only its files are read."""
    last = newest(spark, path, column)
    if last is None:
        raise FileNotFoundError(f"no {column} under {path}")
    return spark.read.schema(schema).parquet(f"{path}/{column}={last}")


def write_version(df: DataFrame, path: str) -> None:
    """Add the rows as the next version; versions being read are never touched.

    The number is beyond those of unfinished versions too, so what a failed write left
    behind is neither read nor written over.
    """
    taken = [n for n in folders(df.sparkSession, path) if n.startswith("version=")]
    last = int(taken[-1].split("=", 1)[1]) if taken else 0
    df.write.parquet(f"{path}/version={last + 1:08d}")


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the newest version of a table."""
    return read_latest(spark, path, schema, "version")


def has_version(spark: SparkSession, path: str) -> bool:
    return newest(spark, path, "version") is not None


def json_records(df: DataFrame) -> DataFrame:
    """Each row as a JSON record; dates, times and decimals as text, nulls kept."""
    plain = (T.NumericType, T.BooleanType, T.StringType)

    def value(field: T.StructField) -> Column:
        as_is = isinstance(field.dataType, plain) and not isinstance(field.dataType, T.DecimalType)
        column = F.col(field.name)
        return column if as_is else column.cast("string").alias(field.name)

    record = F.struct(*[value(f) for f in df.schema.fields])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types of a table's columns, in order."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
