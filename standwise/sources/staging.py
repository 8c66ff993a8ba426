"""Staged tables: cut a plan by writing it to the shared checkpoint folder."""

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the session's checkpoint folder.

    Only a local session without one gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="standwise-")
    context.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, label: str = "stage") -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


# Staged folders of the runs in progress, the innermost last.
_runs: list[list[str]] = []


# Codec for large tables, where room counts for more than the time to write them.
SMALLEST = "zstd"


def stage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write the table once and return a reader of it; without a codec by the session's."""
    spark = df.sparkSession
    path = staging_path(spark)
    if _runs:
        _runs[-1].append(path)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_for(spark: SparkSession) -> Iterator[None]:
    """Remove what was staged inside, once nothing read from it is needed any more."""
    paths: list[str] = []
    _runs.append(paths)
    try:
        yield
    finally:
        _runs.pop()
        for path in paths:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def in_turn(
    spark: SparkSession, rows: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """What the steps make of the rows one after another, each result staged.

    All that a step staged itself goes once its result is written, and so does the result
    before it: at most two results and one step's own tables stand at a time.
    """
    last = None
    for step in steps:
        path = staging_path(spark)
        with staged_for(spark):
            made = step(rows)
            made.write.parquet(path)
        rows = spark.read.schema(made.schema).parquet(path)
        if last is not None:
            _remove(spark, last)
        last = path
    if last is not None and _runs:
        _runs[-1].append(last)
    return rows
