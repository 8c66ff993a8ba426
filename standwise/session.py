"""A local session for tests, checks and the benchmark; clusters bring their own."""

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None) -> SparkSession:
    cores = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("standwise")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # The local tables are single files that one task reads; joining the larger ones by
        # shuffle spreads the work that follows over the cores.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
