"""The model tables over the given ones: how often their rows are shuffled."""

from datetime import datetime

import pytest

from standwise.sources.binding import GIVEN, Tables

ROWS = {
    "region": [(0, "R0"), (1, "R1")],
    "nation": [(0, "N0", 0), (1, "N1", 1), (2, "N2", None)],
    "customer": [(1, "c", 0, 1.0, "m"), (2, "c", 1, 1.0, "m"), (3, "c", None, 1.0, "m"), (1, "c", 1, 1.0, "m")],
    "supplier": [(1, "s1", 0, 1.0), (2, "s2", 1, 1.0), (3, None, 1, 1.0)],
    "orders": [(k, c, "O", 1.0, datetime(2020, 1, 2), "p") for k, c in ((1, 1), (2, 2), (3, 3), (4, None))],
    "lineitem": [
        (k, 1, s, n, 1.0, 1.0, 0.0, 0.0, "R", "O", datetime(2020, 2, 3))
        for n, (k, s) in enumerate([(1, 1), (1, 2), (2, 1), (2, 3), (3, 1), (4, 1), (None, 1), (1, None), (1, 3)])
    ],
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, GIVEN[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


def shuffles_above(plan, leaf):
    """How many shuffles the rows of a scan go through, by the plan's indentation."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line and "FileScan" in line)
    found, depth = 0, len(lines[at])
    for line in reversed(lines[: at + 1]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            found += "Exchange hashpartitioning" in line
    return found


def test_lines_are_shuffled_twice_at_most(spark, tables):
    """By supplier, unless these are sent to every task, and by order."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = tables.game_lines._jdf.queryExecution().executedPlan().toString()
        assert shuffles_above(plan, "l_suppkey") <= 2
    finally:
        spark.conf.set(name, before)


def test_lines_by_hand(tables):
    rows = tables.game_lines.select("l_orderkey", "l_linenumber", "home_name", "away_name", "s_name").collect()
    host = {1: ["N0", "N1"], 2: ["N1"]}
    away = {1: ("N0", "s1"), 2: ("N1", "s2"), 3: ("N1", None)}
    wanted = [
        (k, n, home, *away[s])
        for k, _, s, n, *_ in ROWS["lineitem"]
        for home in host.get(k, [])
        if s in away and home != away[s][0]
    ]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted))
