"""Staged tables that are removed as they pass."""

import os

import pytest
from pyspark.sql import functions as F

from standwise.sources import staging


@pytest.fixture
def left(spark, tmp_path, monkeypatch):
    """Names of the staged folders that stand."""
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path))
    return lambda: sorted(os.listdir(tmp_path))


def test_steps_leave_their_last_result_only(spark, left):
    seen = []

    def step(rows):
        seen.append(len(left()))
        own = staging.stage(rows.withColumn("n", F.col("n") + 1))
        return staging.stage(own.filter("n > 1")).withColumn("own", F.col("n") * 2)

    found = staging.in_turn(spark, spark.range(5).select(F.col("id").alias("n")), [step] * 3)
    assert sorted(found.collect()) == [(n, 2 * n) for n in range(4, 8)]
    assert seen == [0, 1, 1] and len(left()) == 1


def test_a_failing_step_leaves_nothing_of_its_own(spark, left):
    def broken(rows):
        staging.stage(rows)
        raise ValueError("broken")

    with pytest.raises(ValueError):
        staging.in_turn(spark, spark.range(3), [broken])
    assert left() == [] and staging._runs == []


def test_inside_a_run_the_result_goes_with_it(spark, left):
    with staging.staged_for(spark):
        found = staging.in_turn(spark, spark.range(3), [lambda rows: rows])
        assert found.count() == 3 and len(left()) == 1
    assert left() == []
    assert staging.in_turn(spark, spark.range(3), []).count() == 3
