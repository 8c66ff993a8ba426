"""Counts kept per round, merged day by day."""

import pytest
from pyspark.sql import functions as F

from standwise.operators import matches as m
from standwise.operators import stats
from standwise.plans import daily

COLUMNS = "match_id string, round int, home string, away string, home_goals int, away_goals int"
GAMES = [
    ("g1", 1, "Oak", "Elm", 2, 1),
    ("g2", 1, "Ash", "Fir", 1, 1),
    ("g3", 2, "Elm", "Ash", 0, 2),
    ("g4", 2, "Oak", None, 3, 0),
    ("g5", 3, "Fir", "Oak", 0, 0),
    ("g6", None, "Oak", "Ash", 4, 4),
    ("g6", None, "Oak", "Ash", 4, 4),
]
TABLE = [("Oak", 1, 6, 100.0), ("Ash", 2, 4, 66.7)]


def number():
    return F.col("round")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "daily")


@pytest.fixture
def standings(spark):
    return spark.createDataFrame(TABLE, "team string, position int, points int, points_pct double")


def finished(spark, games):
    return m.finished(spark.createDataFrame(games, COLUMNS))


def same(spark, folder, standings, games, rows):
    done = finished(spark, games)
    found = daily.team_stats(spark, folder, standings)
    assert rows(found, "team") == rows(stats.team_stats(done, standings), "team")
    assert rows(daily.round_goals(spark, folder), "round") == rows(stats.round_goals(done), "round")


def test_days_add_up_to_the_whole(spark, folder, standings, rows):
    same(spark, folder, standings, [], rows)
    daily.add_rounds(spark, finished(spark, GAMES[:3]), number() <= 2, folder)
    same(spark, folder, standings, GAMES[:3], rows)
    # The late game of round 2 and a new round; rounds without a number go by themselves.
    daily.add_rounds(spark, finished(spark, GAMES), number().isin(2, 3), folder)
    same(spark, folder, standings, GAMES[:5], rows)
    for _ in range(2):
        daily.add_rounds(spark, finished(spark, GAMES), number().isNull(), folder)
        same(spark, folder, standings, GAMES, rows)


def test_a_changed_and_a_withdrawn_game(spark, folder, standings, rows):
    daily.add_rounds(spark, finished(spark, GAMES), number().isNull() | (number() > 0), folder)
    changed = [("g1", 1, "Oak", "Elm", 0, 5), *GAMES[2:4], *GAMES[5:]]
    daily.add_rounds(spark, finished(spark, changed), number().isin(1, 3), folder)
    same(spark, folder, standings, changed, rows)


def test_a_day_reads_its_own_rounds_only(spark, folder, standings, rows, tmp_path):
    path = str(tmp_path / "finished")
    finished(spark, GAMES[:5]).write.partitionBy("round").parquet(path)
    daily.add_rounds(spark, spark.read.parquet(path), number() <= 2, folder)
    old = F.when(number() <= 2, F.raise_error(F.lit("an old round was read")).cast("int"))
    guarded = spark.read.parquet(path).withColumn("home_goals", F.coalesce(old, "home_goals"))
    daily.add_rounds(spark, guarded, number() == 3, folder)
    same(spark, folder, standings, GAMES[:5], rows)


def test_a_broken_off_day_is_run_again(spark, folder, standings, rows, monkeypatch):
    daily.add_rounds(spark, finished(spark, GAMES[:2]), number() == 1, folder)
    write = daily.write_version

    def failing(df, path):
        if path.endswith("round_goals"):
            raise OSError("no space")
        write(df, path)

    monkeypatch.setattr(daily, "write_version", failing)
    with pytest.raises(OSError):
        daily.add_rounds(spark, finished(spark, GAMES[:5]), number() > 1, folder)
    monkeypatch.undo()
    daily.add_rounds(spark, finished(spark, GAMES[:5]), number() > 1, folder)
    same(spark, folder, standings, GAMES[:5], rows)
