"""Metrics, team statistics, recent form and round goals on small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from standwise.functions import numbers, scoring
from standwise.operators import matches as m
from standwise.operators import stats
from standwise.plans import queries as q

COLUMNS = "match_id string, round int, home string, away string, home_goals int, away_goals int"
GAMES = [
    ("g1", 1, "Oak", "Elm", 2, 1),
    ("g2", 1, "Ash", "Fir", 1, 1),
    ("g3", 2, "Elm", "Ash", 0, 2),
    ("g4", 2, "Oak", "Yew", 3, 0),
]
TABLE = [("Oak", 1, 6, 100.0), ("Ash", 2, 4, 66.7), ("Elm", 3, 3, 50.0), ("Fir", 4, 1, 33.3)]


@pytest.fixture
def finished(spark):
    return m.finished(spark.createDataFrame(GAMES, COLUMNS))


@pytest.fixture
def standings(spark):
    return spark.createDataFrame(TABLE, "team string, position int, points int, points_pct double")


def score_of(spark, pct, diff, goals, games):
    df = spark.createDataFrame([(pct, diff, goals, games)], "p double, d int, g int, n int")
    column = scoring.performance_score(F.col("p"), F.col("d"), F.col("g"), F.col("n"))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "args",
    [(66.7, 5, 15, 10), (0.0, -10, 0, 10), (100.0, 20, 30, 10), (50.0, 0, 0, 0), (0.0, -90, 0, 1)],
)
def test_score_stays_in_range(spark, args):
    assert 0 <= score_of(spark, *args) <= 100


def test_score_orders_teams(spark):
    assert score_of(spark, 100.0, 20, 25, 10) > score_of(spark, 10.0, -15, 5, 10)


def test_score_formula(spark):
    # 0.5*66.7 + 0.3*(5*0.5+50) + 0.2*(10*1.5)
    assert score_of(spark, 66.7, 5, 15, 10) == pytest.approx(52.1, abs=0.005)


def test_score_without_inputs(spark):
    assert score_of(spark, None, None, None, None) == 15.0


def test_score_without_share_is_not_100(spark):
    assert score_of(spark, None, 5, 15, 10) < 50


def test_team_totals(finished, standings, rows):
    table = {r["team"]: r for r in rows(stats.team_stats(finished, standings))}
    assert set(table) == {"Oak", "Elm", "Ash", "Fir", "Yew"}
    oak = table["Oak"]
    assert (oak["total_games"], oak["home_games"], oak["away_games"]) == (2, 2, 0)
    assert (oak["total_wins"], oak["total_goals_for"], oak["total_goals_against"]) == (2, 5, 1)
    assert oak["goal_diff_calc"] == 4 and oak["avg_goals_for"] == 2.5
    assert oak["points_pct_calc"] == 100.0
    assert table["Yew"]["position"] is None and table["Yew"]["score"] >= 0
    for r in table.values():
        assert r["goal_diff_calc"] == r["total_goals_for"] - r["total_goals_against"]
        assert r["total_games"] == r["total_wins"] + r["total_ties"] + r["total_losses"]


def test_empty_standings_leave_null_positions(finished, standings):
    table = stats.team_stats(finished, standings.limit(0)).collect()
    assert len(table) == 5 and all(r.position is None for r in table)


def test_recent_form(finished, rows):
    form = {r["team"]: r for r in rows(stats.recent_form(finished))}
    assert form["Ash"]["form"] == "TW"
    assert form["Elm"]["form"] == "LL"
    for r in form.values():
        assert r["recent_points"] == 3 * r["recent_wins"] + r["recent_ties"]
        assert 0 <= r["recent_points_pct"] <= 100
        assert set(r["form"]) <= set("WTL")


def test_form_lists_home_before_away(spark, rows):
    games = [("a", 1, "X", "Y", 0, 1), ("b", 2, "Y", "X", 0, 1), ("c", 3, "X", "Y", 2, 2)]
    finished = m.finished(spark.createDataFrame(games, COLUMNS))
    home_first = {r["team"]: r["form"] for r in rows(stats.recent_form(finished))}
    in_time = {
        r["team"]: r["form"] for r in rows(stats.recent_form(finished, order="chronological"))
    }
    assert home_first["X"] == "LTW" and in_time["X"] == "LWT"


def test_form_counts_rounds_not_games(spark, rows):
    games = [(f"g{i}", r, "X", "Y", 1, 0) for i, r in enumerate([1, 2, 7, 7, 7, 8, 8, 9])]
    finished = m.finished(spark.createDataFrame(games, COLUMNS))
    x = next(r for r in rows(stats.recent_form(finished, 3)) if r["team"] == "X")
    assert x["recent_games"] == 6 and x["form"] == "WWWWW"


def test_round_goals(finished, rows):
    table = {r["round"]: r for r in rows(stats.round_goals(finished))}
    assert table[1]["total_goals"] == 5 and table[1]["avg_goals"] == 2.5
    assert table[2]["games"] == 2 and table[2]["games_with_goals"] == 2


def test_round_goals_leave_out_null_rounds(spark):
    games = [("a", None, "X", "Y", 0, 0), ("b", 1, "X", "Y", 0, 0)]
    table = stats.round_goals(m.finished(spark.createDataFrame(games, COLUMNS))).collect()
    assert [(r.round, r.games_with_goals) for r in table] == [(1, 0)]


def test_half_even_equals_array_rounding(spark):
    values = [x / 8 for x in range(-40, 41)] + [x / 3 for x in range(200)] + [2.675, 0.35, 1e9 / 7]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2):
        got = [r[0] for r in df.select(numbers.half_even(F.col("v"), digits)).collect()]
        assert got == [float(np.round(v, digits)) for v in values]


def test_half_up_goes_away_from_zero(spark):
    df = spark.createDataFrame([(2.125,), (-2.125,), (66.65,)], "v double")
    got = [r[0] for r in df.select(numbers.half_up(F.col("v"), 1)).collect()]
    assert got == [2.1, -2.1, 66.7]
    assert df.select(numbers.half_up(F.col("v"), 2)).first()[0] == 2.13


@pytest.mark.parametrize(
    "points, games, expected",
    [(0, 0, 0.4), (9, None, 0.4), (30, 10, 0.95), (0, 10, 0.05), (15, 10, 0.5), (None, 4, 0.05)],
)
def test_strength(spark, points, games, expected):
    df = spark.createDataFrame([(points, games)], "p int, g int")
    assert df.select(scoring.strength(F.col("p"), F.col("g"))).first()[0] == pytest.approx(expected)


def test_odds_add_up(spark):
    df = spark.createDataFrame([(0.95, 0.05)], "h double, a double")
    home, tie, away = df.select(*scoring.odds(F.col("h"), F.col("a"))).first()
    assert home + tie + away == pytest.approx(1) and home > tie > away > 0


def test_home_win_share_is_null_without_games(finished, standings, rows):
    table = {r["team"]: r for r in rows(q.home_away(stats.team_stats(finished, standings)))}
    assert table["Oak"]["away_win_pct"] is None and table["Oak"]["home_win_pct"] == 100.0


def test_unbeaten_needs_three(spark):
    games = [(f"g{i}", i, "X", "Y", 1, s) for i, s in enumerate([0, 0, 2, 1, 1, 0])]
    finished = m.finished(spark.createDataFrame(games, COLUMNS))
    found = [tuple(r) for r in q.unbeaten(finished).collect()]
    assert found == [("X", 4, "WTTW"), ("Y", 3, "WTT")]
    assert [r.team for r in q.unbeaten(finished, at_least=4).collect()] == ["X"]


def test_head_to_head_both_ways(finished):
    pair = q.head_to_head(finished.withColumn("venue", F.lit("v")), "Elm", "Oak").collect()
    assert [(r.home, r.away) for r in pair] == [("Oak", "Elm")]
