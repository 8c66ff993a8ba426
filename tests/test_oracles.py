"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from catalog.registry import PLANS
from oracle.check import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(PLANS) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query(spark, con, key):
    assert compare(QUERIES[key](spark, FOLDER), con, ORACLES[key]) is None


# What the rows of sorted queries are sorted by; the SQL of the others in SORTED ends so.
ORDERS = {
    "q03_attack_defence": "avg_goals_for desc nulls first, team",
    "q04_home_away": "home_win_pct desc nulls first, team",
    "q05_recent_form": "recent_points_pct desc nulls first, team",
    "q07_round_trend": "round",
    "q08_unbeaten": "unbeaten_games desc, team",
    "adhoc_distinct_home": "home",
    "report_round_trend": "substr(label, 4)::int",
    "report_score_top15": "rank",
}
SORTED = [
    "q01_standings",
    "q02_top_scorers",
    "q06_top_matches",
    "adhoc_teams",
    "adhoc_limit",
    "report_attack_defence",
    "report_home_away_pct",
    "report_latest_matches",
]


@pytest.mark.parametrize("key", [*ORDERS, *SORTED])
def test_order(spark, con, key):
    sql = ORACLES[key]
    if key in ORDERS:
        sql = f"select * from ({sql}) order by {ORDERS[key]}"
    assert compare(QUERIES[key](spark, FOLDER), con, sql, ordered=True) is None


def test_head_to_head_is_sorted_by_round(spark):
    rounds = [r["round"] for r in QUERIES["q09_head_to_head"](spark, FOLDER).collect()]
    assert rounds == sorted(rounds)


def test_performance_is_sorted_by_score(spark):
    scores = [r.score for r in QUERIES["q10_performance"](spark, FOLDER).collect()]
    assert scores == sorted(scores, reverse=True)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
