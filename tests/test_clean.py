"""Cleaning of standings, matches and scorers on small frames."""

import datetime

import pytest

from standwise.operators import matches as m

ALIASES = [("North FC", "North"), ("South SC", "South United"), ("East EC", "East")]


@pytest.fixture
def aliases(spark):
    return spark.createDataFrame(ALIASES, "raw_name string, name string")


@pytest.fixture
def raw_standings(spark):
    names = "position team points games wins ties losses goals_for goals_against goal_diff points_pct"
    data = [
        ("2", "East", "18", "10", "5", "3", "2", "15", "9", "6", "60.0"),
        ("1", "North", "20", "10", "6", "2", "2", "18", "8", "10", "66.7"),
        (None, None, "15", "10", "4", "3", "3", "12", "10", "2", "50.0"),
        ("3", "West", "x", "10", "3", "3", "4", "10", "12", "-2", "40.0"),
        ("4", None, "1", "1", "1", "1", "1", "1", "1", "1", "1"),
    ]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in names.split()))


@pytest.fixture
def raw_matches(spark):
    columns = "match_id round match_date kickoff home away home_goals away_goals venue city state"
    data = [
        ("g1", "1", "10/05/2026", "16:00", "North FC", "East EC", "2", "1", "v", "c", "s", 1),
        ("g2", "1", "31/02/2026", None, "South SC", "Far XY", "1.0", "1", "v", "c", "s", 2),
        ("g3", "2", "17/05/2026", None, "East EC", "North FC", None, None, "v", "c", "s", 3),
        ("g1", "9", "11/05/2026", None, "West", "West", "0", "0", "v", "c", "s", 4),
        ("g4", "2", "bad", None, "Far XY", "South SC", "0", "3", "v", "c", "s", 5),
        ("g5", "2", "18/05/2026", None, "Far XY", "South SC", "1", None, "v", "c", "s", 6),
    ]
    schema = ", ".join(f"{c} string" for c in columns.split()) + ", at int"
    return spark.createDataFrame(data, schema)


@pytest.fixture
def matches(raw_matches, aliases):
    return m.clean_matches(raw_matches, aliases, ["at"])


def by(df, key, value):
    return next(r.asDict() for r in df.collect() if r[key] == value)


def test_alias_known_and_unknown(spark, aliases):
    df = spark.createDataFrame([("North FC",), ("Nowhere",), (None,)], "home string")
    named = [r.home for r in m.alias_names(df, aliases, ["home"]).collect()]
    assert sorted(named, key=str) == sorted(["North", "Nowhere", None], key=str)


def test_repeated_alias_adds_no_rows(spark):
    twice = spark.createDataFrame([("a", "b"), ("a", "b")], "raw_name string, name string")
    df = spark.createDataFrame([("a",)], "home string")
    assert [r.home for r in m.alias_names(df, twice, ["home"]).collect()] == ["b"]


def test_standings_drop_rows_without_position_or_team(raw_standings):
    cleaned = m.clean_standings(raw_standings)
    assert {r.team for r in cleaned.collect()} == {"North", "East", "West"}


def test_standings_are_typed(raw_standings):
    cleaned = m.clean_standings(raw_standings)
    kinds = dict(cleaned.dtypes)
    assert kinds["points"] == "int" and kinds["points_pct"] == "double"
    assert by(cleaned, "team", "North")["points_pct"] == 66.7
    assert by(cleaned, "team", "West")["points"] is None
    assert by(cleaned, "team", "West")["goal_diff"] == -2


def test_one_row_per_team(spark):
    twice = spark.createDataFrame([(4, "a"), (2, "a"), (3, "b")], "position int, team string")
    assert sorted(tuple(r) for r in m.one_per_team(twice).collect()) == [(2, "a"), (3, "b")]


def test_first_copy_of_a_match_stays(matches):
    assert matches.count() == 5
    assert by(matches, "match_id", "g1")["round"] == 1


def test_names_are_mapped_on_both_sides(matches):
    one, two = by(matches, "match_id", "g1"), by(matches, "match_id", "g2")
    assert (one["home"], one["away"]) == ("North", "East")
    assert (two["home"], two["away"]) == ("South United", "Far XY")


def test_dates(matches):
    assert by(matches, "match_id", "g1")["match_date"] == datetime.date(2026, 5, 10)
    assert by(matches, "match_id", "g2")["match_date"] is None
    assert by(matches, "match_id", "g4")["match_date"] is None


def test_finished_and_pending_split(matches):
    assert {r.match_id for r in m.finished(matches).collect()} == {"g1", "g2", "g4"}
    assert {r.match_id for r in m.pending(matches).collect()} == {"g3", "g5"}


@pytest.mark.parametrize(
    "match_id, home, away, total", [("g1", "W", "L", 3), ("g2", "T", "T", 2), ("g4", "L", "W", 3)]
)
def test_outcomes_and_totals(matches, match_id, home, away, total):
    row = by(m.finished(matches), "match_id", match_id)
    assert (row["home_result"], row["away_result"], row["total_goals"]) == (home, away, total)


def test_sides_conserve_goals(matches):
    finished = m.finished(matches)
    sides = m.sides(finished).collect()
    assert len(sides) == 2 * finished.count()
    assert sum(r.goals_for for r in sides) == sum(r.goals_against for r in sides)


def test_teams_leave_out_null(spark):
    df = spark.createDataFrame([("a", "b"), ("b", None)], "home string, away string")
    assert sorted(r.team for r in m.teams(df).collect()) == ["a", "b"]


def test_scorers_ranked_without_null(spark):
    data = [
        ("A", "5", "X", 1),
        ("B", "10", "Y", 2),
        (None, "7", "Y", 3),
        ("C", "none", "Z", 4),
        ("D", "5", "Z", 5),
        ("A", "5", "X", 6),
    ]
    raw = spark.createDataFrame(data, "player string, goals string, club string, at int")
    ranked = sorted(tuple(r) for r in m.clean_scorers(raw, ["at"]).collect())
    assert ranked == [(1, "B", 10, "Y"), (2, "A", 5, "X"), (3, "A", 5, "X"), (4, "D", 5, "Z")]


def test_audit_row(matches):
    row = m.audit(matches, m.finished(matches)).first().asDict()
    assert row == {"matches": 5, "finished": 3, "rounds": 2, "with_score": 4}
