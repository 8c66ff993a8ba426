"""The analytic queries over the loaded tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from standwise.functions.numbers import half_up, ratio
from standwise.operators.matches import sides
from standwise.operators.ranking import top


def standings_table(standings: DataFrame) -> DataFrame:
    """Full standings by position, points share to one decimal."""
    return standings.select(
        "position",
        "team",
        "points",
        "games",
        "wins",
        "ties",
        "losses",
        "goals_for",
        "goals_against",
        "goal_diff",
        half_up(F.col("points_pct"), 1).alias("points_pct"),
    ).orderBy("position", "team")


def top_scorers(scorers: DataFrame, n: int = 10) -> DataFrame:
    best = top(scorers, [F.desc("goals"), F.asc("player"), F.asc("club")], n)
    return best.select("player", "club", "goals")


def attack_defence(team_stats: DataFrame) -> DataFrame:
    """Goals scored and conceded per team, best attack first."""
    return team_stats.select(
        "team",
        "total_games",
        "total_goals_for",
        half_up(F.col("avg_goals_for"), 2).alias("avg_goals_for"),
        "total_goals_against",
        half_up(F.col("avg_goals_against"), 2).alias("avg_goals_against"),
        "goal_diff_calc",
        half_up(F.col("score"), 1).alias("score"),
    ).orderBy(F.desc_nulls_first("avg_goals_for"), "team")


def home_away(team_stats: DataFrame) -> DataFrame:
    """Share of wins at home and away, null without games."""
    home_wins, away_wins = F.col("home_wins"), F.col("away_wins")
    return team_stats.select(
        "team",
        "home_games",
        "home_wins",
        half_up(ratio(home_wins, F.col("home_games")), 1).alias("home_win_pct"),
        "away_games",
        "away_wins",
        half_up(ratio(away_wins, F.col("away_games")), 1).alias("away_win_pct"),
        (home_wins - away_wins).alias("win_diff"),
    ).orderBy(F.desc_nulls_first("home_win_pct"), "team")


def form_table(recent_form: DataFrame, standings: DataFrame) -> DataFrame:
    """Recent form of the teams in the standings, best first."""
    joined = recent_form.join(standings.select("team", "position"), "team")
    return joined.orderBy(F.desc_nulls_first("recent_points_pct"), "team").select(
        "position",
        "team",
        "form",
        "recent_points",
        "recent_wins",
        "recent_ties",
        "recent_losses",
        half_up(F.col("recent_points_pct"), 1).alias("recent_points_pct"),
    )


def top_matches(finished: DataFrame, n: int = 10) -> DataFrame:
    """Matches with most goals, later rounds first among equals."""
    order = [F.desc("total_goals"), F.desc("round"), F.asc("match_id")]
    return top(finished, order, n).select(
        "round", "home", "home_goals", "away_goals", "away", "total_goals", "venue"
    )


def round_trend(round_goals: DataFrame) -> DataFrame:
    return round_goals.select(
        "round", "games", "total_goals", half_up(F.col("avg_goals"), 2).alias("avg_goals")
    ).orderBy("round")


def unbeaten(finished: DataFrame, games: int = 5, at_least: int = 3) -> DataFrame:
    """Teams with enough wins or ties among their last games, oldest outcome first."""
    latest = Window.partitionBy("team").orderBy(F.desc("round"), F.desc("match_id"))
    return (
        sides(finished)
        .withColumn("rn", F.row_number().over(latest))
        .filter((F.col("rn") <= games) & F.col("result").isin("W", "T"))
        .groupBy("team")
        .agg(
            F.count("*").alias("unbeaten_games"),
            F.expr("listagg(result, '') within group (order by rn desc)").alias("sequence"),
        )
        .filter(F.col("unbeaten_games") >= at_least)
        .orderBy(F.desc("unbeaten_games"), "team")
    )


def head_to_head(finished: DataFrame, one: str, other: str) -> DataFrame:
    """Matches between two teams, at either ground."""
    home, away = F.col("home"), F.col("away")
    pair = ((home == one) & (away == other)) | ((home == other) & (away == one))
    return (
        finished.filter(pair)
        .orderBy("round", "match_id")
        .select(
            "round", "home", "home_goals", "away_goals", "away", "venue", "home_result"
        )
    )


def performance(
    team_stats: DataFrame, standings: DataFrame, recent_form: DataFrame
) -> DataFrame:
    """Score ranking of the teams that have statistics, a position and recent form."""
    place = standings.select("team", "position", "points")
    joined = (
        team_stats.drop("position", "points")
        .join(place, "team")
        .join(recent_form.select("team", "form"), "team")
    )
    return joined.orderBy(F.desc_nulls_first(F.col("score")), "team").select(
        "position",
        "team",
        "points",
        half_up(F.col("score"), 1).alias("score"),
        half_up(F.col("points_pct_calc"), 1).alias("points_pct"),
        "total_goals_for",
        "goal_diff_calc",
        "form",
    )


def team_list(standings: DataFrame) -> DataFrame:
    return standings.orderBy("position", "team").select("team")


def first_teams(table: DataFrame, n: int = 5) -> DataFrame:
    return table.select("team").orderBy("team").limit(n)


def home_teams(matches: DataFrame) -> DataFrame:
    return matches.select("home").distinct().orderBy("home")


def scores_by_round(finished: DataFrame) -> DataFrame:
    return finished.orderBy("round", "match_id").select(
        "home", "home_goals", "away_goals", "away", "round"
    )
