"""Team statistics, recent form and goals per round."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from standwise.functions.numbers import half_even
from standwise.functions.scoring import performance_score, points, points_pct
from standwise.operators.matches import one_per_team, sides
from standwise.schemas import ROUND_TOTALS, TEAM_STATS


def _side_aggregates(prefix: str, part: Column) -> list[Column]:
    def hits(code: str) -> Column:
        return F.count_if(part & (F.col("result") == code))

    def total(goals: str) -> Column:
        return F.coalesce(F.sum(F.when(part, F.col(goals))), F.lit(0)).cast("long")

    return [
        F.count_if(part).alias(f"{prefix}_games"),
        hits("W").alias(f"{prefix}_wins"),
        hits("T").alias(f"{prefix}_ties"),
        hits("L").alias(f"{prefix}_losses"),
        total("goals_for").alias(f"{prefix}_goals_for"),
        total("goals_against").alias(f"{prefix}_goals_against"),
    ]


def team_totals(finished: DataFrame) -> DataFrame:
    """Home, away and total counts per team, in one hash aggregate."""
    played = sides(finished).filter(F.col("team").isNotNull())
    return played.groupBy("team").agg(
        *_side_aggregates("total", F.lit(True)),
        *_side_aggregates("home", ~F.col("is_away")),
        *_side_aggregates("away", F.col("is_away")),
    )


def round_totals(finished: DataFrame) -> DataFrame:
    """The counts of ``team_totals`` for each round and team; no round is a round of its own."""
    played = sides(finished).filter(F.col("team").isNotNull())
    sums = [
        *_side_aggregates("total", F.lit(True)),
        *_side_aggregates("home", ~F.col("is_away")),
        *_side_aggregates("away", F.col("is_away")),
    ]
    return played.groupBy("round", "team").agg(*sums).select(*ROUND_TOTALS.names)


def merged_totals(rounds: DataFrame) -> DataFrame:
    """The counts of ``team_totals`` from those of all rounds."""
    sums = [F.sum(c).alias(c) for c in ROUND_TOTALS.names if c not in ("round", "team")]
    return rounds.groupBy("team").agg(*sums)


def team_stats(finished: DataFrame, standings: DataFrame) -> DataFrame:
    """Totals with averages, points share, place in the standings and score."""
    return measured(team_totals(finished), standings)


def measured(totals: DataFrame, standings: DataFrame) -> DataFrame:
    """Counts per team with what ``team_stats`` adds to them."""
    games = F.col("total_games")
    totals = totals.withColumns(
        {
            "goal_diff_calc": F.col("total_goals_for") - F.col("total_goals_against"),
            "avg_goals_for": half_even(F.col("total_goals_for") / games, 2),
            "avg_goals_against": half_even(F.col("total_goals_against") / games, 2),
            "points_pct_calc": points_pct(F.col("total_wins"), F.col("total_ties"), games),
        }
    )
    place = one_per_team(standings.select("team", "position", "points", "points_pct"))
    score = performance_score(
        F.col("points_pct"), F.col("goal_diff_calc"), F.col("total_goals_for"), games
    )
    return (
        totals.join(place, "team", "left")
        .withColumn("score", score)
        .select(*TEAM_STATS.names)
    )


def last_rounds(finished: DataFrame, n_rounds: int) -> DataFrame:
    """Matches of the last ``n_rounds`` rounds, by round number."""
    latest = finished.agg(F.max("round")).scalar()
    return finished.filter(F.col("round") >= latest - (n_rounds - 1))


def recent_form(
    finished: DataFrame, n_rounds: int = 5, length: int = 5, order: str = "home_first"
) -> DataFrame:
    """Counts over the last rounds and a string of the last ``length`` outcomes per team.

    The string lists a team's home games by round, then its away games by round, and keeps
    the end of that list; ``order="chronological"`` lists all games by round instead.
    """
    games = sides(last_rounds(finished, n_rounds)).filter(F.col("team").isNotNull())
    wins, ties = F.col("recent_wins"), F.col("recent_ties")
    counts = (
        games.groupBy("team")
        .agg(
            F.count("*").alias("recent_games"),
            F.count_if(F.col("result") == "W").alias("recent_wins"),
            F.count_if(F.col("result") == "T").alias("recent_ties"),
            F.count_if(F.col("result") == "L").alias("recent_losses"),
        )
        .withColumns(
            {
                "recent_points": points(wins, ties),
                "recent_points_pct": points_pct(wins, ties, F.col("recent_games")),
            }
        )
    )
    latest_first = [F.desc("round"), F.desc("match_id")]
    if order == "home_first":
        latest_first = [F.desc("is_away"), *latest_first]
    # Spark keeps only the first `length` rows per team of each map task.
    place = F.row_number().over(Window.partitionBy("team").orderBy(*latest_first))
    form = (
        games.select("team", "result", place.alias("place"))
        .filter(F.col("place") <= length)
        .groupBy("team")
        .agg(F.expr("listagg(result, '') within group (order by place desc)").alias("form"))
    )
    return counts.join(form, "team").select(
        "team",
        "recent_games",
        "recent_wins",
        "recent_ties",
        "recent_losses",
        "recent_points",
        "form",
        "recent_points_pct",
    )


def round_goals(finished: DataFrame) -> DataFrame:
    """Games, goals, average and games with goals per round."""
    goals = F.col("total_goals")
    return (
        finished.filter(F.col("round").isNotNull())
        .groupBy("round")
        .agg(
            F.count("match_id").alias("games"),
            F.sum(goals).alias("total_goals"),
            half_even(F.sum(goals) / F.count(goals), 2).alias("avg_goals"),
            F.count_if(goals > 0).alias("games_with_goals"),
        )
    )
