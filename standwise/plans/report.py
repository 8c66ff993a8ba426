"""Report tables: what the tabs of the report show, as DataFrames."""

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from standwise.functions.numbers import half_up, ratio
from standwise.functions.scoring import signed, zone
from standwise.functions.text import last_word, place
from standwise.operators.ranking import rank_teams, ranked_top, top
from standwise.schemas import PROBABILITIES
from standwise.sources.files import has_version, read_version

# Slices of the table shown per probability, and the trend and band limits.
SLICES = {"p_top4": (1, 4), "p_top6": (1, 6), "p_mid": (7, 15), "p_drop": (16, 20)}
TREND_LIMIT, HIGH_SHARE, LOW_SHARE = 2.0, 60.0, 40.0


def upper_names(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in columns})


def report_time(at: Column) -> Column:
    """Time of the report in the fixed zone three hours behind UTC."""
    return F.date_format(F.from_utc_timestamp(at, "-03:00"), "dd/MM/yyyy HH:mm")


def latest_first() -> list[Column]:
    return [F.desc_nulls_first(F.col("round")), F.asc("match_id")]


def by_place() -> list[Column]:
    return [F.asc_nulls_last("position"), F.asc("team")]


def kpis(finished: DataFrame, standings: DataFrame, limit: int | None = None) -> DataFrame:
    """One row: latest round, games, goals, leader and goals per game.

    ``limit`` counts only that many of the latest matches.
    """
    matches = finished if limit is None else top(finished, latest_first(), limit)
    leader = standings.agg(
        F.min_by(F.struct("team", "points"), F.struct("position", "team")).alias("leader")
    )
    totals = matches.agg(
        F.max("round").alias("latest_round"),
        F.count("*").alias("games"),
        F.coalesce(F.sum("total_goals"), F.lit(0)).alias("total_goals"),
    )
    return totals.select(
        "latest_round",
        "games",
        "total_goals",
        F.upper(leader.select("leader.team").scalar()).alias("leader"),
        leader.select("leader.points").scalar().alias("leader_points"),
        half_up(F.try_divide("total_goals", "games"), 1).alias("goals_per_game"),
    )


def standings_report(standings: DataFrame, recent_form: DataFrame) -> DataFrame:
    """Standings with rank, zone, signed goal difference and the form string."""
    forms = recent_form.groupBy(F.upper("team").alias("team")).agg(
        F.max_by("form", "team").alias("form")
    )
    ranked = rank_teams(upper_names(standings, "team"), by_place(), "rank")
    return ranked.join(forms, "team", "left").select(
        "rank",
        "team",
        zone(F.col("rank")).alias("zone"),
        "points",
        "games",
        "wins",
        "ties",
        "losses",
        "goals_for",
        "goals_against",
        signed(F.col("goal_diff")).alias("goal_diff"),
        F.coalesce("points_pct", F.lit(0.0)).alias("points_pct"),
        F.coalesce(F.right("form", F.lit(5)), F.lit("")).alias("form"),
    )


def probabilities_report(probabilities: DataFrame) -> DataFrame:
    """Probabilities with the zone of the position, or of the rank where there is none."""
    ranked = rank_teams(upper_names(probabilities, "team"), by_place(), "rank")
    known = F.when(F.col("position") != 0, F.col("position"))
    return ranked.withColumn("place", F.coalesce(known, F.col("rank"))).select(
        "place",
        "team",
        zone(F.col("place")).alias("zone"),
        "points",
        "p_top4",
        "p_top6",
        "p_mid",
        "p_drop",
    )


def probability_slices(probabilities: DataFrame) -> DataFrame:
    """Teams of each slice of the table with the probability shown for it."""
    last = max(high for _, high in SLICES.values())
    ranked = ranked_top(upper_names(probabilities, "team"), by_place(), last, "rank")
    slices = [
        F.when(
            F.col("rank").between(low, high),
            F.struct(F.lit(name).alias("slice"), F.col(name).alias("percent")),
        )
        for name, (low, high) in SLICES.items()
    ]
    shown = F.filter(F.array(*slices), lambda s: s.isNotNull())
    return ranked.select("rank", "team", F.explode(shown).alias("s")).select(
        "s.slice", "rank", "team", "s.percent"
    )


def attack_defence_chart(team_stats: DataFrame, n: int = 10) -> DataFrame:
    first = top(upper_names(team_stats, "team"), by_place(), n)
    return first.select("team", "total_goals_for", "total_goals_against")


def home_away_chart(team_stats: DataFrame, n: int = 10) -> DataFrame:
    """Share of home and away wins of the first teams; 0 without games."""

    def share(wins: str, games: str) -> Column:
        return F.coalesce(half_up(ratio(F.col(wins), F.col(games)), 1), F.lit(0.0))

    first = top(upper_names(team_stats, "team"), by_place(), n)
    return first.select(
        "team",
        share("home_wins", "home_games").alias("home_win_pct"),
        share("away_wins", "away_games").alias("away_win_pct"),
    )


def score_chart(team_stats: DataFrame, n: int = 15) -> DataFrame:
    order = [F.desc("score"), *by_place()]
    return ranked_top(upper_names(team_stats, "team"), order, n, "rank").select(
        "rank", "team", "score"
    )


def scorers_report(scorers: DataFrame, listed: int = 10, labelled: int = 8) -> DataFrame:
    """Best scorers with their rank; medals for three, a chart label for the first ones."""
    order = [F.desc("goals"), F.asc("player"), F.asc("club")]
    ranked = ranked_top(upper_names(scorers, "club"), order, listed, "rank")
    return ranked.select(
        "rank",
        (F.col("rank") <= 3).alias("medal"),
        "player",
        "club",
        "goals",
        F.when(F.col("rank") <= labelled, last_word(F.col("player"))).alias("label"),
    )


def outcome_label(result: Column) -> Column:
    code = F.upper(F.trim(result))
    return (
        F.when(code == "W", "win").when(code == "T", "tie").when(code == "L", "loss").otherwise("")
    )


def latest_matches(finished: DataFrame, n: int = 15) -> DataFrame:
    """Latest matches with place, score text and the outcome for each side."""
    shown = top(upper_names(finished, "home", "away"), latest_first(), n)
    return shown.select(
        "round",
        "home",
        F.concat_ws(" x ", "home_goals", "away_goals").alias("score"),
        "away",
        outcome_label(F.col("home_result")).alias("home_label"),
        outcome_label(F.col("away_result")).alias("away_label"),
        "venue",
        place(F.col("city"), F.col("state")).alias("place"),
        "kickoff",
    )


def round_trend_chart(round_goals: DataFrame) -> DataFrame:
    return round_goals.orderBy("round").select(
        F.concat_ws(" ", F.lit("Rd"), "round").alias("label"), "avg_goals"
    )


def _form_shares(recent_form: DataFrame, standings: DataFrame) -> DataFrame:
    overall = (
        standings.groupBy(F.upper("team").alias("team"))
        .agg(F.max_by("points_pct", F.struct("position", "team")).alias("overall"))
    )
    games = F.coalesce("recent_games", F.lit(0))
    points = F.coalesce("recent_points", F.lit(0))
    return (
        upper_names(recent_form, "team")
        .join(overall, "team", "left")
        .withColumns(
            {
                "share": F.when(games > 0, points / (games * 3) * 100).otherwise(F.lit(0.0)),
                "overall": F.coalesce("overall", F.lit(0.0)),
                "per_game": points / F.greatest(games, F.lit(1)),
            }
        )
    )


def best_form_first() -> list[Column]:
    return [F.desc("per_game"), F.asc("team")]


def form_delta(recent_form: DataFrame, standings: DataFrame) -> DataFrame:
    """Recent against overall points share: difference, its trend and a band."""
    ranked = rank_teams(_form_shares(recent_form, standings), best_form_first(), "rank")
    share = F.col("share")
    delta = share - F.col("overall")
    trend = F.when(delta > TREND_LIMIT, "up").when(delta < -TREND_LIMIT, "down").otherwise("flat")
    band = F.when(share >= HIGH_SHARE, "high").when(share >= LOW_SHARE, "middle").otherwise("low")
    return ranked.select(
        "rank",
        "team",
        "recent_games",
        "recent_wins",
        "recent_ties",
        "recent_losses",
        "recent_points",
        half_up(share, 1).alias("recent_pct"),
        half_up(F.col("overall"), 1).alias("overall_pct"),
        half_up(delta, 1).alias("delta"),
        F.concat(signed(half_up(delta, 1)), F.lit("%")).alias("delta_text"),
        trend.alias("trend"),
        band.alias("band"),
    )


def form_chart(recent_form: DataFrame, standings: DataFrame, n: int = 15) -> DataFrame:
    shares = _form_shares(recent_form, standings)
    return ranked_top(shares, best_form_first(), n, "rank").select(
        "rank",
        "team",
        half_up(F.col("share"), 1).alias("recent_pct"),
        F.col("overall").alias("overall_pct"),
    )


def cards(standings: DataFrame) -> DataFrame:
    """Teams by yellow cards."""
    counted = upper_names(standings, "team").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("yellow", "red")}
    )
    ranked = rank_teams(counted, [F.desc("yellow"), *by_place()], "rank")
    return ranked.select("rank", "team", "yellow", "red")


def load_probabilities(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], required: bool = False
) -> DataFrame:
    """Stored probabilities, or computed ones when there are none.

    What is stored, or handed on as a result, has to be ``required``: if it cannot be computed,
    the failure is raised. Without that a failure is logged and gives an empty table, for a
    report that is shown without this tab.
    """
    if has_version(spark, path):
        return read_version(spark, path, PROBABILITIES)
    try:
        return compute()
    except Exception:
        if required:
            raise
        # The report is shown without this tab.
        logging.getLogger(__name__).exception("no probabilities under %s, and none computed", path)
        return spark.createDataFrame([], PROBABILITIES)


def report_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All report tables out of the model tables."""
    standings, form = tables["standings"], tables["recent_form"]
    stats, finished = tables["team_stats"], tables["finished"]
    return {
        "kpis": kpis(finished, standings),
        "standings": standings_report(standings, form),
        "probabilities": probabilities_report(tables["probabilities"]),
        "probability_slices": probability_slices(tables["probabilities"]),
        "attack_defence": attack_defence_chart(stats),
        "home_away": home_away_chart(stats),
        "score": score_chart(stats),
        "scorers": scorers_report(tables["scorers"]),
        "latest_matches": latest_matches(finished),
        "round_trend": round_trend_chart(tables["round_goals"]),
        "form_delta": form_delta(form, standings),
        "form_chart": form_chart(form, standings),
        "cards": cards(standings),
    }
