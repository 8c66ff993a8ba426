"""Typing, deduplication and naming of matches, standings and scorers."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standwise.functions.numbers import (
    day_first_date,
    number,
    rounded_down,
    whole_from_number,
    whole_from_text,
)
from standwise.functions.scoring import outcome
from standwise.operators.keyed import keep_first
from standwise.operators.ranking import global_rank
from standwise.schemas import MATCHES, STANDINGS


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring the columns the schema names to its types, bad values to null."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def typed(name: str) -> Column:
        if name not in schema.names:
            return F.col(name)
        kind, source = schema[name].dataType, F.col(name)
        if isinstance(have[name], (T.FloatType, T.DoubleType)):
            source = F.nanvl(source, F.lit(None).cast("double"))
        if isinstance(kind, T.IntegerType):
            from_text = isinstance(have[name], T.StringType)
            value = whole_from_text(source) if from_text else whole_from_number(source)
        elif isinstance(kind, T.DoubleType):
            value = number(source)
        else:
            value = source.cast(kind)
        return value.alias(name)

    return df.select(*[typed(c) for c in df.columns])


def alias_names(df: DataFrame, aliases: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the names in ``columns`` by their alias; names without one stay."""
    names = aliases.groupBy("raw_name").agg(F.max("name").alias("name"))
    for column in columns:
        lookup = names.select(
            F.col("raw_name").alias("_raw"), F.col("name").alias("_alias")
        )
        df = (
            df.join(lookup, df[column] == F.col("_raw"), "left")
            .withColumn(column, F.coalesce("_alias", column))
            .drop("_raw", "_alias")
        )
    return df


def typed_matches(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """All-text matches in their types and with canonical names."""
    typed = texts.withColumns(
        {
            "round": rounded_down(F.col("round")),
            "match_date": day_first_date(F.col("match_date")),
            "home_goals": rounded_down(F.col("home_goals")),
            "away_goals": rounded_down(F.col("away_goals")),
        }
    )
    return alias_names(typed, aliases, ["home", "away"]).select(*MATCHES.names)


def clean_matches(raw: DataFrame, aliases: DataFrame, order: Sequence[str]) -> DataFrame:
    """One typed row per match id, the first by ``order``, with canonical names."""
    return typed_matches(keep_first(raw, ["match_id"], order), aliases)


def finished(matches: DataFrame) -> DataFrame:
    """Matches with both scores, their goal total and the outcome for each side."""
    home, away = F.col("home_goals"), F.col("away_goals")
    return matches.filter(home.isNotNull() & away.isNotNull()).withColumns(
        {
            "total_goals": home + away,
            "home_result": outcome(home, away),
            "away_result": outcome(away, home),
        }
    )


def pending(matches: DataFrame) -> DataFrame:
    """Fixtures that lack a score."""
    unplayed = F.col("home_goals").isNull() | F.col("away_goals").isNull()
    return matches.filter(unplayed).select("match_id", "home", "away")


def sides(finished: DataFrame) -> DataFrame:
    """Two rows per match, one for each team, from a single pass over the matches."""
    both = F.explode(
        F.array(
            F.struct(
                F.col("home").alias("team"),
                F.lit(False).alias("is_away"),
                F.col("home_goals").alias("goals_for"),
                F.col("away_goals").alias("goals_against"),
                F.col("home_result").alias("result"),
            ),
            F.struct(
                F.col("away").alias("team"),
                F.lit(True).alias("is_away"),
                F.col("away_goals").alias("goals_for"),
                F.col("home_goals").alias("goals_against"),
                F.col("away_result").alias("result"),
            ),
        )
    )
    return finished.select("match_id", "round", both.alias("side")).select(
        "match_id", "round", "side.*"
    )


def teams(matches: DataFrame) -> DataFrame:
    """Names that appear as home or away team."""
    names = matches.select(F.explode(F.array("home", "away")).alias("team"))
    return names.filter(F.col("team").isNotNull()).distinct()


def clean_standings(raw: DataFrame) -> DataFrame:
    """Typed standings without rows that lack a position or a team."""
    numeric = [f for f in STANDINGS.fields if f.name != "team"]
    values = {
        f.name: (
            rounded_down(F.col(f.name))
            if isinstance(f.dataType, T.IntegerType)
            else number(F.col(f.name))
        )
        for f in numeric
        if f.name in raw.columns
    }
    return raw.withColumns(values).dropna(subset=["position", "team"])


def one_per_team(standings: DataFrame) -> DataFrame:
    """The best placed row of each team."""
    rest = [c for c in standings.columns if c not in ("position", "team")]
    return keep_first(standings, ["team"], ["position", *rest])


def clean_scorers(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Typed scorers, ranked by goals, then player, club and the ``order`` columns."""
    typed = raw.withColumn("goals", rounded_down(F.col("goals"))).dropna(
        subset=["goals", "player"]
    )
    ranking = [F.desc("goals"), F.asc("player"), F.asc("club"), *[F.asc(c) for c in order]]
    ranked = global_rank(typed.drop("position"), ranking, "position")
    # The rank is counted as a long; the table of scorers holds it as an integer.
    return ranked.select(F.col("position").cast("int"), "player", "goals", "club")


def audit(matches: DataFrame, finished: DataFrame) -> DataFrame:
    """One row of counts: matches, finished matches, rounds, scores known."""
    known = F.count("home_goals").alias("with_score")
    totals = matches.agg(
        F.count("*").alias("matches"), F.count_distinct("round").alias("rounds"), known
    )
    return totals.select(
        "matches",
        finished.agg(F.count("*")).scalar().alias("finished"),
        "rounds",
        "with_score",
    )
