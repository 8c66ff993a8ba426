"""Matches out of document table rows: cells per row, rows in document order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standwise.functions.numbers import strip
from standwise.functions.text import NO_KICKOFF, first_match, game
from standwise.operators.fill import carry_forward
from standwise.sources.staging import stage

# What the cells of a document row hold, in order.
CELLS = ["match_id", "round", "match_date", "kickoff", "game", "venue", "city", "state"]


def named_cells(doc_rows: DataFrame) -> DataFrame:
    """Document rows with their stripped cells as columns; missing cells are ''."""

    def cell(at: int) -> Column:
        return strip(F.coalesce(F.get("cells", F.lit(at)), F.lit("")))

    return doc_rows.select(
        "doc_id", "seq", *[cell(at).alias(name) for at, name in enumerate(CELLS)]
    )


def game_rows(rows: DataFrame) -> DataFrame:
    """Rows with an all-digit id and some game text."""
    digits = F.col("match_id").rlike(r"(?U)^\d+$")
    return rows.filter(digits & ~F.col("game").isin("", "None"))


def fill_round(rows: DataFrame) -> DataFrame:
    """Round of each row, carried on from the last row that named one.

    The rows are read from cells and used twice, so they are written once.
    """
    named = first_match(F.col("round"), r"(?U)(\d+)").try_cast("int")
    rest = [c for c in rows.columns if c != "round"]
    cells = stage(rows.select(*rest, named.alias("named_round")))
    return carry_forward(cells, "doc_id", "seq", F.col("named_round"), "round", rest=rest)


def parse_games(rows: DataFrame) -> DataFrame:
    """Teams and goals out of the game text; rows that are no game are dropped."""
    return (
        rows.withColumn("parsed", game(F.col("game")))
        .filter(F.col("parsed.home").isNotNull())
        .select(*[c for c in rows.columns if c != "game"], "parsed.*")
    )


def matches_from_doc_rows(doc_rows: DataFrame) -> DataFrame:
    """All-text matches of document rows, in the form the cleaning step takes."""
    kickoff = F.when(~F.col("kickoff").isin(*NO_KICKOFF), F.col("kickoff"))
    day = strip(F.get(F.split("match_date", "\n"), F.lit(0)))
    return parse_games(fill_round(game_rows(named_cells(doc_rows)))).select(
        "doc_id",
        "seq",
        "match_id",
        "round",
        day.alias("match_date"),
        kickoff.alias("kickoff"),
        "home",
        "home_goals",
        "away_goals",
        "away",
        "venue",
        "city",
        "state",
    )
