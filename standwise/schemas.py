"""Table schemas, keys and load modes."""

from pyspark.sql import types as T

INT, LONG, STR, DBL, DATE, TS = (
    T.IntegerType(),
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def text_schema(schema: T.StructType) -> T.StructType:
    """The raw (all text) form of a schema."""
    return T.StructType([T.StructField(f.name, STR) for f in schema.fields])


STANDINGS = struct(
    position=INT,
    team=STR,
    points=INT,
    games=INT,
    wins=INT,
    ties=INT,
    losses=INT,
    goals_for=INT,
    goals_against=INT,
    goal_diff=INT,
    yellow=INT,
    red=INT,
    points_pct=DBL,
)

MATCHES = struct(
    match_id=STR,
    round=INT,
    match_date=DATE,
    kickoff=STR,
    home=STR,
    away=STR,
    home_goals=INT,
    away_goals=INT,
    venue=STR,
    city=STR,
    state=STR,
)

FINISHED = T.StructType(
    MATCHES.fields + struct(total_goals=INT, home_result=STR, away_result=STR).fields
)

SCORERS = struct(position=INT, player=STR, goals=INT, club=STR)

TEAM_STATS = struct(
    team=STR,
    position=INT,
    points=INT,
    points_pct=DBL,
    score=DBL,
    total_games=LONG,
    total_wins=LONG,
    total_ties=LONG,
    total_losses=LONG,
    total_goals_for=LONG,
    total_goals_against=LONG,
    goal_diff_calc=LONG,
    avg_goals_for=DBL,
    avg_goals_against=DBL,
    points_pct_calc=DBL,
    home_games=LONG,
    home_wins=LONG,
    home_ties=LONG,
    home_losses=LONG,
    home_goals_for=LONG,
    home_goals_against=LONG,
    away_games=LONG,
    away_wins=LONG,
    away_ties=LONG,
    away_losses=LONG,
    away_goals_for=LONG,
    away_goals_against=LONG,
)

# Counts of a team within one round.
ROUND_TOTALS = struct(
    round=INT,
    team=STR,
    **{
        f"{part}_{count}": LONG
        for part in ("total", "home", "away")
        for count in ("games", "wins", "ties", "losses", "goals_for", "goals_against")
    },
)

RECENT_FORM = struct(
    team=STR,
    recent_games=LONG,
    recent_wins=LONG,
    recent_ties=LONG,
    recent_losses=LONG,
    recent_points=LONG,
    form=STR,
    recent_points_pct=DBL,
)

ROUND_GOALS = struct(
    round=INT, games=LONG, total_goals=LONG, avg_goals=DBL, games_with_goals=LONG
)

PROBABILITIES = struct(
    team=STR,
    position=INT,
    points=INT,
    p_top4=DBL,
    p_top6=DBL,
    p_mid=DBL,
    p_drop=DBL,
)

DOC_ROWS = T.StructType(
    [
        T.StructField("doc_id", LONG),
        T.StructField("seq", LONG),
        T.StructField("cells", T.ArrayType(STR)),
    ]
)

# Target tables of the load step: (schema, key columns, load mode).
TARGETS = {
    "standings": (STANDINGS, ["team"], "upsert"),
    "matches": (MATCHES, ["match_id"], "replace"),
    "finished": (FINISHED, ["match_id"], "replace"),
    "team_stats": (TEAM_STATS, ["team"], "upsert"),
    "recent_form": (RECENT_FORM, ["team"], "upsert"),
    "scorers": (SCORERS, ["player", "club"], "upsert"),
    "round_goals": (ROUND_GOALS, ["round"], "upsert"),
}

# Tables that carry the time of their last load.
STAMPED = {"standings", "team_stats", "recent_form", "scorers", "round_goals"}

# Decimal storage (precision, scale) of rounded measures.
DECIMALS = {
    "points_pct": (5, 2),
    "score": (6, 2),
    "avg_goals_for": (5, 2),
    "avg_goals_against": (5, 2),
    "points_pct_calc": (5, 2),
    "recent_points_pct": (5, 2),
    "avg_goals": (5, 2),
}

# Longest text a column may hold.
TEXT_LIMITS = {
    "team": 100,
    "match_id": 30,
    "kickoff": 10,
    "home": 100,
    "away": 100,
    "venue": 100,
    "city": 100,
    "state": 2,
    "home_result": 1,
    "away_result": 1,
    "form": 10,
    "player": 100,
    "club": 100,
}
