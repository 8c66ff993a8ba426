"""Match outcomes and composite team metrics as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from standwise.functions.numbers import half_even

# Fixed values of the composite score: weights of points share, goal difference and attack,
# and the scaling of the two per-game measures.
SCORE_WEIGHTS = {"points_pct": 0.5, "goal_diff": 0.3, "goals_for": 0.2}
DIFF_SCALE, DIFF_OFFSET, ATTACK_SCALE = 5.0, 50.0, 10.0

# Fixed values of the strength model.
STRENGTH_FLOOR, STRENGTH_CEILING, STRENGTH_UNKNOWN, TIE_SHARE = 0.05, 0.95, 0.4, 0.3


def outcome(own: Column, other: Column) -> Column:
    """'W', 'T' or 'L' from the view of the side that scored ``own`` goals."""
    return F.when(own > other, "W").when(own == other, "T").otherwise("L")


def points(wins: Column, ties: Column) -> Column:
    return wins * 3 + ties


def points_pct(wins: Column, ties: Column, games: Column) -> Column:
    """Share of the possible points in percent, one decimal, 0 without games."""
    share = points(wins, ties) / (games * 3) * 100
    return F.when(games > 0, half_even(share, 1)).otherwise(F.lit(0.0))


def performance_score(
    points_pct: Column,
    goal_diff: Column,
    goals_for: Column,
    games: Column,
    weights: dict = SCORE_WEIGHTS,
) -> Column:
    """Weighted blend of points share, goal difference and attack, within 0..100.

    Missing inputs count as 0 and missing or zero games as 1, before the clamp, so a
    team without a points share never reaches the upper end by accident.
    """
    share = F.coalesce(points_pct.cast("double"), F.lit(0.0))
    diff = F.coalesce(goal_diff.cast("double"), F.lit(0.0))
    goals = F.coalesce(goals_for.cast("double"), F.lit(0.0))
    played = F.greatest(F.coalesce(games.cast("double"), F.lit(1.0)), F.lit(1.0))
    blend = (
        share * weights["points_pct"]
        + (diff / played * DIFF_SCALE + DIFF_OFFSET) * weights["goal_diff"]
        + (goals / played * ATTACK_SCALE) * weights["goals_for"]
    )
    return half_even(F.greatest(F.lit(0.0), F.least(F.lit(100.0), blend)), 2)


def strength(points: Column, games: Column) -> Column:
    """Share of possible points, kept within fixed bounds."""
    played = F.coalesce(games, F.lit(0))
    share = F.coalesce(points, F.lit(0)) / F.when(played != 0, played * 3)
    clamped = F.least(F.greatest(share, F.lit(STRENGTH_FLOOR)), F.lit(STRENGTH_CEILING))
    return F.when(played == 0, F.lit(STRENGTH_UNKNOWN)).otherwise(clamped)


def odds(home: Column, away: Column) -> tuple[Column, Column, Column]:
    """Chances of a home win, a tie and an away win from two strengths."""
    total = home + away + F.lit(TIE_SHARE)
    p_home = home / total
    p_away = away / total
    return p_home, F.lit(1.0) - p_home - p_away, p_away


def zone(position: Column) -> Column:
    """Band of the table a position belongs to."""
    return F.when(position <= 6, "top").when(position >= 16, "drop").otherwise("mid")


def signed(value: Column) -> Column:
    """Number as text, with a plus sign when positive."""
    return F.concat(F.when(value > 0, "+").otherwise(""), value.cast("string"))
