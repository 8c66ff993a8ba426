"""Draws as arrays agree with one hash at a time, and with draws in Spark's own functions."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from standwise.functions import draws
from standwise.operators import season


def sides(text, block, home_below, tie_below):
    digest = hashlib.md5(f"42:{block}".encode() + text).hexdigest()
    found = [int(digest[8 * lane : 8 * lane + 8], 16) for lane in range(4)]
    return [(x < home_below, x >= home_below and x >= tie_below) for x in found]


def test_counts_of_texts_of_any_length(monkeypatch):
    monkeypatch.setattr(draws, "AT_ONCE", 5)
    tails = [b"", b":", ":é1".encode(), b":m2"] + [b":" + b"x" * k for k in (47, 48, 52, 53, 54, 110, 130)]
    home = np.array([0, 2**32, 2**31, 2**31] + [2**30] * 7)
    tie = np.minimum(home + np.array([0, 0, 2**32, 2**29] + [2**30] * 7), 2**32)
    won, lost = draws.counted(tails, home, tie, 47, 42)
    for i, text in enumerate(tails):
        each = [s for b in range(12) for s in sides(text, b, home[i], tie[i])][:47]
        assert (won[i], lost[i]) == (sum(w for w, _ in each), sum(x for _, x in each)), i


def test_what_all_texts_share_is_added_once():
    """Words that are the same in all texts have no place for each text."""
    texts = [b"42:1234:M1000%03d-1" % i for i in range(5)]
    fronts = draws._heads([b"42:1234"], 1)
    ends = draws._padded([x[7:] for x in texts], 7, 1).T
    words = draws._joined(fronts, [end if end.any() else None for end in ends])
    assert words[0].ndim == 0 and words[1].ndim == words[2].ndim == 1 and words[6] is None
    lanes = draws.md5_lanes(words, (5,))
    for i, text in enumerate(texts):
        assert hashlib.md5(text).hexdigest() == "".join(f"{x[i]:08x}" for x in lanes)


def test_sums_of_teams_beyond_a_byte():
    """600 games of one pair, and a team that plays itself."""
    tails = [f":{i}".encode() for i in range(603)]
    home = np.array([0] * 600 + [1, 2, 2])
    away = np.array([1] * 600 + [2, 0, 2])
    below = np.full(603, 2**31), np.full(603, 3 * 2**30)
    points, margins = np.zeros((3, 3, 4), int), np.zeros((3, 3, 4), int)
    for blocks, teams, p, m in draws.team_sums(tails, home, away, *below, 12, 42):
        points[np.ix_(blocks, teams)] += p
        margins[np.ix_(blocks, teams)] += m
    want, more = np.zeros((3, 3, 4), int), np.zeros((3, 3, 4), int)
    for i, text in enumerate(tails):
        for block in range(3):
            for lane, (won, lost) in enumerate(sides(text, block, 2**31, 3 * 2**30)):
                tied = not won and not lost
                want[block, home[i], lane] += 3 * won + tied
                want[block, away[i], lane] += 3 * lost + tied
                more[block, home[i], lane] += int(won) - lost
                more[block, away[i], lane] += int(lost) - won
    assert (points == want).all() and (margins == more).all()


def odds_of(spark, n):
    pick = lambda k: F.concat(F.lit("t"), (F.col("id") % k).cast("string"))
    return spark.range(n).select(
        F.when(F.col("id") != 5, F.concat(F.lit("m"), F.col("id") % 290)).alias("match_id"),
        pick(7).alias("home"),
        pick(5).alias("away"),
        (F.col("id") % 10 / 10).alias("p_home"),
        (F.lit(1) - F.col("id") % 10 / 10).alias("p_tie"),
        F.lit(0.0).alias("p_away"),
    )


def test_fixtures_are_drawn_without_a_row_for_each_block(spark):
    odds = odds_of(spark, 300)
    counts = season.outcome_counts(odds, 41)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "md5" not in plan
    drawn = season.season_draws(odds, 41).groupBy("match_id", "home", "away")
    same = drawn.agg(*[F.count_if(F.col("outcome") == x).alias(x) for x in "HTA"])
    assert sorted(map(repr, map(tuple, counts.collect()))) == sorted(map(repr, map(tuple, same.collect())))


def test_many_fixtures_are_summed_without_a_row_for_each_block(spark, monkeypatch):
    base = spark.createDataFrame(
        [(f"t{i}", i + 1, i, -i, 0.5) for i in range(8)],
        "team string, position int, points int, goal_diff int, strength double",
    )
    odds, found = odds_of(spark, 300), []
    for most in (10_000, 200):
        monkeypatch.setattr(season, "BROADCAST_FIXTURES", most)
        out = season.season_standings(base, odds, 41)
        found.append(sorted(map(tuple, out.collect())))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and found[0] == found[1] and len(found[0]) == 41 * 8
