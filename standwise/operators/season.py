"""Season outcomes: seeded scenarios of the open fixtures and how often each band is hit."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from standwise.functions import draws
from standwise.functions.draws import LANES
from standwise.functions.numbers import half_even
from standwise.functions.scoring import odds, strength
from standwise.llm.common import bounded
from standwise.operators.matches import one_per_team, pending
from standwise.sources.staging import stage

# Scenarios per run, seed, and the bands of final positions.
SCENARIOS = 10_000
SEED = 42
BANDS = {"p_top4": (1, 4), "p_top6": (1, 6), "p_mid": (7, 15), "p_drop": (16, None)}

# Fixtures that may be broadcast, about a hundred bytes each; and teams.  More of them are
# drawn as arrays, several times as fast.
BROADCAST_FIXTURES = 2_000

# A draw is eight hex digits of a hash.
HEX = 8

# Rows a task hands on at once.
ROWS_AT_ONCE = 50_000


def team_base(standings: DataFrame) -> DataFrame:
    """Per team: position, points and goal difference so far, and strength."""
    one = one_per_team(standings)
    return one.select(
        "team",
        F.coalesce("position", F.lit(99)).alias("position"),
        F.coalesce("points", F.lit(0)).alias("points"),
        F.coalesce("goal_diff", F.lit(0)).alias("goal_diff"),
        strength(F.col("points"), F.col("games")).alias("strength"),
    )


def fixture_odds(fixtures: DataFrame, base: DataFrame) -> DataFrame:
    """Chances of the fixtures between teams of the standings; others drop out."""
    home = base.select(F.col("team").alias("home"), F.col("strength").alias("home_strength"))
    away = base.select(F.col("team").alias("away"), F.col("strength").alias("away_strength"))
    p_home, p_tie, p_away = odds(F.col("home_strength"), F.col("away_strength"))
    return (
        fixtures.join(home, "home")
        .join(away, "away")
        .select(
            "match_id",
            "home",
            "away",
            p_home.alias("p_home"),
            p_tie.alias("p_tie"),
            p_away.alias("p_away"),
        )
    )


def hex_bound(chance: Column) -> Column:
    """Eight hex digits below which a uniform draw of eight falls with the given chance.

    A chance of 1 lies above every draw; so does the letter behind the last digit.
    """
    bound = F.ceil(chance * F.lit(float(16**HEX)))
    digits = F.lower(F.lpad(F.hex(bound), HEX, "0"))
    return F.when(bound >= 16**HEX, F.lit("g")).otherwise(digits)


def _bounds(odds: DataFrame) -> DataFrame:
    return odds.select(
        "match_id",
        "home",
        "away",
        hex_bound(F.col("p_home")).alias("home_below"),
        hex_bound(F.col("p_home") + F.col("p_tie")).alias("tie_below"),
    )


def _draw(lane: int) -> Column:
    return F.substring("hash", 1 + HEX * lane, HEX)


def _tasks(spark: SparkSession) -> int:
    return max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )


def drawn_blocks(
    odds: DataFrame, n: int, seed: int, partitions: int | None = None
) -> DataFrame:
    """Outcomes of every fixture in blocks of four scenarios, as columns ``lane0``..``lane3``.

    A draw is a slice of the hash of seed, scenario block and match id, so it is the same
    however the work is split and however often a task is run again.  The fixtures are
    spread first: a few thousand of them would otherwise share one task.
    """
    tasks = partitions or _tasks(odds.sparkSession)
    blocks = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // LANES)))
    hashed = _bounds(odds.repartition(tasks, "match_id")).withColumn("block", blocks)
    hashed = hashed.withColumn("hash", F.md5(F.concat_ws(":", F.lit(seed), "block", "match_id")))

    def outcome(lane: int) -> Column:
        home = F.when(_draw(lane) < F.col("home_below"), "H")
        return home.when(_draw(lane) < F.col("tie_below"), "T").otherwise("A")

    lanes = [outcome(lane).alias(f"lane{lane}") for lane in range(LANES)]
    return hashed.select("block", "match_id", "home", "away", *lanes)


def by_scenario(blocks: DataFrame, n: int, columns: list[str], fields: list[str]) -> DataFrame:
    """One row per scenario out of rows per block; ``fields`` exist once per lane."""
    lanes = F.explode(
        F.array(
            *[
                F.struct(
                    (F.col("block") * LANES + lane).alias("scenario"),
                    *[F.col(f"{field}{lane}").alias(field) for field in fields],
                )
                for lane in range(LANES)
            ]
        )
    )
    split = blocks.select(*columns, lanes.alias("lane"))
    return split.select(*columns, "lane.*").filter(F.col("scenario") < n)


def season_draws(odds: DataFrame, n: int = SCENARIOS, seed: int = SEED) -> DataFrame:
    """Outcome ('H', 'T' or 'A') of every fixture in every scenario, a row for each."""
    drawn = by_scenario(
        drawn_blocks(odds, n, seed), n, ["match_id", "home", "away"], ["lane"]
    )
    return drawn.select("scenario", "match_id", "home", "away", F.col("lane").alias("outcome"))


def _spread_fixtures(odds: DataFrame) -> DataFrame:
    """Fixtures spread over the tasks, with what is hashed of them and bounds as numbers.

    What is hashed is the same as in ``drawn_blocks``.
    """
    bounded(odds.sparkSession)

    def below(chance: Column) -> Column:
        return F.coalesce(F.ceil(chance * F.lit(float(16**HEX))), F.lit(0)).cast("long")

    tail = F.when(F.col("match_id").isNotNull(), F.concat(F.lit(":"), "match_id")).otherwise("")
    return odds.repartition(_tasks(odds.sparkSession), "match_id").select(
        "match_id",
        "home",
        "away",
        tail.cast("binary").alias("tail"),
        below(F.col("p_home")).alias("home_below"),
        below(F.col("p_home") + F.col("p_tie")).alias("tie_below"),
    )


def _numbers(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    bounds = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("home_below", "tie_below")]
    return batch.column("tail").to_pylist(), *bounds


def outcome_counts(odds: DataFrame, n: int = SCENARIOS, seed: int = SEED) -> DataFrame:
    """Per fixture, in how many of the scenarios each side wins and in how many neither.

    A task draws all scenarios of its fixtures and hands on a row per fixture.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                won, lost = draws.counted(*_numbers(batch), n, seed)
                counts = {"home_wins": won, "ties": n - won - lost, "away_wins": lost}
                given = {c: batch.column(c) for c in ("match_id", "home", "away")}
                yield pa.RecordBatch.from_pydict(given | {c: pa.array(x) for c, x in counts.items()})

    counts = _spread_fixtures(odds).mapInArrow(
        run,
        "match_id string, home string, away string, home_wins long, ties long, away_wins long",
    )
    # An id may repeat.
    sums = [F.sum(c).alias(c) for c in ("home_wins", "ties", "away_wins")]
    return counts.groupBy("match_id", "home", "away").agg(*sums)


def _gains(lanes: list[Column], own: str, other: str) -> list[Column]:
    """Points and goal difference of a side that has won ``own`` and lost ``other`` games."""
    fields = []
    for lane, n in enumerate(lanes):
        won, lost = F.col(f"{own}{lane}"), F.col(f"{other}{lane}")
        fields += [
            (won * 2 + n - lost).alias(f"points{lane}"),
            (won - lost).alias(f"goal_diff{lane}"),
        ]
    return fields


def _totals_in_place(base: DataFrame, odds: DataFrame, n: int, seed: int) -> DataFrame:
    """Totals per block and team; blocks are dealt to tasks and meet all fixtures there.

    Fixtures and teams are broadcast, so nothing but the numbers of the blocks is shuffled.
    A block sums its draws per pair of teams, then per team.
    """
    spark = base.sparkSession
    teams = base.select(
        F.lit(None).cast("string").alias("match_id"),
        F.col("team").alias("home"),
        *[F.lit(None).cast("string").alias(c) for c in ("away", "home_below", "tie_below")],
    )
    # Every block meets every entry, by a key that is the same for all of them: one that Spark
    # cannot work out beforehand, as it would compare all with all by a nested loop then.
    entries = _bounds(odds).unionByName(teams).withColumn("all", F.coalesce(F.length("home"), F.lit(0)) >= 0)
    blocks = spark.range(0, (n - 1) // LANES + 1).select(F.col("id").cast("int").alias("block"))
    blocks = blocks.repartition(_tasks(spark), "block").withColumns(
        {"all": F.col("block") >= 0, "prefix": F.concat_ws(":", F.lit(seed), "block", F.lit(""))}
    )
    drawn = blocks.join(F.broadcast(entries), "all")
    drawn = drawn.withColumn("hash", F.md5(F.concat("prefix", "match_id")))
    names = ["block", "home", "away", "home_below", "tie_below"]
    draws = [_draw(lane).alias(f"draw{lane}") for lane in range(LANES)]
    drawn = drawn.select(*names, F.col("match_id").isNotNull().alias("game"), *draws)
    sides = []
    for lane in range(LANES):
        draw = F.col(f"draw{lane}")
        sides.append(F.count_if(draw < F.col("home_below")).alias(f"won{lane}"))
        sides.append(F.count_if(draw >= F.col("tie_below")).alias(f"lost{lane}"))
    pairs = drawn.groupBy("block", "home", "away").agg(F.count_if("game").alias("games"), *sides)
    games = [F.col("games")] * LANES
    both = F.array(
        F.struct(F.col("home").alias("team"), *_gains(games, "won", "lost")),
        F.struct(F.col("away").alias("team"), *_gains(games, "lost", "won")),
    )
    fields = [f"{field}{lane}" for lane in range(LANES) for field in ("points", "goal_diff")]
    gains = pairs.select("block", F.explode(both).alias("gain")).select("block", "gain.*")
    gains = gains.where("team is not null").groupBy("block", "team")
    totals = gains.agg(*[F.sum(field).alias(field) for field in fields])
    start = base.select("team", F.col("position").alias("now"), "points", "goal_diff")
    return totals.join(F.broadcast(start), "team").select(
        "block",
        "team",
        "now",
        *[(F.col(field) + F.col(field[:-1])).alias(field) for field in fields],
    )


def _gain_rows(
    batch: pa.RecordBatch, n: int, seed: int, fields: list[str]
) -> Iterator[pa.RecordBatch]:
    """What the teams of some fixtures gain, a row per block and team; these may repeat."""
    both = pa.concat_arrays([batch.column("home"), batch.column("away")]).dictionary_encode()
    codes = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tails, *bounds = _numbers(batch)
    home, away = codes[: len(tails)], codes[len(tails) :]
    parts, size = [], 0

    def joined() -> pa.RecordBatch:
        block, team, gains = (np.concatenate(x) for x in zip(*parts))
        columns = {"block": pa.array(block, pa.int32()), "team": both.dictionary.take(pa.array(team))}
        return pa.RecordBatch.from_pydict(
            columns | {field: pa.array(gains[:, i]) for i, field in enumerate(fields)}
        )

    for blocks, teams, points, margins in draws.team_sums(tails, home, away, *bounds, n, seed):
        gains = np.stack([points, margins], axis=-1).reshape(-1, 2 * LANES)
        parts.append((np.repeat(blocks, len(teams)), np.tile(teams, len(blocks)), gains))
        size += len(gains)
        if size >= ROWS_AT_ONCE:
            yield joined()
            parts, size = [], 0
    if parts:
        yield joined()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to as many fixtures as are hashed at once, so that a task
    hands on the sums of a block and team as few times as it can."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.num_rows > draws.AT_ONCE:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.num_rows
    if size:
        yield pa.concat_batches(held)


def _totals_spread(base: DataFrame, odds: DataFrame, n: int, seed: int) -> DataFrame:
    """The same for any number of fixtures: each task draws and adds up its share of them per
    block and team before the shuffle."""
    fields = [f"{field}{lane}" for lane in range(LANES) for field in ("points", "goal_diff")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            yield from _gain_rows(batch, n, seed, fields)

    gains = _spread_fixtures(odds.where("match_id is not null")).mapInArrow(
        run, "block int, team string, " + ", ".join(f"{field} long" for field in fields)
    )
    played = gains.withColumn("now", F.lit(None).cast("int"))
    start = base.select(
        F.explode(F.sequence(F.lit(0), F.lit((n - 1) // LANES))).alias("block"),
        "team",
        F.col("position").alias("now"),
        *[
            F.col(field).alias(f"{field}{lane}")
            for lane in range(LANES)
            for field in ("points", "goal_diff")
        ],
    )
    return (
        start.unionByName(played)
        .groupBy("block", "team")
        .agg(
            F.max("now").alias("now"),
            *[
                F.sum(f"{field}{lane}").alias(f"{field}{lane}")
                for lane in range(LANES)
                for field in ("points", "goal_diff")
            ],
        )
    )


def _ranked_blocks(base: DataFrame, odds: DataFrame, n: int, seed: int) -> DataFrame:
    """Totals and ranks of every team in the four scenarios of every block.

    Rows of a block lie in one task before they are ranked, four times; they are sorted,
    not shuffled, for each.
    """
    base, odds = stage(base), stage(odds)
    small = odds.count() <= BROADCAST_FIXTURES and base.count() <= BROADCAST_FIXTURES
    totals = (_totals_in_place if small else _totals_spread)(base, odds, n, seed)

    def rank(lane: int) -> Column:
        order = [F.desc(f"points{lane}"), F.desc(f"goal_diff{lane}"), F.asc("now"), F.asc("team")]
        return F.row_number().over(Window.partitionBy("block").orderBy(*order))

    return totals.withColumns({f"rank{lane}": rank(lane) for lane in range(LANES)})


def season_standings(
    base: DataFrame, odds: DataFrame, n: int = SCENARIOS, seed: int = SEED
) -> DataFrame:
    """Points, goal difference and rank of every team in every scenario.

    Up to BROADCAST_FIXTURES fixtures and teams are sent to every task, and blocks of
    scenarios are drawn, summed and ranked without a shuffle; more of them are spread over
    the tasks, drawn as arrays and summed there before one shuffle by block and team.
    """
    ranked = _ranked_blocks(base, odds, n, seed)
    split = by_scenario(ranked, n, ["team"], ["points", "goal_diff", "rank"])
    return split.select("scenario", "team", "points", "goal_diff", "rank")


def season_probabilities(
    standings: DataFrame,
    matches: DataFrame,
    n: int = SCENARIOS,
    seed: int = SEED,
    bands: dict[str, tuple[int, int | None]] = BANDS,
) -> DataFrame:
    """Percent of scenarios in which each team ends in each band.

    Without open fixtures every scenario is the table as it stands: all 0 or 100.
    """
    # One row per team, used four times.
    base = stage(team_base(standings))
    odds = fixture_odds(pending(matches), base)
    ranked = _ranked_blocks(base, odds, n, seed)

    def times(low: int, high: int | None) -> Column:
        """In how many scenarios of a block a team's rank lies in a band."""
        found = F.lit(0)
        for lane in range(LANES):
            inside = (F.col("block") * LANES + lane < n) & (F.col(f"rank{lane}") >= low)
            if high is not None:
                inside = inside & (F.col(f"rank{lane}") <= high)
            found = found + inside.cast("int")
        return found

    # What is shuffled is a row per task and team, not one per scenario.
    shares = ranked.groupBy("team").agg(
        *[half_even(F.sum(times(*limits)) / n * 100, 1).alias(name) for name, limits in bands.items()]
    )
    return (
        base.select("team", "position", "points")
        .join(shares, "team")
        .orderBy("position", "team")
    )
