"""The whole run: raw tables in, result tables and report out."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from standwise.operators import matches as m
from standwise.operators import overlay, stats
from standwise.operators.keyed import keep_first
from standwise.operators.season import SCENARIOS, season_probabilities
from standwise.plans.load import load_all
from standwise.schemas import MATCHES
from standwise.sources.files import read_version, write_version
from standwise.sources.staging import SMALLEST, stage, staged_for


def model_tables(
    matches: DataFrame, raw_standings: DataFrame, raw_scorers: DataFrame, scorer_order: list[str]
) -> dict[str, DataFrame]:
    """Clean and derived tables.

    Matches and standings feed several of the others, so each is written once and read
    back by them.
    """
    matches = stage(matches, SMALLEST)
    finished = m.finished(matches)
    standings = stage(m.clean_standings(raw_standings))
    return {
        "standings": standings,
        "matches": matches,
        "finished": finished,
        "scorers": m.clean_scorers(raw_scorers, scorer_order),
        "team_stats": stats.team_stats(finished, standings),
        "recent_form": stats.recent_form(finished),
        "round_goals": stats.round_goals(finished),
    }


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    match_order: list[str],
    scorer_order: list[str] = (),
    now: Column | None = None,
    scenarios: int = SCENARIOS,
    orders: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Clean, derive, simulate and load; returns the status of each table.

    ``raw`` holds matches, standings, scorers and aliases, and any of scores by id
    (``scores``), scores by link (``link_scores``) and page texts (``texts``).  Repeated
    matches go before late scores are joined, so that no id is heavy in that join.
    ``orders`` tells the order of source rows for the load, see ``load_table``.
    What the run stages is removed at its end.
    """
    with staged_for(spark):
        return _run(spark, raw, root, match_order, scorer_order, now, scenarios, orders)


def _run(spark, raw, root, match_order, scorer_order, now, scenarios, orders) -> DataFrame:
    known = [c for c in raw["matches"].columns if c in MATCHES.names]
    first = keep_first(raw["matches"], ["match_id"], match_order).select(*known)
    late = [raw.get(name) for name in ("scores", "link_scores", "texts")]
    if late[2] is not None:
        # Texts are looked up for the matches, and met by them.
        first = overlay.overlay_tiers(stage(first), *late)
    elif any(tier is not None for tier in late):
        # The first rows lie by id as the join of the scores needs them: they are neither
        # written nor shuffled for it. Their ids are those of the raw matches.
        first = overlay.overlay_tiers(first, *late, ids=raw["matches"].select("match_id"))
    matches = m.typed_matches(first, raw["aliases"])
    tables = model_tables(matches, raw["standings"], raw["scorers"], list(scorer_order))
    chances = season_probabilities(tables["standings"], tables["matches"], scenarios)
    write_version(chances, f"{root}/probabilities")
    return load_all(spark, tables, root, now, orders, stored=["standings", "matches", "finished"])


def stored_tables(spark: SparkSession, root: str, schemas: Mapping) -> dict[str, DataFrame]:
    """Readers of the newest version of each table."""
    return {name: read_version(spark, f"{root}/{name}", s) for name, s in schemas.items()}
