"""Season scenarios and their probabilities."""

from pyspark.sql import functions as F

from catalog.registry import query
from oracle.model import MODEL, even
from standwise.functions import scoring
from standwise.operators import matches as m
from standwise.operators import season
from standwise.operators.season import SCENARIOS

SEASON = (
    MODEL
    + """, base as (
      select team, position, points, goal_diff, case when games=0 then 0.4::double else
        least(greatest(points::double/(games*3)::double, 0.05::double), 0.95::double) end as strength
      from standings),
    odds as (
      select match_id, p.home, p.away,
        h.strength/(h.strength+a.strength+0.3::double) as p_home,
        1.0::double - h.strength/(h.strength+a.strength+0.3::double)
          - a.strength/(h.strength+a.strength+0.3::double) as p_tie,
        a.strength/(h.strength+a.strength+0.3::double) as p_away
      from (select match_id, home, away from matches
            where home_goals is null or away_goals is null) p
      join base h on p.home=h.team join base a on p.away=a.team)
    """
)


def draws(n: int) -> str:
    return (
        SEASON
        + f""", uniform as (
      select scenario, match_id, home, away, p_home, p_tie,
        ('0x'||substr(md5('42:'||(scenario//4)||':'||match_id), 1+8*(scenario%4), 8))::ubigint::double
          / 4294967296.0::double as u
      from odds, (select unnest(range({n}))::int as scenario)),
    draws as (
      select scenario, match_id, home, away,
        case when u < p_home then 'H' when u < p_home+p_tie then 'T' else 'A' end as outcome
      from uniform),
    ranks as (
      select scenario, team, points, goal_diff, (row_number() over (partition by scenario
          order by points desc, goal_diff desc, position))::int as rank from (
        select scenario, team, sum(points)::bigint as points, sum(goal_diff)::bigint as goal_diff,
          max(position) as position from (
          select scenario, home as team, case outcome when 'H' then 3 when 'T' then 1 else 0 end
            as points, case outcome when 'H' then 1 when 'A' then -1 else 0 end as goal_diff,
            null::int as position from draws
          union all
          select scenario, away, case outcome when 'A' then 3 when 'T' then 1 else 0 end,
            case outcome when 'A' then 1 when 'H' then -1 else 0 end, null from draws
          union all
          select scenario, team, points, goal_diff, position
          from base, (select unnest(range({n}))::int as scenario)) group by 1, 2))
    """
    )


def probabilities(n: int) -> str:
    def share(cond: str) -> str:
        return even(f"count(*) filter ({cond})::double/{n}::double*100.0::double", 1)

    return (
        draws(n)
        + f"""select b.team, b.position, b.points, p_top4, p_top6, p_mid, p_drop from base b join (
      select team, {share('rank<=4')} as p_top4, {share('rank<=6')} as p_top6,
        {share('rank between 7 and 15')} as p_mid, {share('rank>=16')} as p_drop
      from ranks group by team) r on b.team=r.team"""
    )


@query(
    "team_strength",
    SEASON + "select team, position, points, goal_diff, strength from base",
)
def team_strength(t):
    return season.team_base(t.stored_standings)


@query("fixture_odds", SEASON + "select * from odds")
def fixture_odds(t):
    return odds(t)


def odds(t):
    base = season.team_base(t.stored_standings)
    return season.fixture_odds(m.pending(t.stored_matches), base)


@query(
    "season_draws",
    draws(SCENARIOS)
    + """select match_id, home, away, count(*) filter (outcome='H') as home_wins,
      count(*) filter (outcome='T') as ties, count(*) filter (outcome='A') as away_wins
    from draws group by match_id, home, away""",
)
def season_draws(t):
    return season.outcome_counts(odds(t))


@query("season_standings", draws(SCENARIOS) + "select * from ranks")
def season_standings(t):
    return season.season_standings(season.team_base(t.stored_standings), odds(t))


@query("season_probabilities", probabilities(SCENARIOS))
def season_probabilities(t):
    return season.season_probabilities(t.stored_standings, t.stored_matches)


@query(
    "season_no_pending",
    SEASON
    + """select team, position, points,
      case when position_now<=4 then 100.0 else 0.0 end::double as p_top4,
      case when position_now<=6 then 100.0 else 0.0 end::double as p_top6,
      case when position_now between 7 and 15 then 100.0 else 0.0 end::double as p_mid,
      case when position_now>=16 then 100.0 else 0.0 end::double as p_drop
    from (select *, row_number() over (order by points desc, goal_diff desc, position)
      as position_now from base)""",
)
def season_no_pending(t):
    return season.season_probabilities(t.stored_standings, t.stored_finished)


@query(
    "outcome_shares",
    MODEL
    + """select state, count(*) filter (home_result='W') as home_wins,
      count(*) filter (home_result='T') as ties, count(*) filter (away_result='W') as away_wins
    from finished group by state""",
)
def outcome_shares(t):
    own = scoring.outcome(F.col("home_goals"), F.col("away_goals"))
    return (
        t.finished.groupBy("state")
        .agg(
            F.count_if(own == "W").alias("home_wins"),
            F.count_if(own == "T").alias("ties"),
            F.count_if(own == "L").alias("away_wins"),
        )
    )
