"""Model tables and the analytic query set."""

from pyspark.sql import functions as F

from catalog.registry import query
from oracle.model import MODEL, score, up
from standwise.functions.scoring import performance_score
from standwise.operators import matches as m
from standwise.operators import stats
from standwise.operators.keyed import keep_first, keep_last
from standwise.plans import queries as q
from standwise.sources.binding import SOURCE_ORDER

RAW_COLUMNS = "match_id, round, match_date, kickoff, home, away, home_goals, away_goals, venue"


@query(
    "dedup_first",
    MODEL + f"select {RAW_COLUMNS} from firsts",
)
def dedup_first(t):
    first = keep_first(t.matches_raw, ["match_id"], SOURCE_ORDER)
    return first.select(*RAW_COLUMNS.split(", "))


@query(
    "dedup_last",
    MODEL
    + f"""select {RAW_COLUMNS} from raw qualify row_number() over (partition by match_id
    order by src_shipdate desc, src_partkey desc, src_suppkey desc, src_price desc,
    src_quantity desc, src_discount desc, src_tax desc, src_flag desc, src_status desc)=1""",
)
def dedup_last(t):
    last = keep_last(t.matches_raw, ["match_id"], SOURCE_ORDER)
    return last.select(*RAW_COLUMNS.split(", "))


@query(
    "alias_names",
    MODEL
    + """select match_id, coalesce(ha.name, home) as home, coalesce(aa.name, away) as away
    from raw left join aliases ha on home=ha.raw_name left join aliases aa on away=aa.raw_name""",
)
def alias_names(t):
    named = m.alias_names(t.matches_raw, t.aliases, ["home", "away"])
    return named.select("match_id", "home", "away")


@query("matches", MODEL + "select * from matches")
def matches(t):
    return t.matches


@query("finished", MODEL + "select * from finished")
def finished(t):
    return t.finished


@query(
    "pending",
    MODEL
    + "select match_id, home, away from matches where home_goals is null or away_goals is null",
)
def pending(t):
    return m.pending(t.matches)


@query("team_sides", MODEL + "select * from sides")
def team_sides(t):
    return m.sides(t.finished)


@query(
    "teams",
    MODEL
    + "select home as team from matches where home is not null union select away from matches "
    "where away is not null",
)
def teams(t):
    return m.teams(t.matches)


@query("clean_standings", MODEL + "select * from standings")
def clean_standings(t):
    return t.standings


@query("standings_min_name", MODEL + "select team from table_all where length(team)>1")
def standings_min_name(t):
    from standwise.operators.pages import named_teams

    return named_teams(t.standings_raw).select("team")


@query("clean_scorers", MODEL + "select * from scorers")
def clean_scorers(t):
    return t.scorers


@query("team_stats", MODEL + "select * from team_stats")
def team_stats(t):
    return t.team_stats.orderBy(F.asc_nulls_last("position"), "team")


@query("recent_form", MODEL + "select * from recent_form")
def recent_form(t):
    return t.recent_form


@query(
    "recent_form_chronological",
    MODEL
    + """select team, string_agg(result,'' order by rn desc) as form from (
      select team, result, row_number() over (
        partition by team order by round desc, match_id desc) as rn from recent_sides)
    where rn<=5 group by team""",
)
def recent_form_chronological(t):
    return stats.recent_form(t.stored_finished, order="chronological").select("team", "form")


@query("round_goals", MODEL + "select * from round_goals")
def round_goals(t):
    return t.round_goals


@query(
    "performance_score",
    MODEL
    + f"""select venue, count(*) as games, {score(
        "avg(round)", "(sum(home_goals)-sum(away_goals))", "sum(home_goals)", "count(*)")
        .replace("avg(round)", "(sum(round)::double/count(round)::double)")} as score
    from finished group by venue""",
)
def performance_scores(t):
    games = t.finished.groupBy("venue").agg(
        F.count("*").alias("games"),
        (F.sum("round") / F.count("round")).alias("share"),
        (F.sum("home_goals") - F.sum("away_goals")).alias("diff"),
        F.sum("home_goals").alias("goals"),
    )
    value = performance_score(F.col("share"), F.col("diff"), F.col("goals"), F.col("games"))
    return games.select("venue", "games", value.alias("score"))


@query(
    "audit_counts",
    MODEL
    + """select (select count(*) from matches) as matches,
    (select count(*) from finished) as finished,
    (select count(distinct round) from matches) as rounds,
    (select count(home_goals) from matches) as with_score""",
)
def audit_counts(t):
    return m.audit(t.stored_matches, t.stored_finished)


@query(
    "q01_standings",
    MODEL
    + f"""select position, team, points, games, wins, ties, losses, goals_for, goals_against,
    goal_diff, {up('points_pct', 1)} as points_pct from standings order by position""",
)
def q01(t):
    return q.standings_table(t.standings)


@query(
    "q02_top_scorers",
    MODEL
    + "select player, club, goals from scorers order by goals desc, player, club limit 10",
)
def q02(t):
    return q.top_scorers(t.scorers)


@query(
    "q03_attack_defence",
    MODEL
    + f"""select team, total_games, total_goals_for, {up('avg_goals_for', 2)} as avg_goals_for,
    total_goals_against, {up('avg_goals_against', 2)} as avg_goals_against, goal_diff_calc,
    {up('score', 1)} as score from team_stats""",
)
def q03(t):
    return q.attack_defence(t.team_stats)


@query(
    "q04_home_away",
    MODEL
    + f"""select team, home_games, home_wins,
    {up('100.0::double*home_wins/nullif(home_games,0)', 1)} as home_win_pct, away_games, away_wins,
    {up('100.0::double*away_wins/nullif(away_games,0)', 1)} as away_win_pct,
    home_wins-away_wins as win_diff from team_stats""",
)
def q04(t):
    return q.home_away(t.team_stats)


@query(
    "q05_recent_form",
    MODEL
    + f"""select s.position, f.team, f.form, f.recent_points, f.recent_wins, f.recent_ties,
    f.recent_losses, {up('f.recent_points_pct', 1)} as recent_points_pct
    from recent_form f join standings s on f.team=s.team""",
)
def q05(t):
    return q.form_table(t.recent_form, t.standings)


@query(
    "q06_top_matches",
    MODEL
    + """select round, home, home_goals, away_goals, away, total_goals, venue from finished
    order by total_goals desc, round desc, match_id limit 10""",
)
def q06(t):
    return q.top_matches(t.finished)


@query(
    "q07_round_trend",
    MODEL
    + f"select round, games, total_goals, {up('avg_goals', 2)} as avg_goals from round_goals",
)
def q07(t):
    return q.round_trend(t.round_goals)


@query(
    "q08_unbeaten",
    MODEL
    + """select team, len(good)::bigint as unbeaten_games, array_to_string(good, '') as sequence
    from (
      select team, list_reverse(list_filter(results[1:5], lambda x: x <> 'L')) as good
      from (
        select team, list(result order by round desc, match_id desc) as results
        from sides group by team))
    where len(good) >= 3""",
)
def q08(t):
    return q.unbeaten(t.finished)


@query(
    "q09_head_to_head",
    MODEL
    + """select round, home, home_goals, away_goals, away, venue, home_result from finished
    where (home='NATION_3' and away='NATION_8') or (home='NATION_8' and away='NATION_3')""",
)
def q09(t):
    return q.head_to_head(t.finished, "NATION_3", "NATION_8")


@query(
    "q10_performance",
    MODEL
    + f"""select s.position, ts.team, s.points, {up('ts.score', 1)} as score,
    {up('ts.points_pct_calc', 1)} as points_pct, ts.total_goals_for, ts.goal_diff_calc, f.form
    from team_stats ts join standings s on ts.team=s.team join recent_form f on ts.team=f.team""",
)
def q10(t):
    return q.performance(t.team_stats, t.standings, t.recent_form)


@query("adhoc_teams", MODEL + "select team from standings order by position")
def adhoc_teams(t):
    return q.team_list(t.standings)


@query("adhoc_limit", MODEL + "select team from recent_form order by team limit 5")
def adhoc_limit(t):
    return q.first_teams(t.recent_form)


@query("adhoc_limit_stats", MODEL + "select team from team_stats order by team limit 5")
def adhoc_limit_stats(t):
    return q.first_teams(t.team_stats)


@query("adhoc_distinct_home", MODEL + "select distinct home from matches")
def adhoc_distinct_home(t):
    return q.home_teams(t.matches)


@query(
    "adhoc_matches",
    MODEL + "select home, home_goals, away_goals, away, round from finished",
)
def adhoc_matches(t):
    return q.scores_by_round(t.finished)
