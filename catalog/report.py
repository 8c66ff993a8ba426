"""Report tables."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.season import probabilities
from oracle.model import MODEL
from standwise.operators import season
from standwise.operators.season import SCENARIOS
from standwise.plans import report
from standwise.sources import files
from standwise.sources.staging import staging_path

def zone(expr: str) -> str:
    return f"case when {expr}<=6 then 'top' when {expr}>=16 then 'drop' else 'mid' end"


def js(expr: str) -> str:
    return f"round(({expr})::double, 1)"


def probable(t):
    return season.season_probabilities(t.stored_standings, t.stored_matches)


PROB = f"with prob as ({probabilities(SCENARIOS)})"


def kpi_sql(source: str) -> str:
    return (
        MODEL
        + f"""select (select max(round) from {source}) as latest_round,
      (select count(*) from {source}) as games,
      (select coalesce(sum(total_goals),0)::bigint from {source}) as total_goals,
      (select upper(team) from standings order by position limit 1) as leader,
      (select points from standings order by position limit 1) as leader_points,
      (select {js('sum(total_goals)::double/count(*)::double')} from {source}) as goals_per_game"""
    )


@query("report_kpis", kpi_sql("finished"))
def report_kpis(t):
    return report.kpis(t.stored_finished, t.stored_standings)


@query(
    "report_kpis_latest",
    kpi_sql("(select * from finished order by round desc, match_id limit 50)"),
)
def report_kpis_latest(t):
    return report.kpis(t.stored_finished, t.stored_standings, 50)


@query(
    "report_standings",
    MODEL
    + f"""select r.rank, upper(r.team) as team, {zone('r.rank')} as zone, points, games, wins, ties,
      losses, goals_for, goals_against,
      case when goal_diff>0 then '+' else '' end||goal_diff as goal_diff,
      coalesce(points_pct, 0.0) as points_pct, coalesce(right(form,5),'') as form
    from (select *, (row_number() over (order by position, team))::int as rank from standings) r
    left join recent_form f on r.team=f.team""",
)
def report_standings(t):
    return report.standings_report(t.standings, t.recent_form)


@query(
    "report_probabilities",
    PROB
    + f"""select position as place, upper(team) as team, {zone('position')} as zone, points, p_top4,
      p_top6, p_mid, p_drop from prob""",
)
def report_probabilities(t):
    return report.probabilities_report(probable(t))


@query(
    "report_prob_slices",
    PROB
    + """, r as (select *, (row_number() over (order by position, team))::int as rank from prob)
    select 'p_top4' as slice, rank, upper(team) as team, p_top4 as percent from r where rank<=4
    union all select 'p_top6', rank, upper(team), p_top6 from r where rank<=6
    union all select 'p_mid', rank, upper(team), p_mid from r where rank between 7 and 15
    union all select 'p_drop', rank, upper(team), p_drop from r where rank between 16 and 20""",
)
def report_prob_slices(t):
    return report.probability_slices(probable(t))


@query("report_prob_fallback", PROB + "select * from prob")
def report_prob_fallback(t):
    """Computed where none are stored, then read as stored; a failure in either is raised."""
    path = staging_path(t.spark, "probabilities")

    def not_stored():
        raise FileNotFoundError(f"no probabilities were stored under {path}")

    computed = report.load_probabilities(t.spark, path, lambda: probable(t), required=True)
    files.write_version(computed, path)
    return report.load_probabilities(t.spark, path, not_stored, required=True)


@query(
    "report_attack_defence",
    MODEL
    + """select upper(team) as team, total_goals_for, total_goals_against from team_stats
    order by position nulls last, team limit 10""",
)
def report_attack_defence(t):
    return report.attack_defence_chart(t.team_stats)


@query(
    "report_home_away_pct",
    MODEL
    + f"""select upper(team) as team,
      case when home_games>0 then {js('100.0::double*home_wins/home_games')} else 0 end as home_win_pct,
      case when away_games>0 then {js('100.0::double*away_wins/away_games')} else 0 end as away_win_pct
    from team_stats order by position nulls last, team limit 10""",
)
def report_home_away_pct(t):
    return report.home_away_chart(t.team_stats)


@query(
    "report_score_top15",
    MODEL
    + """select (row_number() over (order by score desc, position nulls last, team))::int as rank,
      upper(team) as team, score from team_stats
    order by score desc, position nulls last, team limit 15""",
)
def report_score_top15(t):
    return report.score_chart(t.team_stats)


@query(
    "report_scorers",
    MODEL
    + """select rank, rank<=3 as medal, player, club, goals,
      case when rank<=8 then split_part(player, ' ', -1) end as label from (
      select (row_number() over (order by goals desc, player, upper(club)))::int as rank, player,
        upper(club) as club, goals from scorers) where rank<=10""",
)
def report_scorers(t):
    return report.scorers_report(t.scorers)


def label(column: str) -> str:
    return f"case {column} when 'W' then 'win' when 'T' then 'tie' when 'L' then 'loss' else '' end"


@query(
    "report_latest_matches",
    MODEL
    + f"""select round, upper(home) as home, home_goals||' x '||away_goals as score,
      upper(away) as away, {label('home_result')} as home_label, {label('away_result')} as away_label,
      venue, concat_ws('/', nullif(city,''), nullif(state,'')) as place, kickoff
    from finished order by round desc, match_id limit 15""",
)
def report_latest_matches(t):
    return report.latest_matches(t.finished)


@query(
    "report_round_trend",
    MODEL + "select 'Rd '||round as label, avg_goals from round_goals",
)
def report_round_trend(t):
    return report.round_trend_chart(t.round_goals)


FORM = (
    MODEL
    + """, shares as (
      select upper(f.team) as team, recent_games, recent_wins, recent_ties, recent_losses,
        recent_points, recent_points::double/(recent_games*3)::double*100.0::double as share,
        coalesce(s.points_pct, 0.0::double) as overall,
        (row_number() over (order by recent_points::double/recent_games::double desc,
          upper(f.team)))::int as rank
      from recent_form f left join standings s on f.team=s.team)
    """
)


@query(
    "report_form_delta",
    FORM
    + f"""select rank, team, recent_games, recent_wins, recent_ties, recent_losses, recent_points,
      {js('share')} as recent_pct, {js('overall')} as overall_pct, {js('share-overall')} as delta,
      case when {js('share-overall')}>0 then '+' else '' end||{js('share-overall')}||'%' as delta_text,
      case when share-overall>2 then 'up' when share-overall< -2 then 'down' else 'flat' end as trend,
      case when share>=60 then 'high' when share>=40 then 'middle' else 'low' end as band
    from shares""",
)
def report_form_delta(t):
    return report.form_delta(t.recent_form, t.standings)


@query(
    "report_form_chart",
    FORM
    + f"""select rank, team, {js('share')} as recent_pct, overall as overall_pct from shares
    where rank<=15""",
)
def report_form_chart(t):
    return report.form_chart(t.recent_form, t.standings)


@query(
    "report_cards",
    MODEL
    + """select (row_number() over (order by yellow desc, position, team))::int as rank,
      upper(team) as team, yellow, red from standings""",
)
def report_cards(t):
    return report.cards(t.standings)


@query(
    "report_json",
    MODEL
    + """select '{"match_id":"'||match_id||'","round":'||round||',"match_date":"'||match_date||
      '","home":"'||home||'","home_goals":'||coalesce(home_goals::varchar,'null')||
      ',"kickoff":'||case when kickoff='16:00' then '"16:00"' else 'null' end||'}' as record
    from matches""",
)
def report_json(t):
    kickoff = F.when(F.col("kickoff") == "16:00", F.col("kickoff"))
    shown = t.matches.select(
        "match_id", "round", "match_date", "home", "home_goals", kickoff.alias("kickoff")
    )
    return files.json_records(shown)


@query(
    "report_time",
    """select l_orderkey, strftime(l_shipdate - interval 3 hour, '%d/%m/%Y %H:%M') as at
    from lineitem""",
)
def report_time(t):
    at = report.report_time(F.col("l_shipdate").cast("timestamp"))
    return t.read("lineitem").select("l_orderkey", at.alias("at"))
