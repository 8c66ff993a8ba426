"""The model tables as SQL, written independently of the Spark code.

``MODEL`` is one chain of common table expressions; every oracle query starts with it.
"""

RAW_ORDER = (
    "src_shipdate, src_partkey, src_suppkey, src_price, src_quantity, "
    "src_discount, src_tax, src_flag, src_status"
)


def even(expr: str, digits: int) -> str:
    """Scale, round ties to even, scale back."""
    scale = float(10**digits)
    return f"(round_even(({expr})*{scale}, 0)/{scale})"


def up(expr: str, digits: int) -> str:
    """Decimal rounding, ties away from zero."""
    return f"cast(round(cast({expr} as decimal(18,8)), {digits}) as double)"


def score(pct: str, diff: str, goals: str, games: str) -> str:
    blend = (
        f"(coalesce({pct},0.0::double)*0.5::double"
        f" + (coalesce({diff},0)::double/greatest(coalesce({games},1),1)::double*5.0::double"
        f" + 50.0::double)*0.3::double"
        f" + (coalesce({goals},0)::double/greatest(coalesce({games},1),1)::double*10.0::double)"
        f"*0.2::double)"
    )
    return even(f"greatest(0.0::double, least(100.0::double, {blend}))", 2)


def res(own: str, other: str) -> str:
    return f"case when {own}>{other} then 'W' when {own}={other} then 'T' else 'L' end"


def part(prefix: str, cond: str) -> str:
    return f"""
  count(*) filter ({cond}) as {prefix}_games,
  count(*) filter ({cond} and result='W') as {prefix}_wins,
  count(*) filter ({cond} and result='T') as {prefix}_ties,
  count(*) filter ({cond} and result='L') as {prefix}_losses,
  coalesce(sum(goals_for) filter ({cond}),0)::bigint as {prefix}_goals_for,
  coalesce(sum(goals_against) filter ({cond}),0)::bigint as {prefix}_goals_against"""


MODEL = f"""
with nat as (
  select n_nationkey as n_key, n_name, r_name from nation join region on n_regionkey=r_regionkey),
game_lines as (
  select l.*, o.o_orderdate, o.o_custkey, s.s_name, hn.n_name as home_name, hn.r_name as home_region,
         an.n_name as away_name, an.r_name as away_region
  from lineitem l join orders o on l_orderkey=o_orderkey
  join customer c on o_custkey=c_custkey join nat hn on c_nationkey=hn.n_key
  join supplier s on l_suppkey=s_suppkey join nat an on s_nationkey=an.n_key
  where hn.n_key<>an.n_key),
raw as (
  select 'M'||l_orderkey||'-'||l_linenumber as match_id,
    (l_orderkey%38+1)::varchar as round,
    strftime(o_orderdate,'%d/%m/%Y') as match_date,
    case when l_linenumber%4=0 then 'A def.' else '16:00' end as kickoff,
    home_name||' '||home_region as home, away_name||' '||away_region as away,
    case when l_linenumber<>7 then (l_quantity::bigint%5)::varchar end as home_goals,
    case when l_linenumber<>7 then (l_partkey%4)::varchar end as away_goals,
    s_name as venue, home_name as city, home_region as state,
    l_shipdate as src_shipdate, l_partkey as src_partkey, l_suppkey as src_suppkey,
    l_extendedprice as src_price, l_quantity as src_quantity, l_discount as src_discount,
    l_tax as src_tax, l_returnflag as src_flag, l_linestatus as src_status,
    l_orderkey as order_key, l_linenumber as line
  from game_lines),
aliases as (
  select n_name||' '||r_name as raw_name, n_name as name from nat where n_key<20),
firsts as (
  select * from raw qualify row_number() over (partition by match_id order by {RAW_ORDER})=1),
matches as (
  select match_id, round::int as round, strptime(match_date,'%d/%m/%Y')::date as match_date, kickoff,
    coalesce(ha.name, home) as home, coalesce(aa.name, away) as away,
    home_goals::int as home_goals, away_goals::int as away_goals, venue, city, state
  from firsts left join aliases ha on home=ha.raw_name left join aliases aa on away=aa.raw_name),
finished as (
  select *, home_goals+away_goals as total_goals, {res('home_goals','away_goals')} as home_result,
    {res('away_goals','home_goals')} as away_result
  from matches where home_goals is not null and away_goals is not null),
sides as (
  select match_id, round, home as team, false as is_away, home_goals as goals_for,
    away_goals as goals_against, home_result as result from finished
  union all
  select match_id, round, away, true, away_goals, home_goals, away_result from finished),
totals as (
  select team, {part('total','where true')}, {part('home','where not is_away')},
    {part('away','where is_away')} from sides group by team),
cards as (
  select home as team, sum(regexp_extract(match_id,'([0-9]+)$',1)::int%3)::bigint as yellow,
    sum(regexp_extract(match_id,'([0-9]+)$',1)::int%2)::bigint as red from matches group by home),
table_all as (
  select t.team, total_wins*3+total_ties as points, total_games as games, total_wins as wins,
    total_ties as ties, total_losses as losses, total_goals_for as goals_for,
    total_goals_against as goals_against, total_goals_for-total_goals_against as goal_diff,
    yellow, red,
    {even('(total_wins*3+total_ties)::double/(total_games*3)::double*100.0::double',1)} as points_pct
  from totals t left join cards c on t.team=c.team),
standings as (
  select * from (
    select (row_number() over (order by points desc, goal_diff desc, goals_for desc, team))::int as position,
      team, points::int as points, games::int as games, wins::int as wins, ties::int as ties,
      losses::int as losses, goals_for::int as goals_for, goals_against::int as goals_against,
      goal_diff::int as goal_diff, yellow::int as yellow, red::int as red, points_pct
    from table_all)
  where team not in ('NATION_5','NATION_17')),
team_stats as (
  select t.team, s.position, s.points, s.points_pct,
    {score('s.points_pct','(total_goals_for-total_goals_against)','total_goals_for','total_games')} as score,
    total_games, total_wins, total_ties, total_losses, total_goals_for, total_goals_against,
    total_goals_for-total_goals_against as goal_diff_calc,
    {even('total_goals_for::double/total_games::double',2)} as avg_goals_for,
    {even('total_goals_against::double/total_games::double',2)} as avg_goals_against,
    {even('(total_wins*3+total_ties)::double/(total_games*3)::double*100.0::double',1)} as points_pct_calc,
    home_games, home_wins, home_ties, home_losses, home_goals_for, home_goals_against,
    away_games, away_wins, away_ties, away_losses, away_goals_for, away_goals_against
  from totals t left join standings s on t.team=s.team),
recent_sides as (
  select * from sides where round >= (select max(round) from finished)-4),
recent_form as (
  select c.team, recent_games, recent_wins, recent_ties, recent_losses,
    recent_wins*3+recent_ties as recent_points, form,
    {even('(recent_wins*3+recent_ties)::double/(recent_games*3)::double*100.0::double',1)} as recent_points_pct
  from (select team, count(*) as recent_games, count(*) filter (where result='W') as recent_wins,
          count(*) filter (where result='T') as recent_ties,
          count(*) filter (where result='L') as recent_losses
        from recent_sides group by team) c
  join (select team, string_agg(result,'' order by rn desc) as form from (
          select team, result, row_number() over (
            partition by team order by is_away desc, round desc, match_id desc) as rn
          from recent_sides) where rn<=5 group by team) f on c.team=f.team),
round_goals as (
  select round, count(match_id) as games, sum(total_goals)::bigint as total_goals,
    {even('sum(total_goals)::double/count(total_goals)::double',2)} as avg_goals,
    count(*) filter (where total_goals>0) as games_with_goals
  from finished where round is not null group by round),
scorers_raw as (
  select s_name as player, goals::varchar as goals, n_name as club
  from (select l_suppkey, sum(l_quantity::bigint%5)::bigint as goals from lineitem group by 1)
  join supplier on l_suppkey=s_suppkey join nat on s_nationkey=n_key),
scorers as (
  select (row_number() over (order by goals::int desc, player, club))::int as position, player,
    goals::int as goals, club from scorers_raw)
"""
