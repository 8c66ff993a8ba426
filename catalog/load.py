"""Coercions, files and keyed loads."""

from pyspark.sql import functions as F

from catalog.registry import query
from oracle.model import MODEL, RAW_ORDER
from standwise import schemas
from standwise.functions import numbers as n
from standwise.operators import keyed, stats
from standwise.operators.matches import coerce
from standwise.plans import daily, load, pipeline
from standwise.sources import binding as b
from standwise.sources import files
from standwise.sources.staging import staged_for, staging_path


def moment(text: str = "2026-01-02 03:04:05"):
    return F.lit(text).cast("timestamp")


def stamp_text(df):
    return df.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


def dirty_text():
    line, key = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    return (
        F.when(line == 1, F.concat(F.lit("  "), key, F.lit(" ")))
        .when(line == 2, F.concat(key, F.lit(".5")))
        .when(line == 3, F.concat(F.lit("-"), key, F.lit("e2")))
        .when(line == 4, F.concat(key, F.lit("d")))
        .when(line == 5, F.concat(F.lit("+."), key))
        .when(line == 6, F.when(F.col("l_orderkey") % 2 == 0, "").otherwise("n/a"))
    )


DIRTY = """(case l_linenumber when 1 then '  '||l_orderkey||' ' when 2 then l_orderkey||'.5'
    when 3 then '-'||l_orderkey||'e2' when 4 then l_orderkey||'d' when 5 then '+.'||l_orderkey
    when 6 then case when l_orderkey%2=0 then '' else 'n/a' end end)"""


@query(
    "coerce_numeric",
    rf"""select l_orderkey, l_linenumber, case when regexp_matches(trim({DIRTY}),
      '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')
      then try_cast(ltrim(trim({DIRTY}), '+') as double) end as value from lineitem""",
)
def coerce_numeric(t):
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", n.number(dirty_text()).alias("value")
    )


@query(
    "coerce_int",
    rf"""select l_orderkey, case when regexp_matches(trim({DIRTY}), '^[+-]?[0-9]+$')
      then try_cast(trim({DIRTY}) as integer) end as points,
      try_cast(trunc(l_extendedprice) as integer) as goals from lineitem""",
)
def coerce_int(t):
    rows = t.read("lineitem").select(
        "l_orderkey", dirty_text().alias("points"), F.col("l_extendedprice").alias("goals")
    )
    return coerce(rows, schemas.struct(points=schemas.INT, goals=schemas.INT))


@query(
    "coerce_date",
    """select l_orderkey, case when l_linenumber in (1,2,3) then l_shipdate::date end as day
    from lineitem""",
)
def coerce_date(t):
    line, day = F.col("l_linenumber"), F.col("l_shipdate")
    text = (
        F.when(line == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(line == 2, F.date_format(day, "d/M/yyyy"))
        .when(line == 3, F.concat(F.lit(" "), F.date_format(day, "dd/MM/yyyy"), F.lit(" ")))
        .when(line == 4, F.date_format(day, "yyyy-MM-dd"))
        .when(line == 5, F.concat(F.lit("31/02/"), F.date_format(day, "yyyy")))
        .when(line == 6, F.date_format(day, "dd/MM"))
    )
    return t.read("lineitem").select("l_orderkey", n.day_first_date(text).alias("day"))


@query(
    "coerce_string",
    """select l_orderkey, case when l_linenumber<>7 then l_partkey::varchar end as player,
      l_quantity as other from lineitem""",
)
def coerce_string(t):
    rows = t.read("lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("player"),
        F.col("l_quantity").alias("other"),
    )
    return coerce(rows, schemas.struct(player=schemas.STR))


CSV_COLUMNS = ["match_id", "round", "match_date", "home", "away", "home_goals", "away_goals"]


@query(
    "csv_roundtrip",
    MODEL
    + f"""select {', '.join(CSV_COLUMNS)}, case when line in (4,5) then null else kickoff end
      as kickoff, case line when 1 then '  '||home||' ' when 2 then home||chr(10)||' x '||away
      when 3 then '"'||home||'", ""' end as note, null::varchar as absent from raw""",
)
def csv_roundtrip(t):
    """Cells with line breaks, quotes and outer blanks, in a file with its own column order."""
    line, home = F.col("line"), F.col("home")
    kickoff = F.when(line == 4, "N/A").when(line == 5, "nan").otherwise(F.col("kickoff"))
    note = (
        F.when(line == 1, F.concat(F.lit("  "), home, F.lit(" ")))
        .when(line == 2, F.concat(home, F.lit("\n x "), "away"))
        .when(line == 3, F.concat(F.lit('"'), home, F.lit('", ""')))
        .when(line == 6, "n/a")
        .when(line == 7, "#N/A")
    )
    rows = t.matches_raw.select(*CSV_COLUMNS, kickoff.alias("kickoff"), note.alias("note"))
    path = staging_path(t.spark, "csv")
    files.write_csv(rows.select(*reversed(rows.columns)), path)
    wanted = schemas.struct(**{c: schemas.STR for c in (*rows.columns, "absent")})
    return files.read_csv(t.spark, path, wanted)


@query(
    "latest_snapshot",
    MODEL + "select match_id, home, away from finished",
)
def latest_snapshot(t):
    path = staging_path(t.spark, "snapshots")
    fixtures = t.stored_matches.select("match_id", "home", "away")
    played = t.stored_finished.select("match_id", "home", "away")
    files.write_snapshot(played, path, "20260101")
    files.write_snapshot(fixtures, path, "20260103")
    files.write_snapshot(fixtures, path, "20260102")
    files.write_snapshot(played, path, "20260103")
    return files.read_latest(t.spark, path, played.schema)


SINGLE = (
    MODEL
    + f""", source as (
      select match_id, round::int as round, home, away, venue from raw where order_key%3=0
      qualify row_number() over (partition by match_id order by src_shipdate desc,
        src_partkey desc, src_suppkey desc, src_price desc, src_quantity desc, src_discount desc,
        src_tax desc, src_flag desc, src_status desc)=1)
    select match_id, round, match_date, kickoff, home, away, home_goals, away_goals, venue, city,
      state, '2025-01-01 00:00:00' as updated_at
    from matches where match_id not in (select match_id from source)
    union all
    select match_id, round, null, null, home, away, null, null, venue, null, null,
      '2026-01-02 03:04:05' from source"""
)


@query("upsert_single_key", SINGLE)
def upsert_single_key(t):
    target = t.matches.withColumn("updated_at", moment("2025-01-01 00:00:00"))
    source = t.matches_raw.filter(F.col("order_key") % 3 == 0).select(
        "match_id",
        n.rounded_down(F.col("round")).alias("round"),
        "home",
        "away",
        "venue",
        *b.SOURCE_ORDER,
    )
    return stamp_text(keyed.upsert(target, source, ["match_id"], b.SOURCE_ORDER, moment()))


@query(
    "upsert_composite_key",
    MODEL
    + """, source as (
      select venue as player, city as club, max(line)::int as goals from raw
      where order_key%5=0 group by 1, 2)
    select position, player, goals, club from scorers s
    where not exists (select 1 from source x where x.player=s.player and x.club=s.club)
    union all select null, player, goals, club from source""",
)
def upsert_composite_key(t):
    source = t.matches_raw.filter(F.col("order_key") % 5 == 0).select(
        F.col("venue").alias("player"), F.col("city").alias("club"), F.col("line").alias("goals")
    )
    return keyed.upsert(t.scorers, source, ["player", "club"], ["goals"])


@query(
    "upsert_full",
    MODEL
    + """select position, team, points, null::int as games, null::int as wins, null::int as ties,
      null::int as losses, null::int as goals_for, null::int as goals_against,
      null::int as goal_diff, null::int as yellow, null::int as red, points_pct,
      '2026-01-02 03:04:05' as updated_at from team_stats""",
)
def upsert_full(t):
    target = t.standings.withColumn("updated_at", moment("2025-01-01 00:00:00"))
    source = t.team_stats.drop("total_games")
    once = keyed.upsert(target, source, ["team"], ["position"], moment())
    return stamp_text(keyed.upsert(once, source, ["team"], ["position"], moment()))


@query("replace_matches", MODEL + f"""select match_id, round::int as round, null::date as match_date,
      kickoff, home, away, home_goals::int as home_goals, away_goals::int as away_goals, venue, city,
      state from raw qualify row_number() over (partition by match_id order by {RAW_ORDER})=1""")
def replace_matches(t):
    rows = keyed.keep_first(t.matches_raw.drop("match_date"), ["match_id"], b.SOURCE_ORDER)
    return keyed.replace(schemas.MATCHES, rows, ["match_id"], b.SOURCE_ORDER)


def stored(column: str, precision: int) -> str:
    return f"cast({column} as decimal({precision},2)) as {column}"


@query(
    "store_decimal",
    MODEL
    + f"""select team, {stored('points_pct', 5)}, {stored('score', 6)}, {stored('avg_goals_for', 5)},
      {stored('avg_goals_against', 5)}, {stored('points_pct_calc', 5)} from team_stats""",
)
def store_decimal(t):
    columns = ["points_pct", "score", "avg_goals_for", "avg_goals_against", "points_pct_calc"]
    return load.as_stored(t.team_stats.select("team", *columns))


@query(
    "store_overflow",
    MODEL
    + """select match_id, case when length(state)>2 then 'state' else '' end as overflow
    from matches""",
)
def store_overflow(t):
    rows = load.prepared(t.matches, "matches")
    return rows.select("match_id", F.array_join("overflow", ",").alias("overflow"))


@query(
    "load_all",
    MODEL
    + """, counts as (
      select 'standings' as "table", count(*) as r, 0::bigint as rejected from standings
      union all select 'matches', count(*) filter (state is null or length(state)<=2),
        count(*) filter (length(state)>2) from matches
      union all select 'finished', count(*) filter (state is null or length(state)<=2),
        count(*) filter (length(state)>2) from finished
      union all select 'team_stats', count(*), 0 from team_stats
      union all select 'recent_form', count(*), 0 from recent_form
      union all select 'scorers', count(*), 0 from scorers)
    select "table", 'loaded' as status, r as rows, rejected, null::varchar as detail
    from counts union all select 'round_goals', 'skipped', null, null, null""",
)
def load_all(t):
    """Every table as it is; rows with texts that a table cannot hold are counted as rejected."""
    tables = {
        "standings": t.stored_standings,
        "matches": t.stored_matches,
        "finished": t.stored_finished,
        "team_stats": stats.team_stats(t.stored_finished, t.stored_standings),
        "recent_form": t.recent_form,
        "scorers": t.scorers,
    }
    stored = ["standings", "matches", "finished"]
    return load.load_all(t.spark, tables, staging_path(t.spark, "load"), moment(), stored=stored)


@query(
    "whole_run",
    MODEL
    + """, late as (
      select match_id, state, home_goals is not null or order_key%3=0 as known,
        round from firsts),
    teams as (select count(*) as n from standings),
    good as (select * from late where state is null or length(state)<=2)
    select * from (
      select 'standings' as "table", n as rows, 0::bigint as rejected from teams
      union all select 'matches', (select count(*) from good),
        (select count(*) from late where length(state)>2)
      union all select 'finished', (select count(*) from good where known),
        (select count(*) from late where known and length(state)>2)
      union all select 'team_stats', (select count(*) from totals), 0
      union all select 'recent_form', (select count(distinct team) from recent_form), 0
      union all select 'scorers', count(*), 0 from scorers
      union all select 'round_goals', (select count(distinct round) from late where known), 0)""",
)
def whole_run(t):
    """Raw tables and late scores in, the counts of every loaded table out."""
    # What is staged goes with the run, whose status holds no reader of it.
    t = b.Tables(t.spark, t.folder)
    with staged_for(t.spark):
        t.join_once()
        late = t.stored_first.filter(F.col("order_key") % 3 == 0)
        goals = [(F.col("order_key") % 4).cast("string").alias("home_goals"), F.lit("1").alias("away_goals")]
        raw = {
            "matches": t.matches_raw,
            "standings": t.standings_raw,
            "scorers": t.scorers_raw,
            "aliases": t.aliases,
            "scores": late.select("match_id", F.lit(1).alias("seq"), *goals),
        }
        status = pipeline.run(t.spark, raw, staging_path(t.spark, "run"), b.SOURCE_ORDER, now=moment())
    return status.select("table", "rows", "rejected")


def two_days(t):
    """A first day that knows some games of all rounds, and a second with two rounds in three."""
    root = staging_path(t.spark, "daily")
    number = F.col("round")
    known = t.stored_finished.filter((number % 3 == 0) | (F.length("match_id") % 2 == 0))
    daily.add_rounds(t.spark, known, number.isNull() | (number >= 0), root)
    daily.add_rounds(t.spark, t.stored_finished, number.isNull() | (number % 3 != 0), root)
    return root


@query("team_stats_daily", MODEL + "select * from team_stats")
def team_stats_daily(t):
    return daily.team_stats(t.spark, two_days(t), t.standings)


@query("round_goals_daily", MODEL + "select * from round_goals")
def round_goals_daily(t):
    return daily.round_goals(t.spark, two_days(t))
