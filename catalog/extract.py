"""Pages, document rows and score overlays."""

from pyspark.sql import functions as F

from catalog.registry import query
from oracle.model import MODEL, RAW_ORDER
from standwise.functions import text as tx
from standwise.operators import documents, overlay, pages
from standwise.sources import binding as b

PARAGRAPH = r"(?s)<p>(.*?)</p>"
ITEM = r"(?s)<li>(.*?)</li>"
WORD = r"([^ \t\r\n]+)"

STRIP_TAGS = "trim(regexp_replace({0}, '<[^>]*>', '', 'g'))"

# The references that occur in the given pages.
RESOLVED = [("&nbsp;", chr(160)), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">")]
RESOLVED += [("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]


def unescaped(expr: str) -> str:
    for name, char in RESOLVED:
        expr = f"replace({expr}, '{name}', '{char}')"
    return expr


@query(
    "page_widest_container",
    f"""select page_id, (i-1)::int as container_at, width::int as width, body from (
      select page_id, i, body, len(regexp_extract_all(body, '{WORD}')) as width from (
        select page_id, unnest(c) as body, generate_subscripts(c, 1) as i from (
          select page_id, regexp_extract_all(html, '{PARAGRAPH}', 1) as c from pages)))
    qualify row_number() over (partition by page_id order by width desc, i)=1""",
)
def page_widest_container(t):
    return pages.widest_container(t.read("pages"), PARAGRAPH, WORD)


@query(
    "page_rows_min_cells",
    f"""select page_id, (i-1)::int as row_at, len(w)::int as cells, w[1] as first_cell,
      w[len(w)] as last_cell from (
      select page_id, i, regexp_extract_all(body, '{WORD}', 1) as w from (
        select page_id, unnest(c) as body, generate_subscripts(c, 1) as i from (
          select page_id, regexp_extract_all(html, '{PARAGRAPH}', 1) as c from pages)))
    where len(w) >= 12""",
)
def page_rows_min_cells(t):
    bodies = t.read("pages").select("page_id", F.col("html").alias("body"))
    rows = pages.rows_min_cells(
        pages.container_rows(bodies, ["page_id"], PARAGRAPH, WORD), 12
    )
    return rows.select(
        "page_id",
        "row_at",
        F.size("cells").alias("cells"),
        F.get("cells", F.lit(0)).alias("first_cell"),
        F.element_at("cells", -1).alias("last_cell"),
    )


@query(
    "page_rows_exact_cells",
    f"""select page_id, (i-1)::int as row_at, w[1] as first_cell from (
      select page_id, i, regexp_extract_all(body, '{WORD}', 1) as w from (
        select page_id, unnest(c) as body, generate_subscripts(c, 1) as i from (
          select page_id, regexp_extract_all(html, '{PARAGRAPH}', 1) as c from pages)))
    where len(w) = 5""",
)
def page_rows_exact_cells(t):
    bodies = t.read("pages").select("page_id", F.col("html").alias("body"))
    rows = pages.rows_exact_cells(
        pages.container_rows(bodies, ["page_id"], PARAGRAPH, WORD), 5
    )
    return rows.select("page_id", "row_at", F.get("cells", F.lit(0)).alias("first_cell"))


@query(
    "page_cell_text",
    f"""select page_id, (i-1)::int as at, {unescaped(STRIP_TAGS.format(
        "case when cell like '%<a %' then regexp_extract(cell, '<a [^>]*>(.*?)</a>', 1) else cell end"
    ))} as text from (
      select page_id, unnest(c) as cell, generate_subscripts(c, 1) as i from (
        select page_id, regexp_extract_all(html, '{ITEM}', 1) as c from pages))""",
)
def page_cell_text(t):
    cells = t.read("pages").select(
        "page_id", F.posexplode(pages.pieces(F.col("html"), ITEM)).alias("at", "cell")
    )
    return cells.select("page_id", "at", pages.cell_text(F.col("cell")).alias("text"))


@query(
    "page_text",
    f"""select page_id, {unescaped("""regexp_replace(regexp_replace(html,
      '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g')""")}
      as text from pages""",
)
def page_text(t):
    return pages.page_text(t.read("pages"))


@query(
    "page_preferred_link",
    """with links as (
      select page_id, href, i from (
        select page_id, unnest(c) as href, generate_subscripts(c, 1) as i from (
          select page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) as c from pages))
      where href like '%,')
    select page_id, case when href like '/%' then 'https://example.org'||href else href end as href
    from links qualify row_number() over (
      partition by page_id order by contains(lower(href), 'er') desc, i)=1""",
)
def page_preferred_link(t):
    return pages.preferred_link(t.read("pages"), ",", "er", "https://example.org")


@query(
    "link_parent_text",
    f"""select page_id, c.href as href, {unescaped(STRIP_TAGS.format("c.body"))} as text from (
      select page_id, unnest(list_transform(list_zip(
        regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 1),
        regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 2)),
        lambda x: struct_pack(href := x[1], body := x[2]))) as c from pages)""",
)
def link_parent_text(t):
    found = pages.link_parents(t.read("pages"), "^/")
    return found.select("page_id", F.explode("links.href").alias("href"), "text")


MIXED = """(case line%5 when 0 then round||'+ NORTH' when 1 then '  '||round||city
    when 2 then city||round when 3 then round||'#'||line else round end)"""


def mixed_text():
    line = F.col("line") % 5
    return (
        F.when(line == 0, F.concat("round", F.lit("+ NORTH")))
        .when(line == 1, F.concat(F.lit("  "), "round", "city"))
        .when(line == 2, F.concat("city", "round"))
        .when(line == 3, F.concat("round", F.lit("#"), "line"))
        .otherwise(F.col("round"))
    )


@query(
    "text_leading_number",
    MODEL
    + f"""select match_id, {MIXED} as text, case when line%5=2 then '' else round end as number
    from raw""",
)
def text_leading_number(t):
    return t.matches_raw.select(
        "match_id",
        mixed_text().alias("text"),
        tx.leading_number(mixed_text()).alias("number"),
    )


@query(
    "text_strip_digits",
    MODEL
    + rf"""select match_id, trim(regexp_replace({MIXED}||' '||venue, '[\d+\-]+', '', 'g'))
      as text from raw""",
)
def text_strip_digits(t):
    return t.matches_raw.select(
        "match_id", tx.strip_digits(F.concat_ws(" ", mixed_text(), "venue")).alias("text")
    )


@query(
    "text_score",
    MODEL
    + """select match_id, case when line%3<>2 then home_goals end as h,
      case when line%3<>2 then away_goals end as a from raw where home_goals is not null""",
)
def text_score(t):
    line = F.col("line") % 3
    middle = (
        F.when(line == 0, F.concat(F.lit(" "), "home_goals", F.lit("x"), "away_goals", F.lit(" ")))
        .when(
            line == 1,
            F.concat(F.lit(" "), "home_goals", F.lit("  X "), "away_goals", F.lit(" ")),
        )
        .otherwise(" no score ")
    )
    home, away = tx.score_in_text(F.concat("home", middle, "away"))
    known = t.matches_raw.filter(F.col("home_goals").isNotNull())
    return known.select("match_id", home.alias("h"), away.alias("a"))


@query(
    "link_id",
    MODEL
    + """select match_id, case when line=2 then null else coalesce(nullif(ltrim(
      (order_key*8)::varchar, '0'), ''), '0') end as id from raw""",
)
def link_id(t):
    padded = F.lpad((F.col("order_key") * 8).cast("string"), 16, "0")
    folder = F.when(F.col("line") == 2, "/teams/").otherwise("/games/league/")
    href = F.concat(F.lit("https://example.org"), folder, padded, F.lit("/x"))
    return t.matches_raw.select("match_id", tx.link_id(href, "/games/league/").alias("id"))


def game_text():
    line = F.col("line")
    score = F.concat_ws(" x ", "home_goals", "away_goals")
    return (
        F.when(line == 1, F.concat_ws(" x ", "home", "away"))
        .when(line == 2, F.concat("home", F.lit("  "), score, F.lit("   "), "away"))
        .when(line == 3, F.concat_ws(" x ", "home", "away", "city"))
        .when(line == 4, F.concat_ws(" vs ", "home", "away"))
        .when(F.col("home_goals").isNotNull(), F.concat_ws(" ", "home", score, "away"))
        .otherwise(F.concat_ws(" x ", "home", "away"))
    )


@query(
    "game_text_parse",
    MODEL
    + """select match_id, venue, home, case when line not in (1,3) then home_goals end as home_goals,
      case when line not in (1,3) then away_goals end as away_goals,
      case when line=3 then away||' x '||city else away end as away from raw where line<>4""",
)
def game_text_parse(t):
    rows = t.matches_raw.select("match_id", "venue", game_text().alias("game"))
    return documents.parse_games(rows)


DOCS = (
    MODEL
    + rf""", doc as (
      select order_key%7 as doc_id, order_key*8+line as seq, line,
        case when line=3 and order_key%5=0 then 'Ref' else (order_key*8+line)::varchar end as ref,
        case when line=1 then 'Round '||round else '' end as round_cell,
        match_date, case when line=2 then 'None' else kickoff end as kickoff,
        case when order_key%11=0 then home||' vs '||away when order_key%13=0 then ''
          when order_key%17=0 then 'None' when home_goals is null then home||' x '||away
          else home||' '||home_goals||' x '||away_goals||' '||away end as game,
        order_key%11=0 as unparsable, home, away, home_goals, away_goals,
        case when line=6 then '' else venue end as venue,
        case when line=6 then '' else city end as city,
        case when line=6 then '' else state end as state
      from firsts),
    kept as (select * from doc where ref<>'Ref' and game not in ('','None')),
    filled as (
      select *, last_value(nullif(regexp_extract(round_cell,'(\d+)',1),'')::int ignore nulls) over (
        partition by doc_id order by seq rows unbounded preceding) as round from kept)
    """
)


@query(
    "doc_rows_parse",
    DOCS
    + """select doc_id, seq, ref as match_id, round, match_date,
      case when kickoff in ('A def.','None','') then null else kickoff end as kickoff,
      home, home_goals, away_goals, away, venue, city, state from filled where not unparsable""",
)
def doc_rows_parse(t):
    return documents.matches_from_doc_rows(b.document_rows(t))


@query("round_forward_fill", DOCS + "select doc_id, seq, round from filled")
def round_forward_fill(t):
    rows = documents.game_rows(documents.named_cells(b.document_rows(t)))
    return documents.fill_round(rows.select("doc_id", "seq", "round"))


SCORERS = (
    MODEL
    + """, given as (
      select l_suppkey%7 as sheet, goals as total, player, club, l_suppkey as k from (
        select l_suppkey, sum(l_quantity::bigint%5)::bigint as goals from lineitem group by 1)
      join (select s_suppkey, s_name as player, n_name as club from supplier
            join nat on s_nationkey=n_key) on l_suppkey=s_suppkey)
    """
)


def given_scorers(t):
    home_goals, _ = b.line_goals()
    goals = t.read("lineitem").groupBy("l_suppkey").agg(F.sum(home_goals).alias("total"))
    names = t.read("supplier").join(t.nations("n"), F.col("s_nationkey") == F.col("n_key"))
    return goals.join(names, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("k"),
        "total",
        F.col("s_name").alias("player"),
        F.col("n_name").alias("club"),
    )


def raw_scorers(t):
    kind = F.col("k") % 6
    raw = (
        F.when(kind == 0, F.concat_ws(" ", "club", "player"))
        .when(kind == 1, F.concat_ws(" ", F.lit("OTHER-XY"), "player"))
        .when(kind == 2, F.concat_ws(" ", F.lit("ROVERS-AB"), "player"))
        .when(kind == 3, F.col("player"))
        .when(kind == 4, F.lit("ROVERS-AB"))
        .otherwise(F.col("club"))
    )
    return given_scorers(t).select(
        "k",
        F.when(F.col("k") % 10 == 9, "-").otherwise(F.col("k").cast("string")).alias("position"),
        F.when(F.col("k") % 13 == 12, "n/a")
        .otherwise(F.col("total").cast("string"))
        .alias("goals"),
        raw.alias("raw_name"),
        F.when(kind.isin(0, 1, 5), F.concat(F.lit(" "), "club")).alias("title"),
        F.col("club").alias("club_cell"),
    )


@query(
    "scorer_split",
    SCORERS
    + """select k, k::int as position, total::int as goals,
      case k%6 when 0 then player when 1 then player when 2 then player when 3 then player
        when 4 then 'ROVERS-AB' else club end as player,
      case when k%6 in (2,4) then 'ROVERS-AB' else club end as club
    from given where k%10<>9 and k%13<>12""",
)
def scorer_split(t):
    return pages.split_scorers(raw_scorers(t))


@query(
    "scorer_dedup",
    MODEL
    + f"""select (src_suppkey%50)::int as position, venue as player, src_quantity::int as goals,
      city as club from raw
    qualify row_number() over (partition by src_suppkey%50, venue
      order by {RAW_ORDER}, order_key, line)=1""",
)
def scorer_dedup(t):
    rows = t.matches_raw.select(
        (F.col("src_suppkey") % 50).cast("int").alias("position"),
        F.col("venue").alias("player"),
        F.col("src_quantity").cast("int").alias("goals"),
        F.col("city").alias("club"),
        *b.SOURCE_ORDER,
        "order_key",
        "line",
    )
    return pages.dedup_scorers(rows, [*b.SOURCE_ORDER, "order_key", "line"])


@query(
    "scorers_from_pages",
    SCORERS
    + """select k::int as position, player, total::int as goals,
      case when k%2=0 then club else 'ROVERS-AB' end as club from given""",
)
def scorers_from_pages(t):
    tagged = F.when(
        F.col("k") % 2 == 0,
        F.concat(
            F.lit('<td><a href="/p">'),
            "player",
            F.lit("</a></td><td> "),
            F.col("total").cast("string"),
            F.lit('</td><td><img src="x" title="'),
            "club",
            F.lit('"></td>'),
        ),
    ).otherwise(
        F.concat(
            F.lit("<td>ROVERS-AB <b>"),
            "player",
            F.lit("</b></td><td>"),
            F.col("total").cast("string"),
            F.lit("</td><td></td>"),
        )
    )
    row = F.concat(F.lit("<tr><td>"), F.col("k").cast("string"), F.lit("</td>"), tagged)
    # Tag text joins its parts without a blank, so the raw name needs its own.
    html = F.concat(
        F.lit("<table><tr><th>#</th></tr>"), row, F.lit("<td>5</td></tr>"), row, F.lit("</tr></table>")
    )
    return pages.scorers_from_pages(given_scorers(t).select(F.col("k").alias("page_id"), html.alias("html")))


@query(
    "standings_from_pages",
    MODEL
    + """select position::varchar as position, team, points::varchar as points,
      games::varchar as games, wins::varchar as wins, ties::varchar as ties,
      losses::varchar as losses, goals_for::varchar as goals_for,
      goals_against::varchar as goals_against, goal_diff::varchar as goal_diff,
      yellow::varchar as yellow, red::varchar as red from standings""",
)
def standings_from_pages(t):
    listed = t.standings
    cells = [F.col(name).cast("string") for name in pages.STANDINGS_CELLS]
    html = F.concat(
        F.lit("<table><tr><th>a</th></tr><tr><td>x</td></tr></table>"),
        F.lit("<TABLE class='t'><tr><th>pos</th><th>team</th></tr><tr><td><strong>"),
        F.col("position").cast("string"),
        F.lit("</strong> <a href='/t'> "),
        "team",
        F.lit("</a></td>"),
        *[F.concat(F.lit("<td> "), cell, F.lit("</td>")) for cell in cells],
        F.lit("</tr><tr><td>total</td></tr></TABLE>"),
    )
    rows = pages.standings_from_pages(
        listed.select(F.col("position").alias("page_id"), html.alias("html"))
    )
    return rows.select("position", "team", *pages.STANDINGS_CELLS[:-1])


MATCH_OUT = ["match_id", "home", "away", "home_goals", "away_goals"]

WEB = (
    MODEL
    + """, numbered as (
      select (order_key*8+line)::varchar as match_id, order_key, line, home, away, home_goals,
        away_goals from firsts)
    """
)


def numbered(t):
    return b.number_ids(t.stored_first).select(*MATCH_OUT)


@query(
    "overlay_scores",
    WEB
    + """select match_id, home, away,
      case when order_key%3=0 then (order_key%4)::varchar else home_goals end as home_goals,
      case when order_key%3=0 then line::varchar else away_goals end as away_goals from numbered""",
)
def overlay_scores(t):
    return overlay.overlay_scores(numbered(t), overlay.scores_of_blocks(b.score_blocks(t)))


def unmatched(t):
    blocks = b.score_blocks(t).withColumn("id_text", F.concat(F.lit("9"), "id_text"))
    return overlay.scores_of_blocks(blocks)


def link_scores(t):
    links = b.score_links(t)
    ids = tx.link_id(F.col("href"), "/games/league/")
    return overlay.scores_of_blocks(links.select(ids.alias("id_text"), "seq", "text"))


@query(
    "overlay_tiers",
    WEB
    + """select match_id, home, away,
      case when order_key%3=1 then (order_key%6)::varchar else home_goals end as home_goals,
      case when order_key%3=1 then line::varchar else away_goals end as away_goals from numbered""",
)
def overlay_tiers(t):
    return overlay.overlay_tiers(numbered(t), unmatched(t), link_scores(t), b.score_texts(t))


@query(
    "overlay_audit",
    WEB
    + """select count(*)::bigint as matches, count(home_goals)::bigint as known_before,
      count(case when order_key%3=0 then '1' else home_goals end)::bigint as known_after,
      count(*) filter (order_key%3=0 and (home_goals is distinct from (order_key%4)::varchar
        or away_goals is distinct from line::varchar)) as changed from numbered""",
)
def overlay_audit(t):
    before = numbered(t)
    after = overlay.overlay_scores(before, overlay.scores_of_blocks(b.score_blocks(t)))
    return overlay.overlay_audit(before, after)


def score_pages(t, keys, *block):
    """A page per order, with a block of markup for each of its matches."""
    blocks = t.stored_first.filter(keys).select(
        F.col("order_key").alias("page_id"), "line", F.concat(*block).alias("block")
    )
    listed = F.array_join(F.array_sort(F.collect_list(F.struct("line", "block")))["block"], "<hr>")
    html = F.concat(F.lit("<body><ul class='games'>"), listed, F.lit("</ul><p>9 x 9</body>"))
    return blocks.groupBy("page_id").agg(html.alias("html"))


def padded_id():
    return F.lpad((F.col("order_key") * 8 + F.col("line")).cast("string"), 14, "0")


@query(
    "overlay_page_blocks",
    WEB
    + """select match_id, home, away,
      case when order_key%3=0 then (order_key%4)::varchar else home_goals end as home_goals,
      case when order_key%3=0 then line::varchar else away_goals end as away_goals from numbered""",
)
def overlay_page_blocks(t):
    """Scores in elements that carry an id: the last one of an id counts."""
    found = score_pages(
        t,
        F.col("order_key") % 3 == 0,
        F.lit("<div data-game='"),
        padded_id(),
        F.lit("'>"),
        "line",
        F.lit(" x 0</div><div id=a data-game="),
        padded_id(),
        F.lit("><div>Final <b>"),
        (F.col("order_key") % 4).cast("string"),
        F.lit("</b></div><br/> X <i>"),
        "line",
        F.lit("</i></div><div data-game='"),
        padded_id(),
        F.lit("'>postponed</div>"),
    )
    blocks = pages.marked_blocks(found, "data-game")
    return overlay.overlay_scores(numbered(t), overlay.scores_of_blocks(blocks))


@query(
    "overlay_page_links",
    WEB
    + """select match_id, home, away,
      case when order_key%3=1 then (order_key%6)::varchar else home_goals end as home_goals,
      case when order_key%3=1 then line::varchar else away_goals end as away_goals from numbered""",
)
def overlay_page_links(t):
    """Scores in the text around links to games: not those further out, nor in comments."""
    link = F.concat(F.lit("<a href='/games/league/"), padded_id(), F.lit("?tab=1'><b>game</b></a>"))
    found = score_pages(
        t,
        F.col("order_key") % 3 == 1,
        F.lit("<li>8 x 8 <em>"),
        link,
        F.lit("</em><span>"),
        link,
        F.lit(" 0 x 7</span><!-- "),
        link,
        F.lit(" 6 x 6 --><p>Final "),
        link,
        F.lit("<br> "),
        (F.col("order_key") % 6).cast("string"),
        F.lit("x<b>"),
        "line",
        F.lit("</b>"),
    )
    scores = overlay.scores_of_links(pages.link_parents(found, "/games/league/"), "/games/league/")
    return overlay.overlay_tiers(numbered(t), unmatched(t), scores)


TEXTS = (
    MODEL
    + r""", texts as materialized (select min(page_id) as page_id, text, lower(text) as low from (
      select order_key*8+line as page_id, home||' '||home_goals||' x '||away_goals||' '||away||
        '. Return: '||lower(away)||' '||away_goals||' X '||home_goals||' '||home as text
      from firsts where home_goals is not null) group by text),
    fixtures as (
      select (order_key*8+line)::varchar as match_id, home, away, home_goals, away_goals,
        lower(split_part(home,' ',1)) as hw, lower(split_part(away,' ',1)) as aw from firsts),
    pairs as (select distinct hw, aw, '(?i)'||hw||'[^0-9]{0,40}(\d+)\s*[xX]\s*(\d+)[^0-9]{0,40}'||aw
      as pattern from fixtures where home_goals is null),
    near as materialized (select * from texts join pairs on contains(low, hw)
      and contains(low, aw)),
    hits as (select hw, aw, arg_min(text, page_id) as text, any_value(pattern) as pattern
      from near where regexp_matches(text, pattern) group by hw, aw),
    found as (select hw, aw, regexp_extract(text, pattern, 1) as h,
      regexp_extract(text, pattern, 2) as a from hits)
    select match_id, home, away, case when home_goals is null then h else home_goals end as home_goals,
      case when home_goals is null then a else away_goals end as away_goals
    from fixtures f left join found x on f.hw=x.hw and f.aw=x.aw"""
)


@query("overlay_text_match", TEXTS)
def overlay_text_match(t):
    return overlay.overlay_text(numbered(t), b.score_texts(t))


@query("overlay_tiers_text", TEXTS)
def overlay_tiers_text(t):
    return overlay.overlay_tiers(numbered(t), unmatched(t), unmatched(t), b.score_texts(t))
