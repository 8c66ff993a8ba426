"""Rows out of web pages held as a table, one page per row.

All work on a page stays inside its row, as array expressions, until the rows of its
table are exploded; no page is shuffled.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standwise.functions.markup import (
    HIDDEN,
    TAG,
    around,
    between,
    bound,
    cut_elements,
    interleaved,
    spans,
)
from standwise.functions.numbers import strip
from standwise.functions.text import (
    blank_to_null,
    first_match,
    leading_number,
    scorer,
    strip_digits,
    tag_text,
    unescape,
)
from standwise.operators.keyed import keep_first

# The elements of a table, and markup looked for in a cell.
TABLE, ROW, CELL = "table", "tr", "td"
HEADER = r"(?is)<th\b[^>]*>"
LINK = r"(?is)<a\b[^>]*>(.*?)</a>"
STRONG = r"(?is)<strong\b[^>]*>(.*?)</strong>"
# A value in double quotes, in single quotes, or bare.
VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
IMAGE_TITLE = rf"(?is)<img\b[^>]*?\btitle\s*=\s*{VALUE}"
HREF = rf"(?is)<a\b[^>]*?\bhref\s*=\s*{VALUE}"

# What the cells of a standings row after the team cell hold.
STANDINGS_CELLS = [
    "points",
    "games",
    "wins",
    "ties",
    "losses",
    "goals_for",
    "goals_against",
    "goal_diff",
    "yellow",
    "red",
    "points_pct",
]


def pieces(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def elements(html: Column, tag: str) -> Column:
    """What stands between the tags of every element of a kind, in order of their openings.

    Elements within elements of the same kind count too; one that is never closed ends
    where the next one opens, or at the end. Tags are paired only where they do not simply
    alternate.
    """
    mark = rf"(?i)</?{tag}\b[^>]*>"
    closing = lambda t: F.startswith(t, F.lit("</"))

    def found(tags: Column) -> Column:
        simple = F.forall(
            F.transform(tags, lambda t, at: closing(t) == (at % 2 == 1)), lambda ok: ok
        ) & (F.size(tags) % 2 == 0)
        steps = F.transform(
            tags,
            lambda t: F.struct(F.lit(tag).alias("name"), F.when(closing(t), -1).otherwise(1).alias("step")),
        )
        nested = bound(
            interleaved(F.split(html, mark), tags),
            lambda both: F.transform(spans(steps), lambda span: between(both, span)),
        )
        plain = pieces(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\b[^>]*>")
        return F.when(simple, plain).otherwise(nested)

    return F.when(html.isNotNull(), bound(pieces(html, mark, 0), found))


def parts_of(html: Column, what: str) -> Column:
    """Elements of a kind, where ``what`` is its name, else the first groups of a pattern."""
    return elements(html, what) if what.isalnum() else pieces(html, what)


def attribute(text: Column) -> Column:
    """An attribute's value without its quotes, character references resolved."""
    return unescape(F.regexp_replace(text, r"""^["']|["']$""", ""))


def widest_container(
    pages: DataFrame, container: str = TABLE, header: str = HEADER
) -> DataFrame:
    """Per page the container with most headers, the first among equals."""
    scored = F.transform(
        parts_of(F.col("html"), container),
        lambda body, at: F.struct(
            F.size(pieces(body, header, 0)).alias("width"),
            (-at).alias("minus_at"),
            body.alias("body"),
        ),
    )
    return (
        pages.select("page_id", F.array_max(scored).alias("best"))
        .filter(F.col("best").isNotNull())
        .select(
            "page_id",
            (-F.col("best.minus_at")).alias("container_at"),
            F.col("best.width").alias("width"),
            F.col("best.body").alias("body"),
        )
    )


def container_rows(
    bodies: DataFrame, keep: Sequence[str], row: str = ROW, cell: str = CELL
) -> DataFrame:
    """The rows of each container, in order, as arrays of cell markup."""
    rows = bodies.select(*keep, F.posexplode(parts_of(F.col("body"), row)).alias("row_at", "row"))
    return rows.select(*keep, "row_at", parts_of(F.col("row"), cell).alias("cells"))


def rows_min_cells(rows: DataFrame, n: int) -> DataFrame:
    return rows.filter(F.size("cells") >= n)


def rows_exact_cells(rows: DataFrame, n: int) -> DataFrame:
    return rows.filter(F.size("cells") == n)


def has(html: Column, pattern: str) -> Column:
    return html.rlike(pattern)


def link_text(html: Column) -> Column:
    """Text of the first link in a cell."""
    return tag_text(F.regexp_extract(html, LINK, 1))


def cell_text(html: Column) -> Column:
    """Text of a cell; the text of a link in it goes first."""
    return F.when(has(html, LINK), link_text(html)).otherwise(tag_text(html))


def team_name(html: Column) -> Column:
    plain = strip_digits(tag_text(html, " "))
    return F.when(has(html, LINK), link_text(html)).otherwise(plain)


def team_position(html: Column) -> Column:
    """Digits of the emphasised part of a cell, else those its text starts with."""
    emphasised = first_match(tag_text(F.regexp_extract(html, STRONG, 1)), r"(?U)(\d+)")
    bare = unescape(F.regexp_replace(html, r"<[^>]*>", ""))
    return F.when(has(html, STRONG), F.coalesce(emphasised, F.lit(""))).otherwise(
        strip(leading_number(bare))
    )


def named_teams(rows: DataFrame) -> DataFrame:
    """Rows whose team name has more than one character."""
    return rows.filter(F.length("team") > 1)


def standings_from_pages(pages: DataFrame, min_cells: int = 12) -> DataFrame:
    """All-text standings rows from the widest table of each page."""
    rows = rows_min_cells(container_rows(widest_container(pages), ["page_id"]), min_cells)
    first = F.get("cells", F.lit(0))
    values = [
        tag_text(F.get("cells", F.lit(at))).alias(name)
        for at, name in enumerate(STANDINGS_CELLS, start=1)
    ]
    return named_teams(
        rows.select(
            "page_id",
            "row_at",
            team_position(first).alias("position"),
            team_name(first).alias("team"),
            *values,
        )
    )


def numeric_rows(rows: DataFrame) -> DataFrame:
    """Rows whose position and goals are nothing but digits."""
    digits = r"(?U)^\d+$"
    return rows.filter(F.col("position").rlike(digits) & F.col("goals").rlike(digits))


def split_scorers(rows: DataFrame) -> DataFrame:
    """Typed scorers from (position, goals, raw_name, title, club_cell) texts."""
    split = scorer(F.col("raw_name"), F.col("title"), F.col("club_cell"))
    rest = [
        c
        for c in rows.columns
        if c not in ("position", "goals", "raw_name", "title", "club_cell")
    ]
    return (
        numeric_rows(rows)
        .withColumn("split", split)
        .select(
            *rest,
            F.col("position").try_cast("int").alias("position"),
            F.col("split.player").alias("player"),
            F.col("goals").try_cast("int").alias("goals"),
            F.col("split.club").alias("club"),
        )
    )


def dedup_scorers(scorers: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row per position and player, by ``order``; sorted by position."""
    first = keep_first(scorers, ["position", "player"], order)
    return first.select("position", "player", "goals", "club").orderBy("position", "player")


def scorers_from_pages(pages: DataFrame, cells: int = 5) -> DataFrame:
    """Scorers from every table row of exactly ``cells`` cells, without repeats."""
    tables = pages.select(
        "page_id", F.posexplode(elements(F.col("html"), TABLE)).alias("table_at", "body")
    )
    rows = rows_exact_cells(container_rows(tables, ["page_id", "table_at"]), cells)

    def cell(at: int) -> Column:
        return F.get("cells", F.lit(at))

    texts = rows.select(
        "page_id",
        "table_at",
        "row_at",
        tag_text(cell(0)).alias("position"),
        tag_text(cell(2)).alias("goals"),
        cell_text(cell(1)).alias("raw_name"),
        attribute(first_match(cell(3), IMAGE_TITLE)).alias("title"),
        tag_text(cell(3)).alias("club_cell"),
    )
    return dedup_scorers(split_scorers(texts), ["page_id", "table_at", "row_at"])


def preferred_link(
    pages: DataFrame, suffix: str = ".pdf", prefer: str = "tabela", base: str = ""
) -> DataFrame:
    """Per page the first link that ends in ``suffix``, one holding ``prefer`` first."""
    values = F.transform(pieces(F.col("html"), HREF), lambda href: attribute(href))
    links = F.filter(values, lambda href: href.endswith(suffix))
    preferred = F.filter(links, lambda href: F.contains(F.lower(href), F.lit(prefer)))
    chosen = F.coalesce(F.get(preferred, F.lit(0)), F.get(links, F.lit(0)))
    absolute = F.when(F.col("href").startswith("/"), F.concat(F.lit(base), "href"))
    return (
        pages.select("page_id", chosen.alias("href"))
        .filter(F.col("href").isNotNull())
        .select("page_id", absolute.otherwise(F.col("href")).alias("href"))
    )


def page_text(pages: DataFrame) -> DataFrame:
    """Visible text of each page."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    return pages.select("page_id", unescape(F.regexp_replace(bare, r"<[^>]*>", " ")).alias("text"))


def _marked_up(pages: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """(page_id, plain, tags, wanted): a page without what is no markup, its tags, and what is
    wanted of them; pages without any are left out."""

    def of_tags(plain: Column) -> Column:
        return bound(
            pieces(plain, TAG, 0),
            lambda tags: F.struct(
                plain.alias("plain"), tags.alias("tags"), wanted(tags).alias("wanted")
            ),
        )

    whole = bound(F.regexp_replace("html", HIDDEN, " "), of_tags)
    cut = pages.where("html is not null").select("page_id", F.explode(F.array(whole)).alias("page"))
    return cut.select("page_id", "page.*").where(F.size("wanted") > 0)


def shown(inside: Column) -> Column:
    """Visible text of a piece of markup."""
    return blank_to_null(tag_text(inside, " "))


def marked_blocks(pages: DataFrame, name: str) -> DataFrame:
    """(page_id, seq, id_text, text) of the elements that carry an attribute, in order: its
    value and the element's visible text."""
    value = rf"(?is)\s{name}\s*=\s*{VALUE}"

    def marked(tags: Column) -> Column:
        every = F.transform(tags, lambda t, at: F.struct(at.alias("at"), t.alias("tag")))
        return F.filter(every, lambda t: has(t["tag"], value))

    def pick(openings: list[int], ends: list[int], wanted: list[int]):
        numbers = {at: n for n, at in enumerate(wanted)}
        for opening, end in zip(openings, ends):
            if opening in numbers:
                yield opening, end, [numbers[opening]]

    blocks = _texts(cut_elements(_marked_up(pages, marked), pick))
    tag = F.get("wanted", F.lit(0))["tag"]
    return blocks.select(
        "page_id", "seq", attribute(first_match(tag, value)).alias("id_text"), "text"
    )


def _texts(elements: DataFrame) -> DataFrame:
    """Elements with their visible text.  A generator stands between it and what follows: a
    filter on what is read from the text would work it out again."""
    made = F.struct("seq", "wanted", shown(F.col("inside")).alias("text"))
    return elements.select("page_id", F.explode(F.array(made)).alias("made")).select("page_id", "made.*")


def link_parents(pages: DataFrame, href: str) -> DataFrame:
    """(page_id, links, text): every element that directly holds links whose address matches
    a pattern, with these links as (seq, href) and its visible text.

    The element around a link is the innermost one that is open there; outside all elements
    it is the whole page. A text is worked out once, however many links stand in it.
    """

    def linked(tags: Column) -> Column:
        # Addresses are unescaped only where there are any.
        every = F.transform(
            tags,
            lambda t, at: F.struct(at.alias("seq"), F.regexp_extract(t, HREF, 1).alias("href")),
        )
        links = F.transform(
            F.filter(every, lambda link: link["href"] != ""),
            lambda link: F.struct(link["seq"].alias("seq"), attribute(link["href"]).alias("href")),
        )
        return F.filter(links, lambda link: link["href"].rlike(href))

    def pick(openings: list[int], ends: list[int], wanted: list[int]):
        parents: dict[tuple[int, int], list[int]] = {}
        for n, element in enumerate(around(openings, ends, wanted)):
            parents.setdefault(element, []).append(n)
        return ((*element, numbers) for element, numbers in parents.items())

    parents = _texts(cut_elements(_marked_up(pages, linked), pick))
    return parents.select("page_id", F.col("wanted").alias("links"), "text")


def scores_from_pages(
    pages: DataFrame, block: str, id_pattern: str
) -> DataFrame:
    """Blocks of markup with the id found by ``id_pattern`` and their visible text."""
    blocks = pages.select(
        "page_id", F.posexplode(pieces(F.col("html"), block, 0)).alias("seq", "block")
    )
    return blocks.select(
        "page_id",
        "seq",
        unescape(first_match(F.col("block"), id_pattern)).alias("id_text"),
        blank_to_null(tag_text(F.col("block"), " ")).alias("text"),
    )
