"""Line dedup by frequency within a site: lines on too large a share of a host's pages go.

Only built-in functions run here. Each page counts a line once; counts per host and line are
summed before the shuffle. The lines to drop are then gathered per host: their number is at
most the host's mean number of lines per page divided by the ratio, whatever the number of
pages. Pages meet them on host and a salt, so a host with a third of all pages is spread.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64

# What stands in these elements is not text; then block elements part lines.
NOT_TEXT = r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|<!--.*?-->"
BLOCKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|div|dd|dl|dt|footer|form|h[1-6]|head"
    r"|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)"
    r"(?:[\s/][^>]*)?>"
)
TAGS = r"<[!/]?[A-Za-z][^>]*>"
# The same for Java's search, which tries alternatives one by one: each has its first letters once.
NOT_TEXT_PARTED = r"(?is)<(?:(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|!--.*?-->)"
BLOCKS_PARTED = (
    r"(?i)</?(?:a(?:ddress|rticle|side)|b(?:lockquote|ody|r)|d(?:[dlt]|iv)|f(?:ooter|orm)"
    r"|h(?:[1-6r]|ead(?:er)?|tml)|li|main|nav|ol|p(?:re)?|section"
    r"|t(?:able|body|[dr]|foot|h(?:ead)?|itle)|ul)(?:[\s/][^>]*)?>"
)
# White space in a line, unless it is one blank already: most of it is.
WHITE = r"[ \t\r\x0B\f](?:(?<! )|(?=[ \t\r\x0B\f]))[ \t\r\x0B\f]*"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """The host of an address in lower case; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Lines of text of a page: markup gone, white space single, no empty lines."""
    text = F.regexp_replace(html, NOT_TEXT_PARTED, "\n")
    text = F.regexp_replace(text, BLOCKS_PARTED, "\n")
    text = F.regexp_replace(text, TAGS, "")
    text = F.regexp_replace(text, WHITE, " ")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda line: line != "")


def text_lines(text: Column) -> Column:
    """Lines of a plain text as they stand."""
    return F.split(text, "\n")


def boilerplate(
    pages: DataFrame, ratio: float, least_pages: int, copies_once: bool = False
) -> DataFrame:
    """(host, drop): hashes of the lines on more than ``ratio`` of a host's pages.

    With ``copies_once`` pages of one host with equal lines count as one page.
    """
    once = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(F.trim(x))))
    pages = pages.select("host", once.alias("once"), F.xxhash64("lines").alias("whole"))
    if copies_once:
        pages = pages.groupBy("host", "whole").agg(F.first("once").alias("once"))
    lines = pages.select("host", F.explode("once").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_with"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    often = counts.where(F.col("n_with") >= least_pages).join(totals, "host")
    often = often.where(F.col("n_with") > F.lit(ratio) * F.col("n_pages"))
    return often.groupBy("host").agg(F.collect_set("line").alias("drop"))


def drop_lines(
    pages: DataFrame,
    ratio: float,
    least_pages: int = 3,
    whole_above: float = 1.0,
    copies_once: bool = False,
) -> DataFrame:
    """The rows of ``pages`` with (kept, n_lines, n_dropped) added.

    ``pages`` holds ``host`` and ``lines`` and may hold more. A line, without blanks around
    it, is dropped if it stands on more than ``ratio`` of its host's pages and on
    ``least_pages`` at least; blank lines stay. A page counts a repeated line once, but loses
    all of its copies. A page that would lose all its lines, or more than ``whole_above`` of
    its characters, is itself a copied page and stays whole. With ``copies_once`` pages of
    one host with equal lines count as one, so copies alone make no line frequent. Without host or lines a row
    stays as it is; null lines count as none. Repeated rows stay repeated.
    """
    drops = boilerplate(pages.where("host is not null"), ratio, least_pages, copies_once)
    salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    drops = drops.select(F.col("host").alias("drop_host"), "drop", F.explode(salt).alias("drop_salt"))
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("lines"), F.lit(SALTS)).cast("int"))
    joined = salted.join(
        drops, (F.col("host") == F.col("drop_host")) & (F.col("salt") == F.col("drop_salt")), "left"
    )
    some = joined.withColumn(
        "rest",
        F.filter(
            "lines",
            lambda x: (F.trim(x) == "") | ~F.array_contains("drop", F.xxhash64(F.trim(x))),
        ),
    )
    chars = lambda lines: F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x))
    left = F.exists("rest", lambda x: F.trim(x) != "")
    lost = chars("lines") - chars("rest")
    fits = F.col("drop").isNotNull() & left & (lost <= F.lit(whole_above) * chars("lines"))
    kept = F.when(fits, F.col("rest")).otherwise(F.col("lines"))
    out = some.withColumn("kept", kept).drop("rest", "drop", "drop_host", "drop_salt", "salt")
    size = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long")
    return out.withColumn("n_lines", size("lines")).withColumn(
        "n_dropped", size("lines") - size("kept")
    )


def dedup_pages(
    df: DataFrame,
    ratio: float = 0.1,
    least_pages: int = 3,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, host, text, n_lines, n_dropped) for every page, with its lines of text."""
    pages = df.select(
        F.col(f"`{id_col}`").alias("id"),
        host_of(F.col(f"`{url_col}`")).alias("host"),
        html_lines(F.coalesce(F.col(f"`{html_col}`"), F.lit(""))).alias("lines"),
    )
    out = drop_lines(pages, ratio, least_pages)
    return out.select(
        F.col("id").alias(id_col),
        "host",
        F.array_join("kept", "\n").alias("text"),
        "n_lines",
        "n_dropped",
    )


def dedup_texts(
    df: DataFrame,
    ratio: float = 0.1,
    least_pages: int = 3,
    whole_above: float = 0.5,
    host_col: str = "source",
    text_col: str = "text",
    copies_once: bool = False,
) -> DataFrame:
    """The rows of a table of plain texts, all columns kept, frequent lines cut out of them.

    Hosts are the values of ``host_col``. Null texts stay null.
    """
    rows = df.select(
        F.struct("*").alias("row"),
        F.col(f"`{host_col}`").cast("string").alias("host"),
        text_lines(F.col(f"`{text_col}`")).alias("lines"),
    )
    out = drop_lines(rows, ratio, least_pages, whole_above, copies_once)
    text = F.when(F.col("n_dropped") > 0, F.array_join("kept", "\n")).otherwise(
        F.col("row").getField(text_col)
    )
    return out.withColumn("row", F.col("row").withField(f"`{text_col}`", text)).select("row.*")
