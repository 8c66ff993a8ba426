"""Filling in scores found elsewhere: by match id, or by team names in page text."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standwise.functions.text import first_word, link_id, score_in_text, strip_zeros
from standwise.operators.keyed import keep_last
from standwise.sources.staging import stage

GOALS = ["home_goals", "away_goals"]

# Fixed value: how many characters may stand between a team and a score.
REACH = 40

# Parts a pair of names is spread over when it is joined to the scores near it.
SALTS = 16

# Pairs with a score that may be broadcast, some dozens of bytes each.
BROADCAST_PAIRS = 200_000

# Letters of a word that are looked up before words are cut out of a text, and places of the
# table they are looked up in.
LETTERS = 3
PLACES = 4096

# A whole number, a cross, and the start of another number.
SCORE_START = r"(?U)(?<!\d)(\d+)\s*[xX]\s*(?=\d)"


def scores_of_blocks(blocks: DataFrame) -> DataFrame:
    """Scores by id from (seq, id_text, text) blocks; ids lose their leading zeros.

    Blocks of several pages have a ``page_id``, which comes before ``seq`` in their order.
    """
    home, away = score_in_text(F.col("text"))
    ids = strip_zeros(F.trim("id_text"))
    return blocks.select(
        ids.alias("match_id"),
        *_order(blocks),
        home.alias("home_goals"),
        away.alias("away_goals"),
    ).filter(F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull())


def scores_of_links(parents: DataFrame, folder: str) -> DataFrame:
    """Scores by the id in a link's address, from the text of the element around the link.

    ``parents`` hold (page_id, links, text); ids lose their leading zeros.
    """
    home, away = score_in_text(F.col("text"))
    scored = parents.select(
        "page_id", "links", home.alias("home_goals"), away.alias("away_goals")
    ).filter(F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull())
    links = scored.select("page_id", F.explode("links").alias("link"), *GOALS)
    ids = link_id(F.col("link.href"), folder)
    return links.select(
        ids.alias("match_id"), "page_id", F.col("link.seq").alias("seq"), *GOALS
    ).filter(F.col("match_id").isNotNull())


def _order(scores: DataFrame) -> list[str]:
    return [c for c in ("page_id", "seq") if c in scores.columns]


def last_scores(scores: DataFrame) -> DataFrame:
    """The last score of each id by page, if known, and ``seq``."""
    last = keep_last(scores, ["match_id"], [*_order(scores), *GOALS])
    return last.select("match_id", *[F.col(c).alias(f"new_{c}") for c in GOALS])


def _replace_goals(joined: DataFrame, columns: list[str]) -> DataFrame:
    goals = {c: F.coalesce(F.col(f"new_{c}"), F.col(c)) for c in GOALS}
    return joined.withColumns(goals).select(*columns)


def overlay_scores(matches: DataFrame, scores: DataFrame) -> DataFrame:
    """Matches with the goals of the last score of the same id, where there is one."""
    return _with_last(matches, last_scores(scores))


def _with_last(matches: DataFrame, last: DataFrame) -> DataFrame:
    return _replace_goals(matches.join(last, "match_id", "left"), matches.columns)


def has_overlap(matches: DataFrame, scores: DataFrame) -> bool:
    """Whether any score belongs to a match; stops at the first hit."""
    return not matches.join(scores, "match_id", "left_semi").isEmpty()


def score_hits(texts: DataFrame, reach: Column) -> DataFrame:
    """Each score in (page_id, text) rows with up to ``reach`` characters on either side.

    The text is cut at the scores; a piece after a score starts with the away goals. As
    many pieces are put together again on each side as ``reach`` characters can span, so a
    name may itself hold scores.
    """
    number = r"(?U)^\d+"
    parts = F.split("text", SCORE_START)
    starts = F.regexp_extract_all("text", F.lit(SCORE_START), F.lit(0))
    cut = texts.select("page_id", parts.alias("parts"), starts.alias("starts"), reach.alias("reach"))
    # Part, start, part, start, ...: a score's start stands at an odd place.
    both = F.flatten(
        F.transform("parts", lambda part, at: F.array(part, F.coalesce(F.get("starts", at), F.lit(""))))
    )
    cut = cut.withColumn("whole", both)
    # A score and the piece before it hold two characters at least.
    span = F.col("reach") + 2

    def surroundings(start: Column, at: Column) -> Column:
        first = F.greatest(F.lit(0), at * 2 + 1 - span)
        near = lambda x: F.right(x, F.col("reach"))
        before = F.transform(F.slice("whole", first + 1, at * 2 + 1 - first), near)
        after = F.transform(F.slice("whole", at * 2 + 3, span), lambda x: F.left(x, F.col("reach") + 20))
        return F.struct(
            start.alias("start"),
            F.right(F.array_join(before, ""), F.col("reach")).alias("before"),
            F.array_join(after, "").alias("after"),
        )

    # The pieces are put together inside the page's row, so that exploding its scores
    # does not repeat the page for each of them.
    hits = cut.select(
        "page_id", "reach", F.posexplode(F.transform("starts", surroundings)).alias("at", "hit")
    )
    after = F.col("hit.after")
    return hits.select(
        "page_id",
        "at",
        F.regexp_extract("hit.start", number, 0).alias("home_goals"),
        F.regexp_extract(after, number, 0).alias("away_goals"),
        F.lower("hit.before").alias("left"),
        F.lower(F.left(F.regexp_replace(after, number, ""), F.col("reach"))).alias("right"),
    )


def _lengths(words: DataFrame, column: str) -> Column:
    """The distinct lengths of the words, one short array."""
    return words.agg(F.collect_set(F.length(column))).scalar()


def _letters(words: DataFrame, column: str, cut: Callable) -> tuple[Column, Callable]:
    """How many letters are looked up, and whether some letters may be those of a word.

    ``cut`` takes the letters from an end of the word.  Their hashes are marked in a table of
    a fixed size, so a place in a text that no word can stand at is told before it is cut.
    """
    size = words.agg(F.least(F.lit(LETTERS), F.min(F.length(column)))).scalar()

    def place(letters: Column) -> Column:
        return F.pmod(F.hash(letters), F.lit(PLACES))

    used = words.select(place(cut(F.col(column), size)).alias("used"))
    every = F.sequence(F.lit(0), F.lit(PLACES - 1))
    marked = used.agg(F.collect_set("used").alias("used")).select(
        F.transform(every, lambda i: F.array_contains("used", i))
    )
    table = marked.scalar()
    return size, lambda letters: F.get(table, place(letters))


def _words_before(hits: DataFrame, pairs: DataFrame) -> DataFrame:
    """(page_id, at, home_word): texts of known lengths that end at most ``REACH``
    non-digits before a score, where the last letters are those of a word."""
    left, n, skip = F.col("left"), F.col("n"), F.col("skip")
    size, known = _letters(pairs, "home_word", F.right)
    gap = F.length(F.regexp_extract(F.right(left, F.lit(REACH)), r"[^0-9]*$", 0))
    skips = F.sequence(F.lit(0), F.least(gap, F.length(left) - 1))
    return (
        hits.filter(F.length(left) > 0)
        .select("page_id", "at", "left", "home_lengths", F.explode(skips).alias("skip"))
        .filter(known(F.substring(left, F.length(left) - skip - size + 1, size)))
        .withColumn("n", F.explode("home_lengths"))
        .filter(n + skip <= F.length(left))
        .select("page_id", "at", F.substring(left, F.length(left) - skip - n + 1, n).alias("home_word"))
    )


def _words_after(hits: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per text of a known length starting at most ``REACH`` non-digits after a score,
    where the first letters are those of a word."""
    right, n, skip = F.col("right"), F.col("n"), F.col("skip")
    size, known = _letters(pairs, "away_word", F.left)
    gap = F.length(F.regexp_extract(right, rf"^[^0-9]{{0,{REACH}}}", 0))
    return (
        hits.withColumn("skip", F.explode(F.sequence(F.lit(0), gap)))
        .filter(known(F.substring(right, skip + 1, size)))
        .withColumn("n", F.explode("away_lengths"))
        .withColumn("away_word", F.substring(right, skip + 1, n))
        .drop("left", "right", "home_lengths", "away_lengths", "n", "skip")
    )


def _spread(df: DataFrame) -> DataFrame:
    """Every row once for each salt."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def pair_scores(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """First score in the texts for each (home_word, away_word), in lower case.

    A score counts for a pair when the home word ends shortly before it and the away word
    starts shortly after it, with no digit in between.  The candidate words around each
    score are joined to the wanted words by equality, home words first, and only scores
    with a home word go on to be joined by both.  Words that stand near a large share of
    all scores are spread by a salt.  The numbers of a score are taken whole: a word never
    ends or starts inside one.
    """
    longest = F.greatest(F.max(F.length("home_word")), F.max(F.length("away_word")))
    reach = pairs.agg((F.coalesce(longest, F.lit(0)) + REACH).alias("reach")).scalar()
    # Two joins read them, with the page text worked through once.
    hits = stage(
        score_hits(texts, reach).withColumns(
            {
                "home_lengths": _lengths(pairs, "home_word"),
                "away_lengths": _lengths(pairs, "away_word"),
            }
        )
    )
    salt = F.pmod(F.hash("page_id", "at"), F.lit(SALTS))
    homes = _spread(pairs.select("home_word").distinct())
    before = _words_before(hits, pairs).withColumn("salt", salt).join(homes, ["home_word", "salt"])
    near_home = hits.join(before.distinct(), ["page_id", "at"])
    near_both = _words_after(near_home, pairs).join(_spread(pairs), ["home_word", "away_word", "salt"])

    place = F.struct("page_id", "at")
    per_salt = near_both.groupBy("home_word", "away_word", "salt").agg(
        F.min_by(F.struct(*GOALS), place).alias("score"), F.min(place).alias("place")
    )
    return (
        per_salt.groupBy("home_word", "away_word")
        .agg(F.min_by("score", "place").alias("score"))
        .select(
            "home_word",
            "away_word",
            F.col("score.home_goals").alias("new_home_goals"),
            F.col("score.away_goals").alias("new_away_goals"),
        )
    )


def overlay_text(matches: DataFrame, texts: DataFrame) -> DataFrame:
    """Matches without home goals get the first score between their team names."""
    named = matches.withColumns(
        {
            "home_word": F.lower(first_word(F.col("home"))),
            "away_word": F.lower(first_word(F.col("away"))),
        }
    )
    open_pairs = (
        named.filter(F.col("home_goals").isNull()).select("home_word", "away_word").distinct()
    )
    # The pairs are few and used several times, so they are worked out once.
    found = pair_scores(texts, stage(open_pairs.dropna()))
    found = stage(found)
    # A pair may be that of many matches: few pairs are broadcast, many are spread.
    if found.count() <= BROADCAST_PAIRS:
        joined = named.join(F.broadcast(found), ["home_word", "away_word"], "left")
    else:
        salted = named.withColumn("salt", F.pmod(F.hash("match_id"), F.lit(SALTS)))
        joined = salted.join(_spread(found), ["home_word", "away_word", "salt"], "left")
    unknown = F.col("home_goals").isNull()
    only_open = {f"new_{c}": F.when(unknown, F.col(f"new_{c}")) for c in GOALS}
    return _replace_goals(joined.withColumns(only_open), matches.columns)


def overlay_tiers(
    matches: DataFrame,
    by_id: DataFrame | None = None,
    by_link: DataFrame | None = None,
    texts: DataFrame | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Scores by id; if those touch no match, scores by link; failing both, by page text.

    A tier that is not given touches no match. Which tier applies is settled by a look for
    the first overlap, so the page texts are read only when they are needed. What a tier
    found is written once, for that look and for the overlay: it may be read from pages.
    ``ids`` are rows with the ids of the matches, for that look, where these are not stored.
    """
    for scores in (by_id, by_link):
        if scores is not None:
            last = stage(last_scores(scores))
            if has_overlap(matches if ids is None else ids, last):
                return _with_last(matches, last)
    return matches if texts is None else overlay_text(matches, texts)


def overlay_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: matches, scores known before and after, matches whose goals changed.

    Ids may repeat; an id counts as changed when any of its goals differ.
    """

    def goals(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("match_id").agg(
            F.count("*").alias(f"{prefix}_rows"),
            F.count("home_goals").alias(f"{prefix}_known"),
            F.max(F.struct(*GOALS)).alias(f"{prefix}_goals"),
        )

    both = goals(before, "old").join(goals(after, "new"), "match_id")
    changed = ~F.col("old_goals").eqNullSafe(F.col("new_goals"))
    return both.agg(
        F.sum("new_rows").alias("matches"),
        F.sum("old_known").alias("known_before"),
        F.sum("new_known").alias("known_after"),
        F.count_if(changed).alias("changed"),
    )
