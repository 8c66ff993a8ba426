"""Pieces of text work used when reading pages and document rows.

Patterns carry ``(?U)`` so that whitespace and digits of every script count, and a
missing match is null, not an empty string.
"""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from standwise.functions.numbers import strip

TAG = r"<[^>]*>"

# The forms of a played and an unplayed game, of a score in free text, of the
# number a team cell may start with, and of a scorer's club in front of the name.
PLAYED = r"(?U)^(.+?)\s+(\d+)\s+x\s+(\d+)\s+(.+)$"
UNPLAYED = r"(?U)^(.+?)\s+x\s+(.+)$"
SCORE = r"(?U)(\d+)\s*[xX]\s*(\d+)"
LED_BY_NUMBER = r"(?U)^\s*(\d+)(?=[+\-\s]|[A-Za-zÀ-ú])"
CLUB_AND_PLAYER = r"(?U)^(.+?-[A-Z]{2})\s*(.*?)$"
CLUB_IN_FRONT = r"(?U)^.+?-[A-Z]{2}\s*"

# A character reference: by decimal number, by hexadecimal number, or by name.
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

# Characters by the names of the HTML standard, as one constant map.
NAMED = json.dumps({name[:-1]: char for name, char in html5.items() if name.endswith(";")})

# Cell texts that stand for "no kickoff time yet".
NO_KICKOFF = ["A def.", "None", ""]


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null when there is none or it is empty."""
    return blank_to_null(F.regexp_extract(text, pattern, group))


def _character(reference: Column) -> Column:
    """What a character reference stands for; null for unknown names and numbers."""
    hexadecimal = F.when(
        reference.rlike("^#[xX]"), F.substr(reference, F.lit(3))
    ).when(
        reference.startswith("#"), F.hex(F.substr(reference, F.lit(2)).try_cast("long"))
    )
    code = F.lpad(hexadecimal, 8, "0")
    known = (code > "00000000") & (code <= "0010FFFF") & ~F.upper(code).between("0000D800", "0000DFFF")
    named = F.try_element_at(F.from_json(F.lit(NAMED), "map<string,string>"), reference)
    return F.when(known, F.decode(F.unhex(code), "UTF-32")).when(code.isNull(), named)


def unescape(text: Column) -> Column:
    """Text with its character references resolved; unknown ones stay as they are."""

    def piece(part: Column, reference: Column) -> Column:
        as_it_is = F.concat(F.lit("&"), reference, F.lit(";"))
        return F.concat(part, F.coalesce(_character(reference), as_it_is, F.lit("")))

    references = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
    resolved = F.array_join(F.zip_with(F.split(text, REFERENCE), references, piece), "")
    return F.when(F.contains(text, F.lit("&")), resolved).otherwise(text)


def tag_text(html: Column, joiner: str = "") -> Column:
    """Text of a piece of markup: the parts between tags, stripped and joined."""
    parts = F.transform(F.split(html, TAG), lambda part: strip(unescape(part)))
    return F.array_join(F.filter(parts, lambda part: part != ""), joiner)


def strip_digits(text: Column) -> Column:
    """Text without digits, plus and minus signs, stripped."""
    return strip(F.regexp_replace(text, r"(?U)[\d+\-]+", ""))


def leading_number(text: Column) -> Column:
    """Digits at the start, read past leading blanks when a sign, blank or letter follows.

    Otherwise whatever stands before the first character that is no digit, '' if nothing.
    """
    led = first_match(text, LED_BY_NUMBER)
    return F.coalesce(led, F.regexp_replace(text, r"(?sU)\D.*", ""))


def score_in_text(text: Column) -> tuple[Column, Column]:
    """Home and away goals of the first score found in free text."""
    return first_match(text, SCORE, 1), first_match(text, SCORE, 2)


def strip_zeros(text: Column) -> Column:
    """Text without leading zeros; all zeros become a single one."""
    bare = F.regexp_replace(text, "^0+", "")
    return F.when(bare == "", "0").otherwise(bare)


def link_id(href: Column, path: str) -> Column:
    """Number that follows ``path`` in a link, without leading zeros."""
    return strip_zeros(first_match(href, rf"(?U){path}(\d+)"))


def game(text: Column) -> Column:
    """Struct (home, home_goals, away_goals, away) read from the text of a game.

    ``home h x a away`` is a played game, ``home x away`` one still to be played; all
    fields are null when the text is neither.
    """
    played = text.rlike(PLAYED)

    def side(group_played: int, group_unplayed: int) -> Column:
        return strip(
            F.when(played, first_match(text, PLAYED, group_played)).otherwise(
                first_match(text, UNPLAYED, group_unplayed)
            )
        )

    return F.struct(
        side(1, 1).alias("home"),
        F.when(played, first_match(text, PLAYED, 2)).alias("home_goals"),
        F.when(played, first_match(text, PLAYED, 3)).alias("away_goals"),
        side(4, 2).alias("away"),
    )


def scorer(raw: Column, title: Column, cell: Column) -> Column:
    """Struct (club, player) from the raw name, the club title if any, and the club cell.

    With a title it is cut off as a prefix, else a ``…-XX`` prefix is.  Without one a
    ``…-XX`` prefix is the club; failing that, the cell names the club.
    """
    club_title = strip(blank_to_null(title))
    titled = club_title.isNotNull()
    has_prefix = raw.rlike(CLUB_AND_PLAYER)
    with_title = F.when(
        F.startswith(raw, club_title),
        strip(F.substr(raw, F.length(club_title) + 1)),
    ).otherwise(strip(F.regexp_replace(raw, CLUB_IN_FRONT, "")))
    club = (
        F.when(titled, club_title)
        .when(has_prefix, strip(F.regexp_extract(raw, CLUB_AND_PLAYER, 1)))
        .otherwise(cell)
    )
    player = (
        F.when(titled, with_title)
        .when(has_prefix, strip(F.regexp_extract(raw, CLUB_AND_PLAYER, 2)))
        .otherwise(raw)
    )
    return F.struct(
        club.alias("club"), F.coalesce(blank_to_null(player), raw).alias("player")
    )


def first_word(text: Column) -> Column:
    return first_match(text, r"(?U)(\S+)")


def last_word(text: Column) -> Column:
    return F.element_at(F.split(text, " "), -1)


def place(city: Column, state: Column) -> Column:
    """City and state with a slash, leaving out the blank ones."""
    return F.concat_ws("/", blank_to_null(city), blank_to_null(state))
