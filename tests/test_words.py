"""Candidate words around a score: all that are wanted, and few others."""

import random

import pytest

from standwise.operators import overlay


def around(words, text, ends):
    """Wanted words that end (or start) at most REACH letters from the text's end (or start)."""
    gaps = range(overlay.REACH + 1)
    if ends:
        return {w for w in words for g in gaps if g + len(w) <= len(text) and text[: len(text) - g].endswith(w)}
    return {w for w in words for g in gaps if text[g:].startswith(w)}


@pytest.mark.parametrize("words", [["abc", "abcd", "bca"], ["a", "ab", "dddd"], ["ab", "éa"], ["abcde"], []])
def test_words_around_a_score(spark, words):
    draw = random.Random(len(words))
    texts = ["", "a", "ab", "abcd", "xxabcdxx" * 6]
    texts += ["".join(draw.choice("abcdé ") for _ in range(draw.randrange(60))) for _ in range(40)]
    pairs = spark.createDataFrame([(w, w) for w in words], "home_word string, away_word string")
    lengths = sorted({len(w) for w in words})
    hits = spark.createDataFrame(
        [(i, 1, x, x, lengths, lengths) for i, x in enumerate(texts)],
        "page_id int, at int, left string, right string, home_lengths array<int>, away_lengths array<int>",
    )
    for found, name, ends in (
        (overlay._words_before(hits, pairs), "home_word", True),
        (overlay._words_after(hits, pairs), "away_word", False),
    ):
        got = {(r.page_id, r[name]) for r in found.collect() if r[name] in words}
        assert got == {(i, w) for i, x in enumerate(texts) for w in around(words, x, ends)}


def test_places_without_a_words_letters_are_not_cut(spark):
    pairs = spark.createDataFrame([("team_1", "team_2"), ("team_12", "side")], "home_word string, away_word string")
    text = "return: team_1 of the league, then x team_1 "
    hits = spark.createDataFrame(
        [(1, 1, text, text[::-1] + "team_2", [6, 7], [4, 6])],
        "page_id int, at int, left string, right string, home_lengths array<int>, away_lengths array<int>",
    )
    # Some forty places times two lengths, if each were cut.
    assert overlay._words_before(hits, pairs).count() <= 8
    assert overlay._words_after(hits, pairs).count() <= 8
