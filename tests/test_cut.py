"""Elements are cut out of a page in one pass, without arrays of all its pieces."""

import random

import pytest
from pyspark.sql import functions as F

from standwise.functions import markup
from standwise.operators import pages


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pieces_of(rng):
    some = ["<p>", "</p>", "<DIV a=1>", "</div>", "<br>", "<i/>", "</b>", "<b>", " x ", "<a href='/g/1'>", "</a>", "é<a>"]
    return "".join(rng.choice(some) for _ in range(rng.randrange(25)))


def tags_of(page):
    return [f"<{x.split('>')[0]}>" for x in page.split("<")[1:]]


def test_innermost_elements_by_brute_force():
    rng = random.Random(3)
    for _ in range(500):
        tags = tags_of(pieces_of(rng))
        openings, ends = markup.paired_tags(*markup.names_and_steps(tags, {}))
        assert openings == sorted(openings)
        want = []
        for at in range(len(tags)):
            inside = [(a, b) for a, b in zip(openings, ends) if a < at < b]
            want.append(max(inside, default=(-1, -1)))
        assert markup.around(openings, ends, range(len(tags))) == want


def test_places_of_tags():
    page = "<b><<b>x</b ><b"
    assert markup.places(page, ["<b>", "<b>", "</b >"]) == ([0, 4, 8], [3, 7, 13])


@pytest.mark.parametrize("at_once", [0, 5, 1000])
def test_elements_are_what_stands_between_their_tags(spark, at_once):
    rng = random.Random(at_once)
    rows = [(i if i % 7 else None, pieces_of(rng)) for i in range(200)]
    given = [(i, page, tags_of(page), [(k,) for k in range(len(tags_of(page))) if k % 2]) for i, page in rows]
    df = spark.createDataFrame(given, "page_id int, plain string, tags array<string>, wanted array<struct<at:int>>")

    def pick(openings, ends, wanted):
        return ((a, b, [n]) for n, (a, b) in enumerate(markup.around(openings, ends, wanted)))

    got = sorted(map(str, markup.cut_elements(df, pick, at_once).collect()))
    want = []
    for i, page, tags, wanted in given:
        starts, stops = markup.places(page, tags)
        openings, ends = markup.paired_tags(*markup.names_and_steps(tags, {}))
        for n, (at,) in enumerate(wanted):
            a, b = max(((a, b) for a, b in zip(openings, ends) if a < at < b), default=(-1, -1))
            low, high = stops[a] if a >= 0 else 0, starts[b] if 0 <= b < len(tags) else len(page)
            want.append(f"Row(page_id={i}, seq={n}, wanted=[Row(at={at})], inside={page[low:high]!r})")
    assert got == sorted(want)


def test_a_page_goes_through_the_pass_as_text_and_tags(spark):
    df = spark.createDataFrame([(1, "<p data-g=1>2 x 1<p><a href='/g/1'>3 x 0</a>"), (2, "<p>no"), (3, None)], "page_id int, html string")
    for found in (pages.marked_blocks(df, "data-g"), pages.link_parents(df, "^/g/")):
        plan = plan_of(found)
        assert "flatten(" not in plan and "sequence(" not in plan
        assert [r.text for r in found.collect()] in (["2 x 1"], ["3 x 0"])
    # An address is read once from a tag.
    assert plan_of(pages.link_parents(df, "^/g/").where(F.col("text") != "")).count("href\\s*=") <= 2
