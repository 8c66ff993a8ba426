"""Work that was done twice is done once, with the same results."""

import random

from pyspark.sql import functions as F

from standwise.functions import markup
from standwise.operators import documents, overlay, pages


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tags_paired_in_one_pass(spark):
    rng = random.Random(7)
    rows = [
        (i, [(rng.choice("abc"), rng.choice([-1, 0, 1, 1])) for _ in range(rng.randrange(30))])
        for i in range(300)
    ]
    rows += [(300, []), (301, [("a", 1), ("b", 1), ("a", -1), ("b", -1), ("c", 1), ("c", 1)])]
    df = spark.createDataFrame(rows, "i int, tags array<struct<name:string,step:int>>")
    want = {r.i: r.spans for r in df.select("i", markup.spans(F.col("tags")).alias("spans")).collect()}
    assert {r.i: r.spans for r in markup.with_spans(df, "tags", "spans").collect()} == want


def test_pages_are_not_paired_by_sorts(spark):
    df = spark.createDataFrame([(1, "<p data-g=1>2 x 1<p><a href='/g/1'>3 x 0</a>"), (2, None)], "page_id int, html string")
    blocks, links = pages.marked_blocks(df, "data-g"), pages.link_parents(df, "^/g/")
    for found in (blocks, links):
        assert "MapInArrow" in plan_of(found) and "aggregate(" not in plan_of(found)
    assert [(r.id_text, r.text) for r in blocks.collect()] == [("1", "2 x 1")]
    assert [(r.links[0].href, r.text) for r in links.collect()] == [("/g/1", "3 x 0")]


def test_scores_of_a_tier_are_worked_out_once(spark):
    games = spark.createDataFrame([("1", None, None), ("2", "3", "3")], "match_id string, home_goals string, away_goals string")
    raw = spark.createDataFrame([("1", 1, "0", "0"), ("1", 2, "2", "1")], "match_id string, seq int, home_goals string, away_goals string")
    worked = raw.where(F.md5("match_id") != "")
    out = overlay.overlay_tiers(games, worked.where("match_id = '9'"), worked)
    assert "md5" not in plan_of(out)
    assert sorted(map(tuple, out.collect())) == [("1", "2", "1"), ("2", "3", "3")]


def test_document_rows_are_read_from_cells_once(spark):
    rows = [(1, s, [str(s), f"Round {s}" if s % 3 == 1 else "", "", "", "A 1 x 0 B"]) for s in range(1, 8)]
    out = documents.matches_from_doc_rows(spark.createDataFrame(rows, "doc_id long, seq long, cells array<string>"))
    assert "cells" not in plan_of(out)
    assert [r["round"] for r in sorted(out.collect(), key=lambda r: r.seq)] == [1, 1, 1, 4, 4, 4, 7]
