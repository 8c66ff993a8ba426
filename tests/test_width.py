"""What is shuffled and written holds no more than what is used behind it."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from standwise.operators import documents
from standwise.operators.keyed import keep_first
from standwise.sources import staging
from standwise.sources.binding import GIVEN, SOURCE_ORDER, Tables, document_rows

ROWS = {
    "region": [(0, "R0"), (1, None)],
    "nation": [(0, "N0", 0), (1, None, 1), (2, "N2", None), (3, "N3", 0), (0, "N0", 0), (4, "N4", 1)],
    "customer": [(1, "c", 0, 1.0, "m"), (2, "c", 1, 1.0, "m"), (3, "c", None, 1.0, "m"), (4, "c", 2, 1.0, "m"), (5, "c", 4, 1.0, "m")],
    "supplier": [(1, "s1", 0, 1.0), (2, "s2", 1, 1.0), (3, None, 3, 1.0), (4, "s4", 2, 1.0), (3, None, 3, 1.0)],
    "orders": [(k, k, "O", 1.0, datetime(2020, 1, 2) if k < 5 else None, "p") for k in (1, 2, 3, 4, 5)],
    "lineitem": [
        (k, p, s, n if n < 7 else None, float(p), 1.0, 0.0, None, "R", "O", datetime(2020, 2, 1 + (p * s) % 5))
        for k in (1, 2, 3, 4, 5)
        for n in range(1, 8)
        for p in (3, 1)
        for s in (1, 2, 3, 4)
    ],
}


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "staged"))
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, GIVEN[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


@pytest.fixture
def plan_of(spark):
    """Plans as they stand before any of them has run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_first_rows_are_those_of_the_raw_matches(tables):
    want = keep_first(tables.matches_raw, ["match_id"], SOURCE_ORDER).drop(*SOURCE_ORDER)
    assert tables.first.columns == want.columns
    got, want = (sorted(map(str, df.collect())) for df in (tables.first, want))
    assert got == want and len(got) > 10


def test_first_rows_are_shuffled_without_names(tables, plan_of):
    lines = plan_of(tables.first).splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = max(i for i, line in enumerate(lines) if "WindowGroupLimit" in line)
    end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    below = "\n".join(lines[at:end])
    assert "l_orderkey" in below and "home_full" not in below


def test_document_rows_are_shuffled_once_behind_the_cells(spark, plan_of):
    rows = [(1, s, [str(s), f"Round {s}", "", "", "A 1 x 0 B"]) for s in range(1, 8)]
    df = spark.createDataFrame(rows, "doc_id long, seq long, cells array<string>")
    plan = plan_of(documents.matches_from_doc_rows(df))
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1
    assert "named_round" in plan


def test_document_rows_are_written_once(spark, tables, tmp_path):
    found = documents.matches_from_doc_rows(document_rows(tables))
    assert len(list((tmp_path / "staged").iterdir())) == 1
    assert found.count() > 0


def test_rest_of_the_columns_alone_is_carried_on(spark):
    from standwise.operators.fill import carry_forward

    df = spark.createDataFrame([("a", s, s if s % 3 == 0 else None, "x") for s in range(9)], "k string, s int, v int, w string")
    out = carry_forward(df, "k", "s", F.col("v"), "f", block=2, rest=["s", "w"])
    assert out.columns == ["s", "w", "f"]
    assert sorted(map(tuple, out.collect())) == [(s, "x", s // 3 * 3) for s in range(9)]


def test_whole_run_joins_the_given_tables_once(spark, tables, monkeypatch, tmp_path):
    from catalog import load as catalog_load
    from standwise.plans import pipeline

    seen, run = {}, pipeline.run

    def kept(spark, raw, *args, **named):
        for name in ("matches", "standings", "scores"):
            seen[name] = raw[name]._jdf.queryExecution().executedPlan().toString()
        return run(spark, raw, *args, scenarios=8, **named)

    monkeypatch.setattr(pipeline, "run", kept)
    found = {r.table: r.rows for r in catalog_load.whole_run(tables).collect()}
    assert all("FileScan" in plan and "l_orderkey" in seen["matches"] for plan in seen.values())
    assert not any("lineitem" in plan or "orders.parquet" in plan for plan in seen.values())
    # Nothing but the loaded tables is left.
    assert [x.name.split("-")[0] for x in (tmp_path / "staged").iterdir()] == ["run"]
    # Ids without a line number are null; they are not stored.
    stored = tables.first.filter("match_id is not null and (state is null or length(state) <= 2)")
    assert found["matches"] == stored.count() > 0


def test_stored_matches_are_those_of_the_raw_ones(tables):
    want = sorted(map(str, tables.matches.collect()))
    assert tables.stored_first.count() == len(want)
    assert sorted(map(str, tables.stored_matches.collect())) == want


def test_first_rows_of_a_run_are_not_written_before_their_scores(spark, tmp_path, monkeypatch):
    from standwise.plans import pipeline
    from tests.test_load import small_model

    written, stage = [], staging.stage

    def counted(df, *args):
        written.append(df.columns)
        return stage(df, *args)

    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "staged"))
    monkeypatch.setattr(pipeline, "stage", counted)
    raw = small_model(spark)
    schema = "match_id string, seq int, home_goals string, away_goals string"
    raw["scores"] = spark.createDataFrame([("none", 1, "4", "0")], schema)
    raw["link_scores"] = spark.createDataFrame([("g3", 1, "4", "0"), ("g3", 2, "5", "0")], schema)
    raw["matches"] = raw["matches"].unionByName(raw["matches"].withColumns({"at": F.col("at") + 9, "home": F.lit("Z")}))
    status = pipeline.run(spark, raw, str(tmp_path / "out"), ["at"], scenarios=4)
    found = {r.table: (r.rows, r.rejected) for r in status.collect()}
    assert found["matches"] == (2, 1) and found["finished"] == (2, 1)
    assert sum("kickoff" in columns for columns in written) == 1


def test_overlap_may_be_looked_for_in_other_rows_of_the_same_ids(spark):
    from standwise.operators import overlay

    games = spark.createDataFrame([("1", None, None), ("2", "3", "3")], "match_id string, home_goals string, away_goals string")
    scores = spark.createDataFrame([("1", 1, "0", "0"), ("1", 2, "2", "1")], "match_id string, seq int, home_goals string, away_goals string")
    for ids in (None, games.select("match_id").union(games.select("match_id"))):
        out = overlay.overlay_tiers(games, scores.where("match_id = '9'"), scores, ids=ids)
        assert sorted(map(tuple, out.collect())) == [("1", "2", "1"), ("2", "3", "3")]
