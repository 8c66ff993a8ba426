"""Coercion to storage types, keyed merges, snapshots and the load step."""

import datetime
import json
import math

import pytest
from pyspark.sql import functions as F

from standwise import schemas
from standwise.functions import numbers
from standwise.operators import keyed
from standwise.operators.matches import coerce
from standwise.plans import load, pipeline, report
from standwise.sources import files

NOW = "2026-01-02 03:04:05"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "store")


def now():
    return F.lit(NOW).cast("timestamp")


@pytest.mark.parametrize(
    "kind, value, target, expected",
    [
        ("double", math.nan, schemas.INT, None),
        ("double", 20.0, schemas.INT, 20),
        ("double", -2.7, schemas.INT, -2),
        ("double", 1e12, schemas.INT, None),
        ("double", math.inf, schemas.INT, None),
        ("string", "abc", schemas.INT, None),
        ("string", "20.5", schemas.INT, None),
        ("string", " 20 ", schemas.INT, 20),
        ("string", None, schemas.INT, None),
        ("bigint", 10, schemas.INT, 10),
        ("bigint", 123, schemas.STR, "123"),
        ("double", math.nan, schemas.STR, None),
        ("string", "66.7", schemas.DBL, 66.7),
    ],
)
def test_coerce(spark, kind, value, target, expected):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    assert coerce(df, schemas.struct(c=target)).first().c == expected


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(66.7, "x")], "a double, b string")
    assert coerce(df, schemas.struct(b=schemas.STR)).first().a == 66.7


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1e3", 1000.0),
        (" -.5 ", -0.5),
        ("7.", 7.0),
        ("1d", None),
        ("1f", None),
        ("nan", None),
        ("inf", None),
        ("1e999", None),
        ("", None),
        ("1 2", None),
        (" 12 ", 12.0),
    ],
)
def test_number(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(numbers.number(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("05/04/2026", datetime.date(2026, 4, 5)),
        ("5/4/2026", datetime.date(2026, 4, 5)),
        ("31/02/2026", None),
        ("2026-04-05", None),
        ("A def.", None),
    ],
)
def test_day_first_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(numbers.day_first_date(F.col("t"))).first()[0] == expected


@pytest.fixture
def target(spark):
    rows = [("a", 1, 10), ("b", 2, 20), ("c", 3, None)]
    df = spark.createDataFrame(rows, "team string, points int, games int")
    return df.withColumn("updated_at", F.lit("2025-01-01 00:00:00").cast("timestamp"))


def test_upsert(spark, target):
    rows = [("a", 5, "x", 1), ("a", 6, "x", 2), ("d", 7, "x", 3), (None, 8, "x", 4)]
    source = spark.createDataFrame(rows, "team string, points int, unknown string, at int")
    merged = keyed.upsert(target, source, ["team"], ["at"], now())
    assert merged.columns == target.columns
    found = sorted((r.team, r.points, r.games, str(r.updated_at)) for r in merged.collect())
    old = "2025-01-01 00:00:00"
    assert found == [("a", 6, None, NOW), ("b", 2, 20, old), ("c", 3, None, old), ("d", 7, None, NOW)]


def test_upsert_twice_equals_once(spark, target):
    source = spark.createDataFrame([("a", 5, 1), ("e", 9, 2)], "team string, points int, at int")
    once = keyed.upsert(target, source, ["team"], ["at"], now())
    twice = keyed.upsert(once, source, ["team"], ["at"], now())
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)


def test_first_and_last_row_per_key(spark):
    rows = [("k", 1, "x"), ("k", 3, "z"), ("k", 2, "y"), (None, 1, "p"), (None, 2, "q")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    first = {r.k: r.v for r in keyed.keep_first(df, ["k"], ["at"]).collect()}
    last = {r.k: r.v for r in keyed.keep_last(df, ["k"], ["at"]).collect()}
    assert first == {"k": "x", None: "p"} and last == {"k": "z", None: "q"}


def test_snapshots(spark, folder):
    def day(*values):
        return spark.createDataFrame([(v,) for v in values], "v int")

    files.write_snapshot(day(1, 2), folder, "20260102")
    files.write_snapshot(day(3), folder, "20260101")
    schema = day().schema
    assert sorted(r.v for r in files.read_latest(spark, folder, schema).collect()) == [1, 2]
    files.write_snapshot(day(9), folder, "20260102")
    assert [r.v for r in files.read_latest(spark, folder, schema).collect()] == [9]
    files.write_snapshot(day(), folder, "20260103")
    assert files.read_latest(spark, folder, schema).count() in (0, 1)
    with pytest.raises(FileNotFoundError):
        files.read_latest(spark, folder + "/none", schema)


def test_versions_keep_the_older_ones(spark, folder):
    df = spark.createDataFrame([(1,)], "v int")
    files.write_version(df, folder)
    again = files.read_version(spark, folder, df.schema).withColumn("v", F.col("v") + 1)
    files.write_version(again, folder)
    files.write_version(df.limit(0), folder)
    assert files.folders(spark, folder) == [f"version=0000000{n}" for n in (1, 2, 3)]
    assert files.read_version(spark, folder, df.schema).count() == 0


def test_csv_null_tokens(spark, folder):
    df = spark.createDataFrame([("a", "N/A"), ("nan", "1,2"), ("", 'x "y"')], "a string, b string")
    files.write_csv(df, folder)
    back = sorted((tuple(r) for r in files.read_csv(spark, folder, df.schema).collect()), key=str)
    assert back == sorted([("a", None), (None, "1,2"), (None, 'x "y"')], key=str)


def test_json_keeps_nulls_and_texts_dates(spark):
    df = spark.sql("select date '2026-05-10' d, cast(null as string) n, 1.5d x, cast(2.50 as decimal(5,2)) c")
    record = json.loads(files.json_records(df).first().record)
    assert record == {"d": "2026-05-10", "n": None, "x": 1.5, "c": "2.50"}


def test_columns_of(spark):
    assert files.columns_of(spark.sql("select 1 a, 'x' b")) == [("a", "int"), ("b", "string")]


def test_decimals_round_away_from_zero(spark):
    df = spark.createDataFrame([(66.665, 1.005)], "points_pct double, score double")
    row = load.as_stored(df).first()
    assert str(row.points_pct) == "66.67" and str(row.score) == "1.01"


def small_model(spark):
    columns = "match_id round match_date kickoff home away home_goals away_goals venue city state"
    raw = spark.createDataFrame(
        [
            ("g1", "1", "10/05/2026", "16:00", "A", "B", "2", "1", "v", "c", "ST", 1),
            ("g2", "1", "10/05/2026", "16:00", "C", "A", "1", "1", "v", "c", "ST", 2),
            ("g3", "2", "17/05/2026", None, "B", "C", None, None, "v", "c", "TOO LONG", 3),
        ],
        ", ".join(f"{c} string" for c in columns.split()) + ", at int",
    )
    names = ["position", "team", "points", "games", "goal_diff", "points_pct", "yellow", "red"]
    table = spark.createDataFrame(
        [
            ("1", "A", "4", "2", "1", "66.7", "3", "0"),
            ("2", "C", "1", "1", "0", "33.3", None, "1"),
            ("3", "B", "0", "1", "-1", "0", "5", "0"),
        ],
        ", ".join(f"{c} string" for c in names),
    )
    goals = spark.createDataFrame([("P", "3", "A"), ("Q", "5", "B")], "player string, goals string, club string")
    aliases = spark.createDataFrame([("zz", "zz")], "raw_name string, name string")
    return {"matches": raw, "standings": table, "scorers": goals, "aliases": aliases}


def test_run_loads_all_and_again(spark, folder):
    raw = small_model(spark)
    status = pipeline.run(spark, raw, folder, ["at"], now=now(), scenarios=40)
    found = {r.table: (r.status, r.rows, r.rejected) for r in status.collect()}
    assert found == {
        "standings": ("loaded", 3, 0),
        "matches": ("loaded", 2, 1),
        "finished": ("loaded", 2, 0),
        "team_stats": ("loaded", 3, 0),
        "recent_form": ("loaded", 3, 0),
        "scorers": ("loaded", 2, 0),
        "round_goals": ("loaded", 1, 0),
    }
    again = pipeline.run(spark, raw, folder, ["at"], now=now(), scenarios=40)
    assert {r.table: r.rows for r in again.collect()} == {k: v[1] for k, v in found.items()}
    stored = {name: load.stored_schema(name) for name in schemas.TARGETS}
    tables = pipeline.stored_tables(spark, folder, {**stored, "probabilities": schemas.PROBABILITIES})
    shown = report.report_tables(tables)
    assert shown["kpis"].first().leader == "A"
    assert [r.team for r in shown["cards"].orderBy("rank").collect()] == ["B", "A", "C"]
    assert all(df.count() >= 1 for df in shown.values())


def test_a_run_leaves_no_staged_tables(spark, folder, monkeypatch, tmp_path):
    from standwise.sources import staging

    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "staged"))
    pipeline.run(spark, small_model(spark), folder, ["at"], now=now(), scenarios=4)
    assert files.folders(spark, str(tmp_path / "staged")) == []
    assert files.has_version(spark, f"{folder}/scorers")


def test_run_takes_late_scores(spark, folder):
    raw = small_model(spark)
    schema = "match_id string, seq int, home_goals string, away_goals string"
    raw["scores"] = spark.createDataFrame([("g3", 1, "4", "0")], schema)
    raw["link_scores"] = raw["scores"].limit(0)
    raw["texts"] = spark.createDataFrame([], "page_id long, text string")
    raw["matches"] = raw["matches"].withColumn("state", F.lit("ST"))
    pipeline.run(spark, raw, folder, ["at"], now=now(), scenarios=4)
    stored = files.read_version(spark, f"{folder}/finished", load.stored_schema("finished"))
    assert {r.match_id: r.home_result for r in stored.collect()} == {"g1": "W", "g2": "T", "g3": "W"}


def test_load_goes_on_after_a_failure(spark, folder):
    good = spark.createDataFrame([(1, 2)], "round int, games int")
    bad = spark.createDataFrame([(1,)], "nothing int")
    status = load.load_all(spark, {"round_goals": good, "team_stats": bad}, folder, now())
    found = {r.table: r.status for r in status.collect()}
    assert found["round_goals"] == "loaded" and found["team_stats"] == "failed"
    assert found["scorers"] == "skipped"


def test_probabilities_fall_back(spark, folder):
    def fail():
        raise RuntimeError("no model")

    empty = report.load_probabilities(spark, folder, fail)
    assert empty.schema == schemas.PROBABILITIES and empty.count() == 0


def test_a_failed_write_loses_nothing(spark, folder):
    schema = "round int, games int"
    first = spark.createDataFrame([(1, 2), (2, 2)], schema)
    third = spark.createDataFrame([(3, 2)], schema)
    broken = third.withColumn("games", F.raise_error(F.lit("broken " * 60)).cast("int"))

    def status(df):
        return load.load_all(spark, {"round_goals": df}, folder, now()).where("status <> 'skipped'").first()

    assert status(first).rows == 2
    failed = status(broken)
    assert failed.status == "failed" and "broken " * 60 in failed.detail
    # What a write that stops halfway leaves behind: a folder without a mark.
    stored = load.stored_schema("round_goals")
    path = f"{folder}/round_goals"
    last = files.folders(spark, path)[-1]
    spark.createDataFrame([], stored).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{path}/version={int(last.split('=')[1]) + 1:08d}")
    assert status(third).rows == 3
    kept = files.read_version(spark, path, stored)
    assert sorted(r["round"] for r in kept.collect()) == [1, 2, 3]


def test_a_failed_refresh_keeps_the_old_table(spark, folder):
    goals = spark.createDataFrame([("P", 3, "A")], "player string, goals int, club string")
    broken = goals.withColumn("goals", F.raise_error(F.lit("x")).cast("int"))
    for df in (goals, broken):
        load.load_all(spark, {"matches": df, "scorers": df}, folder, now())
    stored = files.read_version(spark, f"{folder}/scorers", load.stored_schema("scorers"))
    assert [r.player for r in stored.collect()] == ["P"]


def test_a_failed_snapshot_keeps_the_day(spark, folder):
    good = spark.createDataFrame([(1,)], "v int")
    files.write_snapshot(good, folder, "20260101")
    with pytest.raises(Exception, match="broken"):
        files.write_snapshot(good.withColumn("v", F.raise_error(F.lit("broken")).cast("int")), folder, "20260101")
    assert files.read_latest(spark, folder, good.schema).first().v == 1
    files.write_snapshot(spark.createDataFrame([(2,)], "v int"), folder, "20260101")
    assert files.read_latest(spark, folder, good.schema).first().v == 2


def test_last_source_row_is_stored(spark, folder):
    rows = [(1, 5, 20), (1, None, 30), (2, 7, 30), (2, 9, 10), (3, None, None), (3, 4, None)]
    df = spark.createDataFrame(rows, "round int, games int, line int")

    def games(place, **options):
        load.load_table(spark, df, "round_goals", f"{folder}/{place}", now(), **options)
        stored = files.read_version(spark, f"{folder}/{place}/round_goals", load.stored_schema("round_goals"))
        return {r["round"]: r.games for r in stored.collect()}

    assert games("by_line", order=["line"]) == {1: None, 2: 7, 3: 4}
    assert games("by_value") == {1: 5, 2: 9, 3: 4}


def test_upsert_keeps_target_rows_as_they_are(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 4)], "k string, v int")
    source = spark.createDataFrame([("a", 9, 1), ("a", 8, 1), (None, 7, 1)], "k string, v int, at int")
    merged = keyed.upsert(target, source, ["k"], ["at", "v"])
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(
        map(str, [("a", 9), ("b", 2), ("b", 3), (None, 4), (None, 4)])
    )


def test_upsert_takes_one_shuffle(spark, tmp_path):
    for name, columns in (("t", "k string, v int"), ("s", "k string, v int, at int")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    plan = keyed.upsert(target, source, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2 and "Join" not in plan


def test_csv_cells(spark, folder):
    schema = schemas.struct(a=schemas.STR, b=schemas.STR, c=schemas.STR)
    rows = [(" x ", 'say "hi", you', "two\nlines"), ("n/a", "#N/A", "<NA>"), ("-nan", "1", 'end\\')]
    files.write_csv(spark.createDataFrame(rows, schema).select("c", "a", "b"), folder)
    got = sorted((tuple(r) for r in files.read_csv(spark, folder, schema).collect()), key=str)
    assert got == sorted([rows[0], (None, None, None), (None, "1", "end\\")], key=str)
    wider = schemas.struct(b=schemas.STR, z=schemas.STR)
    assert {tuple(r) for r in files.read_csv(spark, folder, wider).collect()} == {
        ('say "hi", you', None), (None, None), ("1", None),
    }
