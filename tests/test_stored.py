"""The load reads stored tables as they are, and reads plain cells without patterns."""

import pytest
from pyspark.sql import functions as F

from standwise import schemas
from standwise.functions import numbers
from standwise.plans import load
from standwise.sources import files, staging

MATCHES = [
    ("g1", 1, "A", "ST"),
    ("g1", 2, "B", "ST"),
    ("g2", 1, "é" * 100, "é2"),
    ("g3", 1, "é" * 101, "AMERICA"),
    (None, 1, "A", "ST"),
    ("g4", None, None, None),
]


@pytest.mark.parametrize("stored", [False, True])
def test_stored_rows_are_not_written_once_more(spark, tmp_path, monkeypatch, stored):
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "staged"))
    root = str(tmp_path / "tables")
    df = spark.createDataFrame(MATCHES, "match_id string, round int, home string, state string")
    status = load.load_all(spark, {"matches": df}, root, stored=["matches"] if stored else [])
    assert [tuple(r) for r in status.collect() if r.table == "matches"] == [("matches", "loaded", 3, 2, None)]
    assert [r.table for r in status.collect()] == list(schemas.TARGETS)
    kept = files.read_version(spark, f"{root}/matches", load.stored_schema("matches")).collect()
    assert {r.match_id: r["round"] for r in kept} == {"g1": 2, "g2": 1, "g4": None}
    rejected = spark.read.parquet(f"{root}/_rejected/matches/version=00000001").collect()
    assert sorted((str(r.match_id), r.overflow) for r in rejected) == [("None", []), ("g3", ["home", "state"])]
    assert len(files.folders(spark, str(tmp_path / "staged"))) == (0 if stored else 1)


def test_a_failed_stored_table_stops_no_other(spark, tmp_path):
    good = spark.createDataFrame([(1, 2)], "round int, games int")
    bad = good.withColumn("games", F.raise_error(F.lit("broken")).cast("int"))
    tables = {"round_goals": good, "matches": bad.select(F.lit("g").alias("match_id"), F.col("games").alias("round"))}
    status = load.load_all(spark, tables, str(tmp_path), stored=list(tables))
    found = {r.table: (r.status, r.rows) for r in status.collect()}
    assert found["round_goals"] == ("loaded", 1) and found["matches"] == ("failed", None)
    assert not files.has_version(spark, f"{tmp_path}/matches")


def test_plain_cells_need_no_pattern(spark):
    texts = ["3", "03", "+3", "-3", "-0", "3.0", "3.9", " 3 ", " 3", "\x013", "1e2", "2147483647", "2147483648"]
    texts += ["-2147483648", "-2147483649", "", "x", "3d", "٣", None]
    whole = F.regexp_extract("t", numbers.NUMBER_TEXT, 1).try_cast("double").try_cast("int")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", whole.alias("want"), numbers.rounded_down(F.col("t")).alias("got")).collect():
        assert r.got == r.want, r.t
    years = ["2023", "2024", "1900", "1850", "0000", "0001", "2999", "3000", "24", "12024"]
    months = [f"{d}/{m}/" for d in ("01", "1", "29", "31", "00", " 1") for m in ("02", "2", "12", "13")]
    days = [month + year for month in months for year in years]
    days += ["05/04/2026 ", " 05/04/2026", "05/04/2026\n", "1 /04/2026", "1T/04/2026", "05-04-2026", "05/04/2026x", "٠٥/٠٤/٢٠٢٦", "", None]
    days += ["30/12/2011", "31/12/2011", "04/10/2020"]
    df = spark.createDataFrame([(t,) for t in days], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for place in ("UTC", "Pacific/Apia", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", place)
            want = F.try_to_date(numbers.strip(F.col("t")), "d/M/yyyy").cast("string")
            got = numbers.day_first_date(F.col("t")).cast("string")
            for r in df.select("t", want.alias("want"), got.alias("got")).collect():
                assert r.got == r.want, (place, r.t)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_texts_are_marked_without_a_function_per_text(spark):
    names = ["home", "state", "round"]
    df = spark.createDataFrame([("é" * 100, "é2", 1), ("a" * 101, "ab3", 1), (None, None, None)], "home string, state string, round int")
    out = df.select(load.text_overflow(names).alias("o"), load.text_overflow(["round"]).alias("none"))
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.o, r.none) for r in out.collect()] == [([], []), (["home", "state"], []), ([], [])]
