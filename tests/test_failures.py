"""A failure does not look like a result."""

import pytest

from catalog import report as catalog_report
from standwise import schemas
from standwise.plans import report
from standwise.sources import files, staging


def fail(*_):
    raise RuntimeError("no model")


def row(spark):
    return spark.createDataFrame([("A", 1, 3, 100.0, 100.0, 0.0, 0.0)], "team string, position int, points int, p_top4 double, p_top6 double, p_mid double, p_drop double")


class Given:
    def __init__(self, spark):
        self.spark = spark


@pytest.fixture
def root(tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path))
    return tmp_path


def test_required_probabilities_that_cannot_be_computed(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no model"):
        report.load_probabilities(spark, str(tmp_path), fail, required=True)
    found = report.load_probabilities(spark, str(tmp_path), lambda: row(spark), required=True)
    files.write_version(found, str(tmp_path))
    stored = report.load_probabilities(spark, str(tmp_path), fail, required=True)
    assert stored.schema == schemas.PROBABILITIES and [r.team for r in stored.collect()] == ["A"]


def test_a_failed_computation_is_not_stored_as_no_rows(spark, root, monkeypatch):
    monkeypatch.setattr(catalog_report, "probable", fail)
    with pytest.raises(RuntimeError, match="no model"):
        catalog_report.report_prob_fallback(Given(spark))
    assert list(root.iterdir()) == []


def test_rows_that_were_not_stored_are_not_taken_for_none(spark, root, monkeypatch):
    monkeypatch.setattr(catalog_report, "probable", lambda t: row(spark))
    with monkeypatch.context() as m:
        m.setattr(files, "write_version", lambda *_: None)
        with pytest.raises(FileNotFoundError):
            catalog_report.report_prob_fallback(Given(spark))
    assert [r.team for r in catalog_report.report_prob_fallback(Given(spark)).collect()] == ["A"]
