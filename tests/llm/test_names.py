"""Column names with dots, blanks and back ticks, and further columns named like results."""

import pytest
from pyspark.sql import functions as F

from standwise.llm import bpe, decontaminate, line_dedup, minhash, suffix_dedup, toxicity
from standwise.llm.queries import WORD_BPE

ID, TEXT = "doc.id", "te.xt"
WORDS = " ".join(f"w{i}" for i in range(30))
FURTHER = "score double, `held out` string, spans int, row int, n_words int, gone_id int"


@pytest.fixture
def docs(spark):
    rows = [(1, WORDS), (2, WORDS), (3, None), (4, "")]
    return spark.createDataFrame(
        [(*r, 0.5, "k", 1, 2, 3, 4) for r in rows], f"`{ID}` long, `{TEXT}` string, {FURTHER}"
    )


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(
        [("a", " ".join(f"w{i}" for i in range(13)))], "item_id string, text string"
    )


def ids(df):
    return sorted(r[ID] for r in df.collect())


def test_near_duplicates(docs):
    kept = minhash.drop_near_duplicates(docs, ID, TEXT)
    assert kept.columns == docs.columns and ids(kept) == [1, 3, 4]


def test_decontamination(docs, benchmark):
    found = {r[ID]: (r.n_hit, r.contaminated) for r in decontaminate.hits(docs, benchmark, ID, TEXT).collect()}
    assert found == {1: (13, True), 2: (13, True), 3: (0, False), 4: (0, False)}
    assert ids(decontaminate.clean(docs, benchmark, TEXT)) == [3, 4]
    cut = decontaminate.clean(docs, benchmark, TEXT, coverage=(2, 1), longest_span=5)
    left = {r[ID]: (r[TEXT] or "").split() for r in cut.collect()}
    assert cut.columns == docs.columns
    assert left == {1: WORDS.split()[13:], 2: WORDS.split()[13:], 3: [], 4: []}


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1)], f"`{ID}` long, toxic int")
    kept = toxicity.drop_toxic(docs, toxicity.fit(docs, labels, ID, TEXT), TEXT)
    assert kept.columns == docs.columns


def test_bpe(docs):
    coded = docs.withColumn("i`ds", F.array(F.lit(5), F.lit(6)))
    assert bpe.decode(coded, WORD_BPE, ID, "i`ds").count() == 4


def test_lines_and_suffixes(docs):
    lines = line_dedup.dedup_texts(docs.withColumn("ho.st", F.lit("x")), host_col="ho.st", text_col=TEXT)
    assert ids(lines) == [1, 2, 3, 4]
    found = {r[ID]: r.n_removed for r in suffix_dedup.remove_repeats(docs, ID, TEXT).collect()}
    assert found == {1: 0, 2: len(WORDS), 3: 0, 4: 0}
