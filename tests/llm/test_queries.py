"""Every registered query of this subpackage, and the pipeline, over whole small tables."""

import hashlib
import zlib

import numpy as np
import pytest
from test_chat import digest
from test_coding import WORDS, library
from test_dedup import groups_by_brute_force, lines_by_brute_force, repeats_by_brute_force
from test_byte_bpe import BYTES, library as byte_library
from test_search import windows_by_brute_force
from test_variants import counted_by_brute_force, grouped_by_brute_force

import corpus_pipeline
from oracle.check import compare, connect
from standwise.llm.queries import INJECTED, ORACLES, QUERIES, trusted_labels
from standwise.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    return [(r.doc_id, r.text, r.source) for r in rows]


@pytest.fixture(scope="module")
def items(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]


def rows_of(spark, name, *columns):
    return sorted((tuple(r) for r in QUERIES[name](spark, FOLDER).select(*columns).collect()), key=str)


def coded(text):
    tool = library(WORDS)
    ids = tool.encode(text or "", add_special_tokens=False).ids
    plain = tool.decode(ids, skip_special_tokens=False).encode()
    data = np.array(ids, "<u4").tobytes()
    return ids, (len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(plain).hexdigest())


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_sql(spark, key):
    assert compare(QUERIES[key](spark, FOLDER), connect(FOLDER), ORACLES[key]) is None


def test_op1(spark, docs):
    got = rows_of(spark, "op1_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((k, *coded(t)[1]) for k, t, _ in docs), key=str)


def test_op2(spark, docs):
    at, want = 0, []
    for key, text, _ in docs:
        ids = [*coded(text)[0], 1]
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows_of(spark, "op2_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)


def test_op6(spark, docs, items):
    want = []
    for key, n, hit, names, bad in windows_by_brute_force([d[:2] for d in docs], items, 13):
        want.append((key, n, hit, len(names), digest(",".join(names)), bad))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows_of(spark, "op6_decontaminate", *columns) == sorted(want, key=str)


def test_op7(spark, docs):
    got = rows_of(spark, "op7_minhash", "doc_id", "n_shingles", "component_id")
    assert got == sorted(groups_by_brute_force([d[:2] for d in docs]), key=str)


def test_op9(spark, docs):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(spark, "op9_suffix_dedup", *columns) == repeats_by_brute_force([d[:2] for d in docs])


def test_op10(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect()
    told = {-1: [("user", INJECTED), ("assistant", INJECTED)]}
    for r in rows:
        told.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want = []
    for key, turns in told.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        want.append((key, len(turns), digest(whole), len(learned), digest(learned)))
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert rows_of(spark, "op10_chat", *columns) == sorted(want, key=str)


def test_op12(spark, docs):
    tool, want = byte_library(BYTES), []
    for key, text, _ in docs:
        ids = tool.encode_ordinary(text or "")
        listed = ",".join(map(str, ids))
        want.append((key, len(ids), digest(listed), digest(tool.decode_bytes(ids).decode())))
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows_of(spark, "op12_byte_bpe", *columns) == sorted(want, key=str)


def test_op13(spark, docs):
    counts = counted_by_brute_force([d[:2] for d in docs], 6, 5, 199)
    columns = ["word", "n", "form", "root", "n_near", "form_n"]
    want = sorted(grouped_by_brute_force(counts, 5), key=str)
    assert rows_of(spark, "op13_variants", *columns) == want and any(w[2] for w in want)


def test_pipeline(spark):
    """Each stage's rule, applied by brute force to all that the stage before kept."""
    folder = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id")
    docs = [(r.doc_id, r.text, r.source) for r in frame.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    scorer = toxicity.fit(frame, trusted_labels(spark, folder))
    rows = [d for d in docs if scorer.score(d[1] or "") < toxicity.THRESHOLD]
    assert 0 < len(rows) < len(docs)
    texts = dict(lines_by_brute_force(rows, 0.1, 3, 1.0, copies_once=True))
    groups = groups_by_brute_force(list(texts.items()))
    rows = [(k, texts[k]) for k, _, component in groups if k == component]
    marked = windows_by_brute_force(rows, items, 13)
    clean = {k for k, *_, bad in marked if not bad}
    assert len(clean) < len(rows) < len(texts) and any(texts[k] != t for k, t, _ in docs if k in texts)
    want = sorted(((k, *coded(t)[1]) for k, t in rows if k in clean), key=str)
    found = corpus_pipeline.run(spark, folder)
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()]
    assert sorted(got, key=str) == want


def test_the_rule_of_the_line_stage(spark):
    """Rows that another share, or copies that count each, would leave or cut otherwise."""
    foot = "all rights reserved " * 9
    rows = [(i, f"own {i}\n{foot}", "a") for i in range(6)] + [(40, foot, "a"), (41, None, "a")]
    rows += [(10 + i, "copied one\ncopied two", "b") for i in range(6)] + [(20, "copied one\nother", "b")]
    rows += [(30 + i, f"head\nlonger line of its own {i}", "b") for i in range(4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(k, t, None, s, None) for k, t, s in rows], schema)
    found = corpus_pipeline.drop_lines(spark, df, FOLDER).collect()
    got = sorted(((r.doc_id, r.text) for r in found), key=str)
    assert got == lines_by_brute_force(rows, 0.1, 3, 1.0, copies_once=True)
    assert got != lines_by_brute_force(rows, 0.1, 3, 0.5, copies_once=True)
    assert got != lines_by_brute_force(rows, 0.1, 3, 1.0)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found)


@pytest.mark.parametrize("k", range(4))
def test_stages_return_the_columns_of_documents(spark, k):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row int, kept string"
    rows = [(1, None, None, None, None, 0.1, 1, "a"), (2, "", "", "", 0, None, None, None), (None, "x " * 9, None, "s", 18, 0.0, 0, "")]
    for some in ([], rows, rows + rows):
        df = spark.createDataFrame(some, schema)
        out = corpus_pipeline.STAGES[k][1](spark, df, FOLDER)
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        assert out.count() == len(some)


def test_stages_are_registered():
    import __spark_entry__ as entry

    assert len(corpus_pipeline.STAGES) == 5
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert "pipeline" not in entry.oracle_sql()
