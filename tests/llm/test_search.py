"""Top-k search and benchmark decontamination against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from standwise.llm import decontaminate, topk

VECTORS = "vec_id long, embedding array<float>, score string, node int, rank int"


def brute(rows, k, every):
    kept = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        kept[key] = min(kept.get(key, v), v)
    cells = {key: [math.floor(256 * x) for x in v] for key, v in kept.items()}
    out = set()
    for q in (key for key in cells if key % every == 0):
        scores = [
            (-sum(a * b for a, b in zip(cells[q], v)), key) for key, v in cells.items() if key != q
        ]
        out |= {(q, i + 1, key, -s) for i, (s, key) in enumerate(sorted(scores)[:k])}
    return out


@pytest.mark.parametrize("shard", [3, 4096])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    draw = random.Random(shard)
    rows = [(i, [draw.choice([-0.5, 0.25, 0.1, 0.7]) for _ in range(4)]) for i in range(60)]
    rows += [(60, None), (61, [0.1, None, 0.0, 0.0]), (62, [float("nan")] * 4), (None, [1.0] * 4)]
    rows += [(63, [float("inf"), 0.0, 0.0, 0.0]), (64, []), (65, [0.5, 0.5]), (10, rows[10][1]), (20, [-9.0] * 4)]
    df = spark.createDataFrame([(k, v, "x", 1, 2) for k, v in rows], VECTORS).repartition(3)
    found = topk.top_k(df, F.col("id") % 5 == 0, k=5)
    assert {tuple(r) for r in found.collect()} == brute(rows, 5, 5)
    assert found.count() == len(brute(rows, 5, 5))


def test_top_k_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.top_k(empty, F.col("id") % 5 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], "", 0, 0), (1, [2.0], "", 0, 0)], VECTORS)
    assert [tuple(r) for r in topk.top_k(one, F.col("id") == 0).collect()] == [(0, 1, 1, 131072)]
    assert topk.top_k(one, F.col("id") == 7).count() == 0


def test_products_beyond_floating_point_are_exact():
    a, b = np.array([[2**40, 3]]), np.array([[2**20, 1], [-(2**20), 5]])
    assert topk.products(a, b).tolist() == [[2**60 + 3, -(2**60) + 15]]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows_by_brute_force(docs, items, window):
    found = {}
    for name, text in items:
        w = words(text)
        length = min(window, len(w))
        for i in range(len(w) - length + 1 if w else 0):
            found.setdefault(tuple(w[i : i + length]), set()).add(str(name))
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for length in {len(gram) for gram in found}:
            for i in range(len(w) - length + 1):
                owners = found.get(tuple(w[i : i + length]))
                if owners:
                    hit |= set(range(i, i + length))
                    names |= owners
        out.append((key, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, row string, spans int, items int, body string"
ITEMS = "item_id long, text string, words int, length int"


def some_texts(seed, n, longest, alphabet="abcAé9"):
    draw = random.Random(seed)
    blanks = " \n-.\t"
    return [
        "".join(draw.choice(alphabet) + draw.choice(blanks) for _ in range(draw.randint(0, longest)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("block,piece", [(200_000, 50_000), (12, 4)])
def test_hits(spark, monkeypatch, block, piece):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    items = list(enumerate(some_texts(1, 12, 9))) + [(50, None), (51, "."), (52, "ß日 b"), (3, "c c c a")]
    docs = list(enumerate(some_texts(2, 40, 60))) + [(90, None), (91, ""), (None, "ß日 b a"), (92, "--")]
    df = spark.createDataFrame([(k, t, "x", 1, 2, "b") for k, t in docs], DOCS)
    marks = spark.createDataFrame([(k, t, 1, 2) for k, t in items], ITEMS)
    found = decontaminate.hits(df, marks, window=5)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()]
    assert sorted(got, key=str) == windows_by_brute_force(docs, items, 5)
    kept = decontaminate.clean(df, marks, window=5)
    clean = [k for k, *_, bad in windows_by_brute_force(docs, items, 5) if not bad]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert kept.columns == df.columns


def test_no_items(spark):
    df = spark.createDataFrame([(1, "a b", "", 0, 0, "")], DOCS)
    found = decontaminate.hits(df, spark.createDataFrame([], ITEMS)).first()
    assert (found.n_words, found.n_hit, found["items"]) == (2, 0, [])
    empty = decontaminate.hits(spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS))
    assert empty.count() == 0


def test_long_spans_are_cut_out(spark):
    item = " ".join(f"w{i}" for i in range(20))
    text = "x " * 500 + "É! " + item.upper() + " tail"
    df = spark.createDataFrame([(1, text, "", 0, 0, "")], DOCS)
    marks = spark.createDataFrame([(1, item, 0, 0)], ITEMS)
    kept = decontaminate.clean(df, marks, coverage=(1, 2), longest_span=15).first().text
    assert kept == "x " * 500 + "É!  tail"
    assert decontaminate.clean(df, marks, coverage=(1, 2), longest_span=25).first().text == text
    odd = df.withColumnRenamed("text", "te.xt")
    cut = decontaminate.clean(odd, marks, "te.xt", coverage=(1, 2), longest_span=15).first()
    assert cut["te.xt"] == "x " * 500 + "É!  tail"


def test_pieces_of_a_long_item_hold_the_same_windows(monkeypatch):
    draw = random.Random(5)
    w = [draw.choice([b"a", b"b", b"c"]) for _ in range(200)]
    whole = decontaminate.SuffixAutomaton([("i", w, 13)])
    parts = [("i", w[i : i + 40 + 12], 13) for i in range(0, 188, 40)]
    cut = decontaminate.SuffixAutomaton(parts)
    for _ in range(200):
        i = draw.randint(0, 180)
        text = [b"z", *w[i : i + draw.randint(1, 60)], draw.choice([b"a", b"z"])]
        assert whole.follow(text) == cut.follow(text)
