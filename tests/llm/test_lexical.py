"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from standwise.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, shard long, term string, item string, query int"
ITEMS = "item_id long, text string, term int, query string, rank int"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def ranked_by_brute_force(docs, items, k):
    counts = [(key, Counter(terms(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        asked, scores = Counter(terms(text)), []
        for key, c in counts:
            m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, r in asked.items()
                if c[t]
            )
            scores += [(-score, key is None, key or 0, key)] if score else []
        out += [(item, i + 1, key, -s) for i, (s, _, _, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def some_texts(seed, n, longest, words):
    draw = random.Random(seed)
    names = [f"{draw.choice('abcÀß日')}{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    out = []
    for _ in range(n):
        found = draw.choices(names, weights, k=draw.randint(0, longest))
        out.append("".join((w.upper() if draw.random() < 0.2 and w.isascii() else w) + draw.choice(" -\n`@[") for w in found))
    return out


def frames(spark, docs, items):
    one = spark.createDataFrame([(k, t, 1, "a", "b", 2) for k, t in docs], DOCS).repartition(4)
    return one, spark.createDataFrame([(k, t, 1, "a", 2) for k, t in items], ITEMS)


@pytest.mark.parametrize("block,split", [(50_000, 4 << 20), (7, 16)])
def test_rank(spark, monkeypatch, block, split):
    """Small limits deal the items to several blocks and cut texts into pieces."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    monkeypatch.setattr(lexical, "SPLIT_BYTES", split)
    docs = list(enumerate(some_texts(block, 150, 60, 60)))
    docs += [(200, None), (201, ""), (202, "--"), (None, docs[3][1]), (None, "a0 a0"), docs[5], docs[5], (5, "b1 a0")]
    items = list(enumerate(some_texts(9, 12, 9, 60)))
    items += [(50, None), (51, "."), (52, "zzz"), (None, "a0 b1"), (3, docs[5][1]), items[4], (53, docs[9][1] * 3)]
    df, asked = frames(spark, docs, items)
    found = lexical.rank(df, asked, k=5)
    got = sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == ranked_by_brute_force(docs, items, 5)


def test_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SPLIT_BYTES", 1000)
    docs = [(1, "alpha beta " * 50_000), (2, "x" * 300_000 + " beta"), (3, "gamma")]
    items = [(1, "beta alpha"), (2, "x" * 300_000)]
    found = lexical.rank(*frames(spark, docs, items))
    got = sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == ranked_by_brute_force(docs, items, 10)


def test_empty_tables(spark):
    for docs, items in (([], []), ([(1, "a")], []), ([], [(1, "a")]), ([(1, None)], [(1, "a")])):
        found = lexical.rank(*frames(spark, docs, items))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_wanted_terms_are_all_let_through(spark):
    names = [f"w{i}" for i in range(3000)]
    rows = spark.createDataFrame([(0, 0, n, 1) for n in names], "query long, item long, term string, repeats long")
    wanted = lexical.wanted_by(rows)
    body = " ".join([*names, *(f"other{i}" for i in range(3000))]).encode()
    found, codes, *_ = lexical._postings([body], wanted)
    kept = {found[c] for c in codes}
    assert {n.encode() for n in names} <= kept and len(kept) < 3020


def test_no_accumulators_beyond_the_bound():
    """Rare terms decide: the frequent term updates what is held and creates nothing."""
    n = 1000
    shard = lexical.Shard(pa.array(range(n), pa.int64()), np.full(n, 50), n, 50 * n)
    shard.add(6000, np.arange(20), np.full(20, 3))
    shard.add(100, np.arange(n), np.full(n, 9))
    asked, made = [], lexical._best
    lexical._best = lambda scores, *rest: asked.append(np.count_nonzero(scores)) or made(scores, *rest)
    try:
        places, scores = shard.search([(1, 1), (0, 1)], 10)
    finally:
        lexical._best = made
    assert asked == [20] and places.tolist() == list(range(10))
    parts = [10**9 * tf // (1000 * tf + 8 * 100) for tf in (3, 9)]
    assert set(scores.tolist()) == {6000 * parts[0] + 100 * parts[1]}
