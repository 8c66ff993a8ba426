"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from standwise.llm import variants

SCHEMA = "doc_id long, text string, word string, n int, class string, form string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted_by_brute_force(docs, letters, occurrences, every):
    total = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if key is None else key}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= letters:
                total[word] += 1
    return {w: n for w, n in total.items() if n >= occurrences}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped_by_brute_force(counts, factor):
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    form = {}
    for word, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= factor * counts[word] else None
    out = []
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        f = form[word]
        out.append((word, counts[word], f, root, len(near[word]), None if f is None else counts[f]))
    return sorted(out)


def some_docs(seed, n, alphabet="abÀé", shortest=1, longest=6, words=40):
    draw = random.Random(seed)
    blanks = [" ", "-", "\n", "日", "1", "Ā", "_"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, words)):
            letters = draw.choices(alphabet, [8, 3, 2, 1][: len(alphabet)], k=draw.randint(shortest, longest))
            word = "".join(letters)
            parts.append(word.upper() if draw.random() < 0.2 and word.isascii() else word)
        out.append((i, "".join(p + draw.choice(blanks) for p in parts)))
    return out


def frame(spark, docs):
    rows = [(k, t, "clash", 1, "x", None) for k, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("most", [20_000, 6])
@pytest.mark.parametrize("seed", [1, 2])
def test_groups(spark, monkeypatch, most, seed):
    """A small limit halves partitions down to single places."""
    monkeypatch.setattr(variants, "PARTITION_WORDS", most)
    docs = some_docs(seed, 120) + [(None, "aaab aaab"), (7, None), (8, ""), (8, "aab aab"), (8, "aab aab")]
    found = variants.group(frame(spark, docs), letters=3, occurrences=2, factor=3, drop_every=5)
    counts = counted_by_brute_force(docs, 3, 2, 5)
    got = sorted(tuple(r) for r in found.select("word", "n", "form", "root", "n_near", "form_n").collect())
    assert got == grouped_by_brute_force(counts, 3) and len(got) > 100


def test_chains_of_forms(spark):
    rows = [("a" * k, 7**k) for k in range(3, 14)] + [("b" * k, 9) for k in range(3, 6)]
    words = spark.createDataFrame(rows, "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in variants.variants(words).collect()}
    assert got == {w: (f, root, near) for w, _, f, root, near, _ in grouped_by_brute_force(dict(rows), 5)}
    assert got["aaa"][1] == "a" * 13


def test_empty_and_null(spark):
    none = variants.group(frame(spark, []))
    assert none.columns == ["word", "n", "form", "root", "n_near", "form_n"] and none.count() == 0
    assert variants.group(frame(spark, [(1, None), (2, ""), (None, "12 _ 日")])).count() == 0


def test_very_long_words(spark):
    base = "ab" * 15_000
    docs = [(i, t) for i, t in enumerate([base] * 10 + [base + "a"] * 2 + [base[:9] + "é" + base[9:]] * 2)]
    got = {len(r.word): r for r in variants.group(frame(spark, docs), occurrences=2).collect() if r.word[-1] == "a"}
    assert got[30_001].form == base and got[30_001].root == base
    found = variants.group(frame(spark, docs), occurrences=2).where("n_near = 2").collect()
    assert [r.word for r in found] == [base]


def test_acceptor_is_minimal_and_composes():
    draw = random.Random(4)
    for _ in range(60):
        short = sorted({"".join(draw.choices("abc", k=4)) for _ in range(draw.randint(1, 30))})
        long = sorted({"".join(draw.choices("abc", k=5)) for _ in range(draw.randint(0, 30))})
        words = short + long
        for at_end in (True, False):
            found = sorted(tuple(p) for part in variants.near_in_partition(short, long, at_end) for p in part.T.tolist())
            want = [
                (i, j)
                for i, a in enumerate(short)
                for j, b in enumerate(words)
                if j > i and one_edit(a, b) and (at_end or not (len(b) > len(a) and b.startswith(a)))
            ]
            assert found == sorted(want)
    acceptor = variants.Acceptor()
    root = acceptor.add(["aax", "abx", "bax", "bbx"])
    assert len(acceptor.arcs) == 4 and acceptor.size[root] == 4
