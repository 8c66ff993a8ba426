"""Near duplicates, line dedup and suffix dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from standwise.llm import line_dedup, minhash, suffix_dedup
from standwise.llm.components import components

SCHEMA = "doc_id long, text string, source string, n_shingles string, row int, span string, id int"


def table(spark, rows):
    return spark.createDataFrame([(k, t, s, "x", 1, "y", 2) for k, t, s in rows], SCHEMA)


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups_by_brute_force(docs):
    """(id, set size, component) of rows with unique ids."""
    sets = {k: sets_of(t) for k, t in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 100 * min(len(sets[a]), len(sets[b])) < 75 * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {(k, len(s), find(k)) for k, s in sets.items()}


def copies(seed, n_sources, n_copies, words=90):
    """Texts with copies that differ in a few words, or in enough to fall short."""
    draw = random.Random(seed)
    out = []
    for _ in range(n_sources):
        source = [f"W{draw.randint(0, 400)}" for _ in range(words)]
        out.append(source)
        for _ in range(n_copies):
            copy = list(source)
            for _ in range(draw.choice([0, 1, 2, 3, 4, 5])):
                copy[draw.randrange(words)] = f"n{draw.randint(0, 10**6)}"
            out.append(copy)
    draw.shuffle(out)
    return [" ".join(w) for w in out]


def test_near_duplicates(spark):
    docs = list(enumerate(copies(4, 12, 14)))
    docs += [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE  two"), (905, "one two")]
    docs += [(906, "a b c d e"), (907, "a b c d e f"), (908, "É a"), (909, "é a")]
    found = minhash.near_duplicates(table(spark, [(k, t, "") for k, t in docs]).repartition(5)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == groups_by_brute_force(docs)
    assert len(found) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_cluster_around_the_threshold(spark):
    """Many copies of one source, most of them too far from each other."""
    docs = list(enumerate(copies(8, 1, 300, words=60)))
    found = minhash.near_duplicates(table(spark, [(k, t, "") for k, t in docs])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == groups_by_brute_force(docs)


def test_repeated_and_missing_ids(spark):
    text = "a b c d e f g"
    rows = [(5, text, ""), (5, text, ""), (7, text, ""), (None, text, ""), (9, "other words", "")]
    found = [
        (r.doc_id, r.component_id, r.kept)
        for r in minhash.near_duplicates(table(spark, rows)).collect()
    ]
    assert sorted(found, key=str) == sorted(
        [(5, 5, True), (5, 5, True), (7, 5, False), (None, None, True), (9, 9, True)], key=str
    )
    kept = minhash.drop_near_duplicates(table(spark, rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "5", "9", "None"]
    assert kept.columns == table(spark, rows).columns
    assert minhash.near_duplicates(table(spark, [])).count() == 0


def test_one_id_with_different_texts(spark):
    """What goes with an id in one group does not go in another."""
    a, b, c = ("a b c d e f g h i j k l m n o p", "other words that stand alone here", "a b c d e f g h i j k l m n o p q")
    rows = [(3, a, ""), (5, a, ""), (5, b, ""), (8, b, ""), (2, c, ""), (9, c, ""), (9, "x", ""), (9, "x", "")]
    found = minhash.near_duplicates(table(spark, rows)).collect()
    got = sorted((r.doc_id, r.component_id, r.kept) for r in found)
    assert got == sorted(
        [(2, 2, True), (3, 2, False), (5, 2, False), (5, 5, True), (8, 5, False), (9, 2, False), (9, 9, True), (9, 9, True)]
    )
    kept = minhash.drop_near_duplicates(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(2, c), (5, b), (9, "x"), (9, "x")]
    odd = table(spark, rows).withColumnRenamed("doc_id", "doc.id").withColumnRenamed("text", "te`xt")
    assert minhash.drop_near_duplicates(odd, "doc.id", "te`xt").count() == 4


def test_similar_is_exact_at_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    for both in range(70, 101):
        b = np.concatenate([a[:both], np.arange(1000, 1000 + 100 - both, dtype=np.uint64)])
        assert minhash.similar(a, np.sort(b)) == (100 * both >= 75 * (200 - both))


def test_tables_are_all_pairs_of_bands():
    sketcher = minhash.Sketcher(4, 2)
    draw = np.random.default_rng(1)
    keys = sketcher.keys(np.unique(draw.integers(0, 2**63, 500).astype(np.uint64)))
    assert len(keys) == 8 and len(set(keys.tolist())) == 8
    assert len(sketcher.flip) == 2 * 4 * 2  # sixteen minhashes key sixteen tables of four


def test_components(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (200, 150), (150, 120)]
    pairs += [(300, 300 + draw.randint(1, 40)) for _ in range(50)]
    draw.shuffle(pairs)
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def lines_by_brute_force(rows, ratio, least, whole_above, copies_once=False):
    pages, hosts, met = {}, {}, set()
    for _, text, host in rows:
        if host is None or copies_once and (host, text) in met:
            continue
        met.add((host, text))
        hosts[host] = hosts.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} if text is not None else ():
            pages[host, line] = pages.get((host, line), 0) + 1
    out = []
    for key, text, host in rows:
        if text is None or host is None:
            out.append((key, text))
            continue
        lines = text.split("\n")
        often = lambda x: pages[host, x] >= least and pages[host, x] > ratio * hosts[host]
        rest = [x for x in lines if not x.strip(" ") or not often(x.strip(" "))]
        lost = sum(map(len, lines)) - sum(map(len, rest))
        some = any(x.strip(" ") for x in rest)
        fits = some and lost <= whole_above * sum(map(len, lines))
        out.append((key, "\n".join(rest) if fits else text))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_of_texts(spark, seed):
    draw = random.Random(seed)
    lines = ["menu", " menu ", "", "  ", "foot é", "own", "\tmenu"] + [f"line {i}" for i in range(30)]
    rows = [
        (i, "\n".join(draw.choice(lines) for _ in range(draw.randint(1, 9))), draw.choice(["a", "a", "a", "b", None]))
        for i in range(120)
    ]
    rows += [(200, None, "a"), (201, "", "a"), (202, "menu\nmenu", "a"), (203, "menu", "c"), rows[0], rows[0]]
    found = line_dedup.dedup_texts(table(spark, rows), ratio=0.2)
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    assert got == lines_by_brute_force(rows, 0.2, 3, 0.5)
    assert found.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert line_dedup.dedup_texts(table(spark, [])).count() == 0


def test_short_texts_under_a_long_footer_lose_it(spark):
    foot = "all rights reserved " * 9
    rows = [(i, f"own {i}\n{foot}", "a") for i in range(5)]
    # Copies of one text make none of its lines frequent.
    rows += [(10 + i, "copied one\ncopied two", "b") for i in range(5)] + [(20, "copied one\nother", "b")]
    rows += [(30, foot, "a"), (31, None, "a")]
    found = line_dedup.dedup_texts(table(spark, rows), whole_above=1.0, copies_once=True)
    want = {k: f"own {k}" if k < 5 else t for k, t, _ in rows}
    assert {r.doc_id: r.text for r in found.collect()} == want
    df = table(spark, rows).withColumn("n_chars", F.lit(0))
    staged = corpus_pipeline.drop_lines(spark, df, "")
    assert {r.doc_id: r.text for r in staged.collect()} == want


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "http://a.b/c", "<p>x</p>")], "page_id long, url string, html string")
    for out in (line_dedup.dedup_pages(df), line_dedup.dedup_texts(table(spark, [(1, "a", "b")]))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_lines_of_pages(spark):
    menu = "<ul><li>Home</li>\n<li> About&nbsp;us</li></ul>"
    rows = [
        (i, f"https://U:p@Site.example:80/{i}?x#y", f"<html><script>var a='<p>';</script>{menu}<!-- <p>no</p> --><p>Text {i}<br/>more {i} <b>bold</b></p></html>", 1)
        for i in range(4)
    ]
    rows += [(9, None, f"{menu}<p>alone", 1), (10, "no host", None, 1), (11, "http://other.example/", menu, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    found = {r.page_id: r for r in line_dedup.dedup_pages(df, ratio=0.5).collect()}
    assert found[2].text == "Text 2\nmore 2 bold" and found[2].host == "site.example"
    assert (found[2].n_lines, found[2].n_dropped) == (4, 2)
    assert found[9].text == "Home\nAbout&nbsp;us\nalone" and found[9].host is None
    assert (found[10].text, found[10].n_lines) == ("", 0)
    assert found[11].n_dropped == 0


def repeats_by_brute_force(docs):
    """(id, n_bytes, n_removed, n_spans, digest) of rows; null ids come last."""
    first = {}
    rank = lambda k: float("inf") if k is None else k
    for key, text in docs:
        body = (text or "").encode()
        for i in range(len(body) - 49):
            gram = body[i : i + 50]
            first[gram] = min(first.get(gram, float("inf")), rank(key))
    out = []
    for key, text in docs:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - 49):
            if first[body[i : i + 50]] < rank(key):
                gone[i : i + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        out.append((key, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def shared_passages(seed):
    draw = random.Random(seed)
    pool = ["".join(draw.choice("ab é") for _ in range(draw.randint(30, 160))) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 5)):
            parts.append(draw.choice(pool)[draw.randint(0, 20) :])
            parts.append("".join(draw.choice("xyz") for _ in range(draw.randint(0, 70))))
        docs.append((i, "".join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup(spark, seed):
    docs = shared_passages(seed)
    docs += [(60, "xyxy" + "ab c" * 90), (61, "ab c" * 40 + "q" + "ab c" * 50), (62, "éé" * 70)]
    docs += [(63, "b" + "éé" * 60 + "ab c" * 30), (70, None), (71, ""), (72, "a" * 49), (73, "a" * 50), (74, "a" * 400), (75, "ab" * 300), (76, "ab" * 40)]
    docs += [(None, docs[3][1] + "q" * 60), (None, "q" * 60), (5, docs[5][1]), (5, docs[6][1] + docs[9][1])]
    df = table(spark, [(k, t, "") for k, t in docs]).repartition(4)
    found = suffix_dedup.remove_repeats(df)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()]
    assert sorted(got, key=str) == repeats_by_brute_force(docs)
    assert suffix_dedup.remove_repeats(table(spark, [])).count() == 0


def test_without_repeats_texts_stay(spark):
    found = suffix_dedup.remove_repeats(table(spark, [(1, "abc" * 9, ""), (2, "x" * 60, "")]))
    assert {r.doc_id: bytes(r.kept).decode() for r in found.collect()} == {1: "abc" * 9, 2: "x" * 60}


@pytest.mark.parametrize("held,batch", [(10**6, 3), (4, 3), (0, 1)])
def test_names_that_go_on_over_batches(monkeypatch, held, batch):
    """A group cut by batches and by the limit of rows held gives a superset of the runs to
    look into, and the same repeats."""
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    draw = random.Random(held)
    rows = sorted({(draw.randint(0, 3), draw.randint(0, 4), draw.randint(0, 2), draw.randint(0, 5), draw.randint(0, 3) << 33 | 5 << 1) for _ in range(60)})
    columns = [np.array(x, np.int64) for x in zip(*rows)]
    columns.append(np.ones(len(rows), np.int64))

    def told(parts):
        reader, found = suffix_dedup._Reader(True), {0: set(), 1: set()}
        for part, whole in parts:
            for out in reader.read(part, whole):
                for row in out.to_pylist():
                    found[row["kind"]].add((row["name"], row["id"], row["span"] >> 33))
        return found

    whole = told([(columns, True)])
    cuts = range(0, len(rows), batch)
    parts = [([c[i : i + batch] for c in columns], False) for i in cuts]
    cut = told(parts)
    assert cut[0] == whole[0] and cut[1] >= whole[1]


def test_equal_steps_are_sent_once():
    start = np.array([3, 10, 17, 24, 40, 41, 43, 50, 57, 64, 3, 5])
    key = np.array([1] * 10 + [2, 2])
    one = np.full(12, 7, np.uint64)
    out = suffix_dedup._rows(one, one, one, key, suffix_dedup._span(start, 0, 2))
    span, times = out.column("span").to_numpy(), out.column("times").to_numpy()
    assert out.num_rows < 8
    back, count = suffix_dedup._unspan(span, times)
    assert sorted(back.tolist()) == sorted(start.tolist()) and set(count.tolist()) == {2}
    settled = (span & 1 == 1).tolist()
    assert settled == [k == 2 for k in out.column("id").to_pylist()]


def test_runs_cover_every_string_once():
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    _, _, _, start, count, place = suffix_dedup.runs(data)
    assert place.min() >= 0 and place.max() < suffix_dedup.REACH
    assert np.concatenate([np.arange(s, s + n) for s, n in zip(start, count)]).tolist() == list(range(4951))
    assert count.max() <= suffix_dedup.REACH


def test_runs_whose_short_names_collide_are_no_repeats(spark):
    """Two strings around one anchor of 16 bytes; 43 bits of their runs' names are equal."""
    one = "mgjwmkzkcubkzagtgbvodgvfqbcbrftlkgguuxljjhvwbqmecc"
    two = "jgxujmczsviqioqanbvodgvfqbcbrftlkwzvrvqenmfahmownq"
    df = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.remove_repeats(df).collect()] == [0, 0]


def test_repeats_across_the_seam_of_pieces(spark, monkeypatch):
    """Texts are worked on piece by piece; a repeat may lie over a seam on either side."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 128)
    draw = random.Random(12)
    passage = "".join(draw.choices("abcdefgh", k=300))
    docs = [(i, "".join(draw.choices("ijklmnop", k=draw.randint(0, 200))) + passage[i : 300 - i]) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(df).select(*columns).collect()), key=str)
    assert got == repeats_by_brute_force(docs)


def test_only_white_space_that_changes_is_matched(spark):
    draw = random.Random(8)
    texts = ["".join(draw.choice("a  \t\r\x0b\f\n") for _ in range(draw.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in [*texts, "a b c", " "]], "text string")
    want = F.regexp_replace("text", r"[ \t\r\x0B\f]+", " ")
    got = F.regexp_replace("text", line_dedup.WHITE, " ")
    assert df.where(want != got).count() == 0
    assert re.search(line_dedup.WHITE, " a b c ") is None


def test_parted_patterns_match_the_same(spark):
    draw = random.Random(9)
    names = ("address article aside blockquote body br dd div dl dt footer form head header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul h1 h6").split()
    names += ["script", "style"] * 12 + ["h7", "script", "style", "b", "preface", "heade", "theads", "d", "t", "!--", "--"]
    parts = ["<", "</", ">", " ", "/", "\n", "x", *["-->", "<!--"] * 12, *names]
    made = lambda: "".join(
        f"<{draw.choice(['', '/'])}{draw.choice([str.upper, str])(draw.choice(names))}{draw.choice(['', ' a=1', '/', 'x'])}>"
        if draw.random() < 0.6
        else draw.choice(parts)
        for _ in range(draw.randint(1, 14))
    )
    df = spark.createDataFrame([(made(),) for _ in range(6000)], "text string")
    for old, new in (("NOT_TEXT", "NOT_TEXT_PARTED"), ("BLOCKS", "BLOCKS_PARTED")):
        want, got = (F.regexp_replace("text", getattr(line_dedup, x), "|") for x in (old, new))
        assert df.where(want != got).count() == 0 and df.where(want != F.col("text")).count() > 200
