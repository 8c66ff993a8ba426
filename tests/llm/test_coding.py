"""BPE coding and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from standwise.llm import bpe, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "a" * 300,
    "a" * 300 + "b " + "a" * 301,
    "Hello <|endoftext|>x İSTANBUL ΣΑΣ ß ﬁ 12½ \u2003b\x85c\u1680d e\u0301 'll don't I'M",
    "日本語テキスト 🙂🙂👍🏽",
    "x\x00y\x1cz \x1d",
    "É E\u0301, e\u0301. É ~ it's IT'S",
    "\ufeff\u200b zero\u00a0width",
    "Naïve, façade! Ünder; straße? ab,cd ab. ab",
    "<|startoftext|><|endoftext|> <|endoftext|",
]
SCHEMA = "doc_id long, text string, n_tokens string, ids int, row string"


def library(path):
    tool = Tokenizer.from_file(path)
    tool.no_padding()
    tool.no_truncation()
    return tool


def mixed(seed):
    draw = random.Random(seed)
    letters = "abcdeéèñß ABC 019 .,'!-\n\t\u00a0日🙂"
    return "".join(draw.choice(letters) for _ in range(draw.randint(0, 400)))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_and_text_are_the_library_s(path):
    own, tool = bpe.ForcedBoundaryBPE(path), library(path)
    for text in [*ODD, *map(mixed, range(60))]:
        ids = tool.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(ids) == tool.decode(ids, skip_special_tokens=False)


def test_fragments_are_cut_where_no_token_goes():
    own = bpe.ForcedBoundaryBPE(WORDS)
    word = own._symbols("zqxjvstrength")
    parts = own.fragments(word)
    assert [s for p in parts for s in p] == word and len(parts) > 1
    for left, right in zip(parts, parts[1:]):
        pair = left[-1] + right[0]
        ends = pair.endswith("</w>")
        assert not any(t.endswith(pair) if ends else pair in t.removesuffix("</w>")[:-1] for t in own.vocabulary)


def test_long_fragments_merge_like_short_ones():
    own = bpe.ForcedBoundaryBPE(WORDS)
    draw = random.Random(3)
    for _ in range(50):
        fragment = tuple(own._symbols("".join(draw.choice("aeinrst") for _ in range(40))))
        assert own._merge(fragment) == own._merge_long(fragment)


def rows_of(texts):
    rows = [(i, t, "clash", 7, "x") for i, t in enumerate(texts)]
    return [*rows, (3, None, None, None, None), (None, "null id", "", 0, ""), rows[1], rows[1]]


def test_round_trip_of_a_table(spark):
    tool = library(WORDS)
    rows = rows_of(ODD)
    found = bpe.round_trip(spark.createDataFrame(rows, SCHEMA), WORDS).collect()
    want = []
    for key, text, *_ in rows:
        ids = tool.encode(text or "", add_special_tokens=False).ids
        plain = tool.decode(ids, skip_special_tokens=False).encode()
        data = np.array(ids, "<u4").tobytes()
        digests = (hashlib.sha256(data).hexdigest(), hashlib.sha256(plain).hexdigest())
        want.append((key, len(ids), *digests))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_encode_and_decode_tables(spark):
    df = spark.createDataFrame(rows_of(ODD), SCHEMA)
    ids = bpe.encode(df, WORDS)
    tool = library(WORDS)
    for row in ids.join(df.select("doc_id", "text"), "doc_id").where("doc_id <> 3").collect():
        assert row.ids == tool.encode(row.text or "", add_special_tokens=False).ids
    back = bpe.decode(ids.where("doc_id = 4"), WORDS).first().text
    assert back == tool.decode(tool.encode(ODD[4]).ids, skip_special_tokens=False)


def test_library_coder_remembers_right(monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY", 30)
    own, tool = token_files.LibraryCoder(WORDS), library(WORDS)
    own.GROUP_BYTES = 64
    texts = [*ODD, *map(mixed, range(80)), *ODD]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert ids.tolist() == tool.encode(text, add_special_tokens=False).ids
    whole = token_files.LibraryCoder(BYTES)
    for text, ids in zip(texts, whole.encode([t.encode() for t in texts])):
        assert ids.tolist() == library(BYTES).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files(spark, tmp_path, parts):
    tool, rows = library(WORDS), rows_of(ODD)
    folder = f"file://{tmp_path}/set"
    manifest = token_files.write(spark.createDataFrame(rows, SCHEMA), folder, WORDS, 1, parts)
    total = manifest.agg(F.sum("n_tokens")).first()[0]
    found = token_files.read(spark, folder).orderBy("start").collect()
    want = sorted(
        (-1 if k is None else k, [*tool.encode(t or "", add_special_tokens=False).ids, 1])
        for k, t, *_ in rows
    )
    assert [-1 if r.doc_id is None else r.doc_id for r in found] == [k for k, _ in want]
    assert sum(len(i) for _, i in want) == total
    at = 0
    sums = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for row in found:
        assert row.start == at
        at += row.n_tokens
    assert sorted((r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (len(i), sums(i)) for _, i in want
    )
    first = manifest.orderBy("part").first()
    part = token_files.Part(folder, first.part, first.bytes_per_id)
    assert isinstance(part.ids, np.memmap) and len(part) == first.n_docs
    assert part[0].tolist()[-1] == 1 and part.ids.dtype == np.uint16


def test_token_files_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    token_files.write(empty, f"file://{tmp_path}/set", WORDS, 1)
    assert token_files.read(spark, f"file://{tmp_path}/set").count() == 0


def test_large_end_id_takes_four_bytes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    manifest = token_files.write(df, str(tmp_path / "set"), WORDS, 70000)
    row = manifest.first()
    assert row.bytes_per_id == 4
    assert token_files.Part(str(tmp_path / "set"), row.part, 4)[0].tolist()[-1] == 70000
