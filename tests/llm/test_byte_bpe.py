"""Byte-level BPE by backtracking against the tiktoken library."""

import base64
import hashlib
import random

import pytest
import tiktoken

import public_tokenizers
from standwise.llm import byte_bpe

BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENGLISH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, n_tokens string, ids int, body string"
ODD = [
    "",
    " ",
    "   ",
    "a  b   c ",
    "a\n b\n\n c\t d \n",
    "it's I'LL 'tis 's 'x",
    "日本語テキスト 🙂🙂👍🏽 \u3000x\x85y\xa0z \x1c\x1d\ufeff",
    "naïve façade e\u0301 ½12³ <|endoftext|>",
    "a" * 3000,
    "ab" * 3000 + " " + "ba" * 2000,
    " " * 500 + "x" + "-=" * 900,
]


def library(path):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def mixed(seed):
    draw = random.Random(seed)
    parts = [*"abcdeéèñß ABC 019 .,'!-\n\t\u00a0日🙂", " the", "ing", " de", "éé", "  "]
    return "".join(draw.choice(parts) for _ in range(draw.randint(0, 300)))


@pytest.mark.parametrize("path", [BYTES, ENGLISH])
def test_ids_and_bytes_are_the_library_s(path):
    own, tool = byte_bpe.coder(path, PATTERN), library(path)
    for text in [*ODD, *map(mixed, range(400))]:
        ids = tool.encode_ordinary(text)
        assert own.encode(text).tolist() == ids
        assert own.decode(ids) == text.encode()


def test_every_code_point():
    own, tool = byte_bpe.coder(BYTES, PATTERN), library(BYTES)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 64):
        text = "".join(f"a{chr(c)}{chr(c)}1 {chr(c)} b{chr(c)}  {chr(c)}\n" for c in points[low : low + 64])
        assert own.encode(text).tolist() == tool.encode_ordinary(text)


def merged(ranks, body):
    """Join the pair of lowest rank, leftmost first, until none is left."""
    parts = [body[i : i + 1] for i in range(len(body))]
    while True:
        pairs = [(ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(pairs, default=(1 << 60, 0))
        if rank == 1 << 60:
            return [ranks[p] for p in parts]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(8))
def test_small_vocabularies_merge_exactly(seed):
    """Vocabularies made of random merges, in which longest matches often mislead."""
    draw = random.Random(seed)
    names = [bytes([b]) for b in range(256)]
    ranks = {name: i for i, name in enumerate(names)}
    letters = [n for n in names if n in b"abc"]
    for _ in range(40):
        new = draw.choice(letters) + draw.choice(letters)
        if new not in ranks:
            ranks[new] = len(ranks)
            letters.append(new)
    own = byte_bpe.ByteBPE(ranks, PATTERN)
    for _ in range(300):
        body = bytes(draw.choices(b"abcd", k=draw.randint(1, 30)))
        found = own.encode(body.decode()).tolist()
        assert found == ([ranks[body]] if body in ranks else merged(ranks, body))


def test_steps_are_linear():
    own = byte_bpe.coder(BYTES, PATTERN)
    asked = []
    own_compatible = own._compatible
    own._compatible = lambda a, b: asked.append(1) or own_compatible(a, b)
    try:
        own.fits.clear()
        own._backtrack(b"abcabd" * 20_000)
    finally:
        own._compatible = own_compatible
    assert len(asked) < 5_000


def test_bytes_must_be_tokens():
    with pytest.raises(ValueError, match="no token"):
        byte_bpe.ByteBPE({b"a": 0}, PATTERN)


def test_tables(spark):
    tool = library(BYTES)
    texts = [*ODD, "word " * 40_000, "x" * 100_000]
    rows = [(i, t, "clash", 7, "x") for i, t in enumerate(texts)]
    rows += [(3, None, None, None, None), (None, "null id", "", 0, ""), rows[1], rows[6], rows[6]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = []
    for key, text, *_ in rows:
        ids = tool.encode_ordinary(text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((key, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    found = byte_bpe.round_trip(df, BYTES, PATTERN)
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(want, key=str)
    coded = byte_bpe.encode(df, BYTES, PATTERN)
    back = byte_bpe.decode(coded, BYTES, PATTERN)
    plain = sorted(((k, (t or "").encode()) for k, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, bytes(r.body)) for r in back.collect()), key=str) == plain
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(byte_bpe.decode(nulls, BYTES, PATTERN).first().body) == b""
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.round_trip(empty, BYTES, PATTERN).count() == 0
