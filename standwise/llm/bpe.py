"""BPE encoding and decoding, with words cut at symbol pairs that no token holds.

A merge joins two neighbouring symbols into a token of the vocabulary. A pair of symbols
that stands side by side inside no token can therefore never be joined: the place between
them is a certain cut. Words are cut there, the fragments are merged independently of
each other, and their ids are concatenated. Fragments repeat far more often than words, so
each task merges a fragment once and remembers its ids.

Normalising and splitting into words is left to the parts that the tokenizer file names.
"""

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from standwise.llm.common import column, per_batch, texts

# Entries that a worker remembers at most, of pieces and words and of fragments, in each of two
# generations: of a full table, what is asked for again goes into the next one.
REMEMBERED, REMEMBERED_FRAGMENTS = 150_000, 50_000
# Longer words and fragments are worked out each time.
LONG_WORD = 80
# Fragments up to this length are merged by scanning, longer ones with a heap.
SHORT_FRAGMENT = 48
# White space that every splitter agrees on; other kinds are left to the tokenizer's own parts.
PLAIN_SPACE = re.compile(r"[ \t\n\r\f\v]+")
# Fixed value: the pattern of tokenizer files whose words are runs of letters in lower case.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# White space that str.split() parts at beyond these; \x1c to \x1f are none to a tokenizer.
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Under that pattern: a run of Latin letters and one closing mark are two words as they stand.
LATIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([,.;:!?]?)")


def pieces_of(text: str) -> list[str]:
    """What stands between white space."""
    return text.split() if OTHER_SPACE.search(text) is None else PLAIN_SPACE.split(text)


class _Memory(dict):
    """A dictionary that fills itself, bounded in number and size of its entries."""

    def __init__(self, find, most: int = REMEMBERED):
        super().__init__()
        self.find, self.most, self.older = find, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        if len(key) <= LONG_WORD:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class ForcedBoundaryBPE:
    """Encoder and decoder for a byte-level BPE tokenizer file.

    ``encode`` gives the ids that the tokenizers library gives without special tokens,
    truncation and padding; ``decode`` gives its text with special tokens kept.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        for name in ("dropout", "unk_token", "byte_fallback", "ignore_merges"):
            if model.get(name):
                raise ValueError(f"{name} is not supported")
        if model.get("continuing_subword_prefix"):
            raise ValueError("continuing_subword_prefix is not supported")
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError("added tokens with stripping or normalising are not supported")
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(left, right): i for i, (left, right) in enumerate(merges)}
        self.joinable = self._pairs_inside_tokens()
        names = {i: token for token, i in self.vocabulary.items()} | {
            i: token for token, i in self.added.items()
        }
        self.names = [names.get(i) for i in range(max(names) + 1)]
        self.decoder = library.decoder
        self.plain_words = self._splits_at_white_space(spec)
        self.letter_runs = self.plain_words and self._letter_runs_in_lower_case(spec)
        alphabet = ByteLevel.alphabet()
        self.byte_names = [_byte_name(b) for b in range(256)]
        assert set(self.byte_names) == set(alphabet)
        self.fragment_ids = _Memory(self._merge, REMEMBERED_FRAGMENTS)
        self.word_ids = _Memory(self._encode_word)
        self.chunk_ids = _Memory(self._encode_chunk)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = (
            re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        )

    @staticmethod
    def _splits_at_white_space(spec: dict) -> bool:
        """Whether white space only parts words, so that its surroundings don't matter."""
        first = (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])[0]
        return (
            first["type"] == "Split"
            and first["behavior"] == "Removed"
            and first["invert"]
            and r"[^\s" in first["pattern"].get("Regex", "")
            and r"|\s" not in first["pattern"].get("Regex", "")
            and " ?" not in first["pattern"].get("Regex", "")
        )

    @staticmethod
    def _letter_runs_in_lower_case(spec: dict) -> bool:
        """Whether a run of letters is a word, and case and composition are all that changes."""
        steps = spec["normalizer"].get("normalizers", []) if spec["normalizer"] else []
        split, *more = spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]]
        return (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"}
            and split["pattern"].get("Regex") == LETTER_RUNS
            and [m["type"] for m in more] == ["ByteLevel"]
            and not more[0]["use_regex"]
            and not more[0]["add_prefix_space"]
        )

    def _symbols(self, word: str) -> list[str]:
        """The smallest symbols of a word or token; the last one carries the end of the word."""
        return [*word[:-1], word[-1] + self.suffix]

    def _pairs_inside_tokens(self) -> set[tuple[str, str]]:
        pairs = set()
        for token in self.vocabulary:
            if self.suffix and token.endswith(self.suffix) and token != self.suffix:
                symbols = self._symbols(token[: -len(self.suffix)])
            else:
                symbols = list(token)
            pairs.update(zip(symbols, symbols[1:]))
        return pairs

    def fragments(self, symbols: list[str]) -> list[tuple[str, ...]]:
        """The symbols, cut wherever a neighbouring pair is part of no token."""
        cuts = [i for i in range(1, len(symbols)) if (symbols[i - 1], symbols[i]) not in self.joinable]
        return [tuple(symbols[a:b]) for a, b in zip([0, *cuts], [*cuts, len(symbols)])]

    def _merge(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """Join the pair of lowest rank, leftmost first, until none is left."""
        if len(fragment) > SHORT_FRAGMENT:
            return self._merge_long(fragment)
        rank_of, none = self.rank.get, len(self.rank)
        parts = list(fragment)
        ranks = [rank_of(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) < none:
            i = ranks.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((parts[i], parts[i + 1]), none)
        ids = self.vocabulary
        return tuple([ids[p] for p in parts])

    def _merge_long(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """The same for long fragments, in n log n steps."""
        parts: list[str | None] = list(fragment)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        rank = self.rank
        heap = []
        for i, pair in enumerate(zip(fragment, fragment[1:])):
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = after[left]
            if parts[left] != pair[0] or right >= len(parts) or parts[right] != pair[1]:
                continue  # one of the two has been joined to something else
            parts[left], parts[right] = pair[0] + pair[1], None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            for a, b in ((before[left], left), (left, after[left])):
                if a >= 0 and b < len(parts) and (parts[a], parts[b]) in rank:
                    heapq.heappush(heap, (rank[parts[a], parts[b]], a, (parts[a], parts[b])))
        ids = self.vocabulary
        return tuple(ids[p] for p in parts if p is not None)

    def _encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word in the byte alphabet of the tokenizer."""
        symbols = [s for s in self._symbols(word) if s in self.vocabulary]
        found: tuple[int, ...] = ()
        for fragment in self.fragments(symbols):
            found += self.fragment_ids[fragment]
        return found

    def _encode_chunk(self, chunk: str) -> bytes:
        """Ids, as bytes, of text in which no added token needs to be looked for."""
        if self.letter_runs and (word := LATIN_WORD.fullmatch(chunk)):
            letters, mark = word.groups()
            letters = letters.lower()
            if not letters.isascii():
                letters = "".join([self.byte_names[b] for b in letters.encode()])
            ids = self.word_ids[letters]
            return np.array(ids + self.word_ids[mark] if mark else ids, "<u4").tobytes()
        text = self.normalizer.normalize_str(chunk) if self.normalizer else chunk
        words = self.pre_tokenizer.pre_tokenize_str(text) if self.pre_tokenizer else [(text, None)]
        ids: list[int] = []
        for word, _ in words:
            if word:
                ids.extend(self.word_ids[word])
        return np.array(ids, "<u4").tobytes()

    def _encode_plain(self, text: str) -> bytes:
        if not self.plain_words:
            return self._encode_chunk(text)
        memory = self.chunk_ids
        return b"".join([memory[c] for c in pieces_of(text)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as little-endian unsigned 32-bit integers."""
        if self.added_pattern is None or self.added_pattern.search(text) is None:
            return np.frombuffer(self._encode_plain(text), "<u4")
        found = []
        for i, piece in enumerate(self.added_pattern.split(text)):
            found.append(
                np.array([self.added[piece]], "<u4").tobytes() if i % 2 else self._encode_plain(piece)
            )
        return np.frombuffer(b"".join(found), "<u4")

    def decode(self, ids) -> str:
        """Text of the ids, special tokens kept; ids without a token are passed over."""
        names, n = self.names, len(self.names)
        tokens = [names[i] for i in np.asarray(ids).tolist() if i < n]
        tokens = [t for t in tokens if t is not None]
        return " ".join(tokens) if self.decoder is None else self.decoder.decode(tokens)


def _byte_name(byte: int) -> str:
    """The letter that stands for a byte in byte-level tokens: itself where it is printable,
    else the next free one from U+0100 on, in the order of the bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    if byte in printable:
        return chr(byte)
    return chr(256 + sum(1 for b in range(byte) if b not in printable))


@lru_cache(maxsize=2)
def coder(path: str) -> ForcedBoundaryBPE:
    """The coder of a file, built once per Python worker."""
    return ForcedBoundaryBPE(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text.

    Nulls and empty texts give no ids; a null id stays null; repeated rows stay repeated;
    an empty table gives none. The tokenizer file must lie at ``path`` on every machine.
    """

    def make():
        model = coder(path)

        def work(batch):
            bodies = batch.column("body").to_pylist()
            ids = [model.encode(b.decode("utf-8", "replace")).astype("i4") for b in bodies]
            return {"id": batch.column("id"), "ids": ids}

        return work

    return per_batch(texts(df, id_col, text_col), "id long, ids array<int>", make).withColumnRenamed(
        "id", id_col
    )


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the text of each row's ids; null ids give an empty text."""

    def make():
        model = coder(path)

        def work(batch):
            return {
                "id": batch.column("id"),
                "text": [model.decode(ids or []) for ids in batch.column("ids").to_pylist()],
            }

        return work

    plain = df.select(
        column(id_col).cast("long").alias("id"), column(ids_col).cast("array<int>").alias("ids")
    )
    return per_batch(plain, "id long, text string", make).withColumnRenamed("id", id_col)


def round_trip(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of ids and of the text decoded from
    them, in one pass, so that neither is shipped."""

    def make():
        model = coder(path)

        def work(batch):
            counts, ids_digest, text_digest = [], [], []
            for body in batch.column("body").to_pylist():
                ids = model.encode(body.decode("utf-8", "replace"))
                counts.append(len(ids))
                ids_digest.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text = model.decode(ids).encode("utf-8", "replace")
                text_digest.append(hashlib.sha256(text).hexdigest())
            return {
                "id": batch.column("id"),
                "n_tokens": counts,
                "ids_sha256": ids_digest,
                "decoded_sha256": text_digest,
            }

        return work

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_batch(texts(df, id_col, text_col), schema, make).withColumnRenamed("id", id_col)
