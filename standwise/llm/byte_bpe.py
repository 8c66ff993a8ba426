"""Byte-level BPE by backtracking over longest matches, for vocabularies given as ranks.

A text is split by a pattern; each piece is coded by itself. Merging from the lowest rank
up ends in the one sequence of tokens in which every two neighbours are compatible: coded
by merges, the bytes of the two give these two again. So a piece is read from the left:
take the longest token that begins here (one pass of an Aho-Corasick automaton over the
bytes, as Latin-1 letters, finds them all), if it is compatible with the token before it;
else try the next shorter one; if none is left, step back and shorten the token before.
A place from which no way led on is not tried again, so the steps are linear in the bytes.
Compatibility of two tokens is worked out from the merges that made them and remembered.
"""

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from standwise.llm.common import column, per_batch, texts

# Entries that a worker remembers at most of each kind; a full table is begun anew.
REMEMBERED = 400_000
# Longer strings are worked out each time.
LONG = 64
# A blank before something else: a piece always begins there, so texts can be cut there.
BEFORE_WORD = regex.compile(r"(?= \S)")
# Blanks that do not simply part two words.
ODD_BLANK = regex.compile(r" (?:\s|$)")


class _Known(dict):
    """Remembers what a function gave, up to a number of short keys."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key):
        value = self.find(key)
        if len(key) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class ByteBPE:
    """Encoder and decoder for ranks of byte strings, ids being the ranks.

    ``encode`` gives the ids of a text without special tokens; ``decode`` gives bytes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces_of = regex.compile(pattern).findall
        self.cuts_at_blanks = pattern.replace("\\", "").endswith(r"|s+(?!S)|s+") and all(
            f" ?{kind}+" in pattern for kind in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
        )
        self.names: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for name, rank in ranks.items():
            self.names[rank] = name
        for byte in range(256):
            if bytes([byte]) not in ranks:
                raise ValueError(f"byte {byte} is no token")
        self._learn_merges()
        self.lengths = [len(name) for name in self.names]
        self.bytes_ids = [ranks[bytes([byte])] for byte in range(256)]
        self.shorter = [self._next_shorter(token) for token in range(len(self.names))]
        self.ids_of_piece = _Known(self._encode_piece)
        self.ids_of_word = _Known(self._encode_word)
        self.ids_of_later_word = _Known(lambda word: self._encode_word(word, " "))

    def _learn_merges(self) -> None:
        """The two tokens that each token is merged from, and the automaton of all tokens
        of several bytes that merges can reach."""
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        reached = set()
        for name, rank in sorted(self.ranks.items(), key=lambda token: token[1]):
            if len(name) == 1:
                reached.add(name)
                continue
            for cut in range(len(name) - 1, 0, -1):
                left, right = name[:cut], name[cut:]
                if left in reached and right in reached:
                    pair = self.ranks[left], self.ranks[right]
                    if len(left) > 1 and pair[0] > rank or len(right) > 1 and pair[1] > rank:
                        continue
                    if self._compatible(*pair):
                        self.halves[rank] = pair
                        self.joined[pair] = rank
                        reached.add(name)
                        break
        # What was found while merges were missing may not hold with all of them.
        self.fits = {}
        self.automaton = ahocorasick.Automaton()
        for name in reached:
            if len(name) > 1:
                self.automaton.add_word(name.decode("latin-1"), (len(name), self.ranks[name]))
        self.automaton.make_automaton()
        self.reached = reached

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives these two again.

        At the seam, merges of higher and higher rank are undone on either side; a merge
        across the seam that comes before the last one undone would have been made first.
        """
        least, halves, joined = None, self.halves, self.joined
        while True:
            across = joined.get((left, right))
            if across is not None and (least is None or across < least):
                return False
            made_left = left if left in halves else -1
            made_right = right if right in halves else -1
            if made_left < 0 and made_right < 0:
                return True
            # Of equal merges the left one is made first, so undo the right one before it.
            if made_left > made_right:
                least = made_left
                left = halves[left][1]
            else:
                least = made_right + 1
                right = halves[right][0]

    def compatible(self, left: int, right: int) -> bool:
        """The same, remembered."""
        found = self.fits.get(left << 32 | right)
        if found is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            found = self.fits[left << 32 | right] = self._compatible(left, right)
        return found

    def _next_shorter(self, token: int) -> int:
        """The longest shorter token that a token begins with; -1 for a single byte."""
        name = self.names[token]
        for cut in range(len(name) - 1, 0, -1):
            if name[:cut] in self.reached:
                return self.ranks[name[:cut]]
        return -1

    def _backtrack(self, body: bytes) -> list[int]:
        longest = [self.bytes_ids[b] for b in body]
        for last, (length, token) in self.automaton.iter(body.decode("latin-1")):
            # Ends come in their order, so what stays is the longest token from a place.
            longest[last + 1 - length] = token
        lengths, fits, shorter = self.lengths, self.fits, self.shorter
        size, dead = len(body), set()
        found: list[int] = []
        at, token, before = 0, longest[0], -1
        while True:
            end = at + lengths[token]
            if end not in dead:
                good = before < 0 or fits.get(before << 32 | token)
                if good is None:
                    good = self.compatible(before, token)
                if good:
                    found.append(token)
                    if end == size:
                        return found
                    at, before, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                token = found.pop()
                at -= lengths[token]
                before = found[-1] if found else -1
                token = shorter[token]

    def _encode_piece(self, piece: str) -> bytes:
        body = piece.encode("utf-8", "replace")
        whole = self.ranks.get(body)
        ids = self._backtrack(body) if whole is None else [whole]
        return np.array(ids, "<u4").tobytes()

    def _encode_word(self, word: str, blank: str = "") -> bytes:
        """Ids of text that other pieces don't reach into, after a blank or not."""
        if self.cuts_at_blanks and word.isalpha():
            return self._encode_piece(blank + word)
        known = self.ids_of_piece
        return b"".join([known[p] for p in self.pieces_of(blank + word)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as little-endian unsigned 32-bit integers."""
        if not text:
            return np.empty(0, "<u4")
        if not self.cuts_at_blanks:
            return np.frombuffer(self._encode_word(text), "<u4")
        if ODD_BLANK.search(text) is None:
            first, *later = text.split(" ")
            known = self.ids_of_later_word
            return np.frombuffer(
                b"".join([self.ids_of_word[first], *[known[w] for w in later]]), "<u4"
            )
        known = self.ids_of_word
        return np.frombuffer(b"".join([known[w] for w in BEFORE_WORD.split(text)]), "<u4")

    def decode(self, ids) -> bytes:
        """Bytes of the ids; ids without a token are passed over."""
        names, n = self.names, len(self.names)
        return b"".join([names[i] for i in np.asarray(ids).tolist() if 0 <= i < n])


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBPE:
    """The coder of a rank file, built once per Python worker."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    return ByteBPE({base64.b64decode(name): int(rank) for name, rank in lines}, pattern)


def encode(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids): the token ids of every whole text.

    Nulls and empty texts give no ids; a null id stays null; repeated rows stay repeated; an
    empty table gives none; long texts and long pieces take steps in proportion to their
    length; further columns are not read. The rank file must lie at ``path`` on every machine.
    """

    def make():
        model = coder(path, pattern)

        def work(batch):
            bodies = batch.column("body").to_pylist()
            ids = [model.encode(b.decode("utf-8", "replace")).astype("i4") for b in bodies]
            return {"id": batch.column("id"), "ids": ids}

        return work

    found = per_batch(texts(df, id_col, text_col), "id long, ids array<int>", make)
    return found.withColumnRenamed("id", id_col)


def decode(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """(id, body): the bytes of each row's ids; null ids give no bytes. Bytes need not be
    whole characters, so they are not turned into text."""

    def make():
        model = coder(path, pattern)

        def work(batch):
            found = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            return {"id": batch.column("id"), "body": found}

        return work

    plain = df.select(
        column(id_col).cast("long").alias("id"), column(ids_col).cast("array<int>").alias("ids")
    )
    return per_batch(plain, "id long, body binary", make).withColumnRenamed("id", id_col)


def round_trip(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids, as decimal numbers joined
    by commas, and of the bytes decoded from them, in one pass, so that neither is shipped.
    Nulls, empty texts, repeated rows and empty tables are as in ``encode``."""

    def make():
        model = coder(path, pattern)
        numbers = [str(i) for i in range(len(model.names))]

        def work(batch):
            counts, ids_digest, text_digest = [], [], []
            for body in batch.column("body").to_pylist():
                ids = model.encode(body.decode("utf-8", "replace"))
                counts.append(len(ids))
                listed = ",".join([numbers[i] for i in ids.tolist()])
                ids_digest.append(hashlib.sha256(listed.encode()).hexdigest())
                text_digest.append(hashlib.sha256(model.decode(ids)).hexdigest())
            return {
                "id": batch.column("id"),
                "n_tokens": counts,
                "ids_sha256": ids_digest,
                "decoded_sha256": text_digest,
            }

        return work

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    found = per_batch(texts(df, id_col, text_col), schema, make)
    return found.withColumnRenamed("id", id_col)
