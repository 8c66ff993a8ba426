"""Benchmark decontamination with a generalised suffix automaton over words.

Words are runs of digits, ASCII letters (lower-cased) and everything beyond ASCII. The test
items are cut into windows of consecutive words; a shorter item is one window. The automaton
of all items follows the words of a document and knows at each word the longest stretch
ending there that some item holds, and so every window that ends there.

The items are taken in blocks of at most BLOCK_WORDS words, each with an automaton of its
own, so what a worker holds does not grow with the benchmark; the documents pass through
the blocks one after another and gather their hits.
"""

import hashlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standwise.llm.common import bounded, carried, column, texts
from standwise.sources.staging import stage

WINDOW = 13
# Share of its words, as a fraction, from which a document counts as contaminated.
COVERAGE = (1, 20)
# Words that one automaton is built from at most, and words of one piece of an item.
BLOCK_WORDS = 200_000
PIECE_WORDS = 50_000

# ASCII letters in lower case, digits and bytes beyond ASCII stay; the rest parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_WORD_BYTES).split()


def word_places(body: bytes) -> np.ndarray:
    """(start, end) byte offsets of the words."""
    inside = np.frombuffer(body.translate(_WORD_BYTES), np.uint8) != 32
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], axis=1)


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, each given with the name of its item."""

    def __init__(self, pieces: list[tuple[str, list[bytes], int]], window: int = WINDOW):
        """pieces: name, words, and the length of the item's windows."""
        self.vocabulary: dict[bytes, int] = {}
        sequences = []
        for name, words, length in pieces:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            sequences.append((name, ids, length))
        self.size = max(1, len(self.vocabulary))
        self.step: dict[int, int] = {}  # state * size + word -> state
        self.link, self.length = [-1], [0]
        self._out: list[list[int]] = [[]]  # words that lead out of a state, while building
        for _, ids, _ in sequences:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        del self._out
        self._mark(sequences)

    def _extend(self, last: int, word: int) -> int:
        size, step, link, length = self.size, self.step, self.link, self.length
        known = step.get(last * size + word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, word, known)
        new = self._state(length[last] + 1, 0)
        at = last
        while at >= 0 and at * size + word not in step:
            self._lead(at, word, new)
            at = link[at]
        if at >= 0:
            known = step[at * size + word]
            link[new] = (
                known if length[known] == length[at] + 1 else self._split(at, word, known)
            )
        return new

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.length) - 1

    def _lead(self, state: int, word: int, to: int) -> None:
        if state * self.size + word not in self.step:
            self._out[state].append(word)
        self.step[state * self.size + word] = to

    def _split(self, at: int, word: int, known: int) -> int:
        """A state for the shorter strings of ``known``, reached from ``at`` and its suffixes."""
        size, step, link = self.size, self.step, self.link
        new = self._state(self.length[at] + 1, link[known])
        for w in self._out[known]:
            self._lead(new, w, step[known * size + w])
        link[known] = new
        while at >= 0 and step.get(at * size + word) == known:
            step[at * size + word] = new
            at = link[at]
        return new

    def _mark(self, sequences) -> None:
        """Note, at the state that holds it, each window with the items that have it."""
        marks: dict[int, dict[int, set[str]]] = {}
        pairs = set()
        for name, ids, length in sequences:
            pairs.update(a * self.size + b for a, b in zip(ids, ids[1:]))
            state = 0
            for i, word in enumerate(ids):
                state = self.step[state * self.size + word]
                if i + 1 >= length:
                    at = state
                    while self.length[self.link[at]] >= length:
                        at = self.link[at]
                    marks.setdefault(at, {}).setdefault(length, set()).add(name)
        self.marks = marks
        self.pairs = np.array(sorted(pairs), np.int64)
        self.shortest = min((length for _, _, length in sequences), default=0)
        self._ending: dict[int, list[tuple[int, set[str]]]] = {}

    def _windows_ending(self, state: int) -> list[tuple[int, set[str]]]:
        """Windows that are suffixes of the state's longest string, longest first."""
        found = self._ending.get(state)
        if found is None:
            found, at = [], state
            while at > 0:
                found += self.marks.get(at, {}).items()
                at = self.link[at]
            found.sort(key=lambda pair: -pair[0])
            self._ending[state] = found
        return found

    def _stretches(self, ids: np.ndarray) -> np.ndarray:
        """(start, end) of runs of words whose neighbours also stand together in an item.

        No match of two words or more reaches beyond such a run, so each is followed alone.
        """
        if self.shortest < 2:
            good = ids >= 0
        else:
            pairs = ids[:-1] * self.size + ids[1:]
            place = np.searchsorted(self.pairs, pairs)
            place[place == len(self.pairs)] = 0
            good = (ids[:-1] >= 0) & (ids[1:] >= 0) & (self.pairs[place] == pairs)
        edges = np.diff(good.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if self.shortest >= 2:
            ends = ends + 1
        long_enough = ends - starts >= self.shortest
        return np.stack([starts[long_enough], ends[long_enough]], axis=1)

    def follow(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged word ranges [start, end) inside windows, and the items that have them."""
        spans: list[list[int]] = []
        items: set[str] = set()
        if not self.shortest or len(words) < self.shortest:
            return spans, items
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        step, size, link, lengths = self.step, self.size, self.link, self.length
        for start, end in self._stretches(ids).tolist():
            state = matched = 0
            for i, word in enumerate(ids[start:end].tolist(), start):
                while state and state * size + word not in step:
                    state = link[state]
                    matched = lengths[state]
                to = step.get(state * size + word)
                if to is None:
                    continue
                state, matched = to, matched + 1
                if matched < self.shortest:
                    continue
                hit = 0
                for length, names in self._windows_ending(state):
                    if length <= matched:
                        hit = hit or length
                        items |= names
                if hit:
                    first = i + 1 - hit
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append([first, i + 1])
        return spans, items


def _pieces(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words, length, n): items cut into overlapping pieces with the same windows."""

    def run(batches):
        for batch in batches:
            found = []
            for item, body in zip(batch.column("item").to_pylist(), batch.column("body").to_pylist()):
                words = words_of(body)
                length = min(window, len(words))
                for low in range(0, max(0, len(words) - window + 1) or min(1, length), PIECE_WORDS):
                    part = words[low : low + PIECE_WORDS + window - 1]
                    found.append((item, b" ".join(part), length, len(part)))
            names = ["item", "words", "length", "n"]
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
            columns = [pa.array([r[i] for r in found], kinds[i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    name = F.coalesce(column(id_col).cast("string"), F.lit("")).alias("item")
    bounded(benchmark.sparkSession)
    body = F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body")
    return benchmark.select(name, body).mapInArrow(
        run, "item string, words binary, length int, n long"
    )


@lru_cache(maxsize=1)
def _automaton(digest: str, pieces) -> SuffixAutomaton:
    return SuffixAutomaton([(name, words.split(), n) for name, words, n in pieces.value])


class _Block:
    """Broadcast pieces; workers build the automaton once for each block they see."""

    def __init__(self, spark, pieces: list[tuple[str, bytes, int]]):
        self.shared = spark.sparkContext.broadcast(pieces)
        self.digest = hashlib.sha256(repr(pieces).encode()).hexdigest()

    def automaton(self) -> SuffixAutomaton:
        return _automaton(self.digest, self.shared)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> list[_Block]:
    pieces = stage(_pieces(benchmark, id_col, text_col, window))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    count = -(-total // BLOCK_WORDS)
    spread = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, count))))
    blocks = []
    for block in range(count):
        rows = spread.where(F.col("block") == block).orderBy("item", "words").collect()
        blocks.append(
            _Block(benchmark.sparkSession, [(r.item, bytes(r.words), r.length) for r in rows])
        )
    return blocks


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


_HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _pass(rows: DataFrame, field: str | None, block: _Block | None, first: bool) -> DataFrame:
    """Add one block's hits to those gathered so far; ``field`` names the text in ``row``."""
    kept = [f for f in rows.schema.fields if f.name not in _HITS.fieldNames()]
    schema = T.StructType(kept + _HITS.fields)

    def run(batches):
        automaton = block.automaton() if block else SuffixAutomaton([])
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            if field is None:
                bodies = batch.column("body")
            else:
                bodies = pc.cast(batch.column("row").field(field), pa.binary())
            n_words, spans, items = [], [], []
            for i, body in enumerate(bodies.to_pylist()):
                words = words_of(body or b"")
                ranges, names = automaton.follow(words)
                if not first:
                    ranges = _merged(ranges + batch.column("spans")[i].as_py())
                    names |= set(batch.column("items")[i].as_py())
                n_words.append(len(words))
                spans.append(ranges)
                items.append(sorted(names))
            found = {"n_words": n_words, "spans": spans, "items": items}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found[f.name], f.type) if f.name in found else batch.column(f.name)
                    for f in kinds
                ],
                schema=kinds,
            )

    return rows.mapInArrow(run, schema)


def _hits(rows: DataFrame, field: str | None, blocks: list[_Block]) -> DataFrame:
    out = _pass(rows, field, blocks[0] if blocks else None, True)
    for block in blocks[1:]:
        out = _pass(stage(out), field, block, False)
    return out


def _n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def _contaminated(coverage: tuple[int, int]) -> Column:
    part, whole = coverage
    return (F.col("n_hit") > 0) & (F.col("n_hit") * whole >= F.col("n_words") * part)


def hits(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    coverage: tuple[int, int] = COVERAGE,
) -> DataFrame:
    """(id, n_words, n_hit, spans, items, contaminated) for every row.

    spans are merged ranges [start, end) of words inside windows of items; items are the
    names of the items met, as strings in their order. contaminated: some word is hit, and
    at least ``coverage`` of all words. Null and empty texts have no words and are clean;
    items without words have no windows; items of one name count once; repeated rows stay
    repeated; without items nothing is hit.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, window)
    found = _hits(texts(df, id_col, text_col), None, blocks).withColumn("n_hit", _n_hit())
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        "spans",
        "items",
        _contaminated(coverage).alias("contaminated"),
    )


def clean(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    coverage: tuple[int, int] = COVERAGE,
    longest_span: int | None = None,
) -> DataFrame:
    """The rows that are not contaminated, with all their columns.

    A row goes if its hit words reach ``coverage`` of its words. In the rows that stay,
    hit spans of more than ``longest_span`` words are cut out of the text; None leaves
    the texts as they are. Nulls stay null.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, window)
    found = _hits(carried(df), text_col, blocks).withColumn("n_hit", _n_hit())
    kept = found.where(~_contaminated(coverage))
    if longest_span is None:
        return kept.select("row.*")
    cut = F.expr(f"exists(spans, s -> s[1] - s[0] > {int(longest_span)})")
    body = F.col("row").getField(text_col)
    text = F.when(cut, _cutter(longest_span)(body, "spans")).otherwise(body)
    named = "`" + text_col.replace("`", "``") + "`"
    return kept.withColumn("row", F.col("row").withField(named, text)).select("row.*")


def _cutter(longest_span: int):
    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        out = []
        for value, ranges in zip(text, spans):
            body = (value or "").encode("utf-8")
            places = word_places(body)
            parts, at = [], 0
            for start, end in ranges:
                if end - start > longest_span:
                    parts.append(body[at : places[start][0]])
                    at = places[end - 1][1]
            out.append(b"".join([*parts, body[at:]]).decode("utf-8", "replace"))
        return pd.Series(out)

    return cut
