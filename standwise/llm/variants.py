"""Spelling variants: words one edit apart, by composing the vocabulary's acceptor with itself.

A word and a variant agree up to the first place where they differ, and behind the edit.
Words are dealt to partitions by what must be equal: the part before an interval of places
and the part behind it (the acceptor's initial state and what leads to its end). The
intervals [0, L/2) and [L/2, L] of the shorter word's length L hold the first difference of
every pair exactly once. A partition with more words than one task should hold is parted
again by halving its interval; at one place the letters bound it.

In a partition, the words' middle parts make a minimised acceptor. It is composed with the
transducer of one edit and the acceptor: before the edit both sides are in one state, or in
two along equal letters; behind it they accept what both accept, which is found once for
each pair of states and kept as places in the sorted words. The pairs of a partition are
summed for each word before anything is shuffled.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standwise.llm.common import column, texts
from standwise.sources.staging import stage

# A word has this many letters and occurrences at least.
LETTERS, OCCURRENCES = 6, 5
# A variant's form is this many times as frequent.
FACTOR = 5
# Words that a partition's acceptor is built from before the partition is halved.
PARTITION_WORDS = 20_000
# Different words that a worker counts before it hands them on.
COUNTED = 200_000

# Letters are A-Z in lower case, a-z and U+00C0 to U+00FF; the rest, as Latin-1, parts words.
_LETTER_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of letters in lower case, as Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTER_BYTES).split()


def _dropped(found: dict[bytes, int], name: str, every: int) -> Iterator[tuple[bytes, int]]:
    """The words of one text; of every so manieth, by a hash of name and word, a letter goes."""
    start = zlib.crc32(f"{name}:".encode())
    for word, n in found.items():
        plain = word if word.isascii() else word.decode("latin-1").encode()
        hashed = zlib.crc32(plain, start)
        if hashed % every == 0:
            at = hashed % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def vocabulary(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
    drop_every: int | None = None,
) -> DataFrame:
    """(word, n): words of whole texts and how often they occur over all rows.

    ``drop_every`` plants misspellings: where it divides the hash of ``<id>:<word>``, a
    letter is left out of the word in that row (a null id is written ``null``). Nulls and
    texts without letters have no words; repeated rows count each; an empty table has none.
    """
    def run(batches):
        total: Counter[bytes] = Counter()
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for name, body in zip(ids, batch.column("body").to_pylist()):
                found = Counter([w for w in words_of(body.decode("utf-8", "replace")) if len(w) >= letters])
                if drop_every:
                    for word, n in _dropped(found, "null" if name is None else str(name), drop_every):
                        if len(word) >= letters:
                            total[word] += n
                else:
                    total.update(found)
                if len(total) >= COUNTED:
                    yield from _counts(total)
                    total.clear()
        yield from _counts(total)

    found = texts(df, id_col, text_col).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _counts(total: Counter) -> Iterator[pa.RecordBatch]:
    words = list(total)
    for low in range(0, len(words), 50_000):
        part = words[low : low + 50_000]
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array([w.decode("latin-1") for w in part], pa.string()),
                "n": pa.array([total[w] for w in part], pa.int64()),
            }
        )


class Acceptor:
    """Minimised acceptors that share their states; a state has letters, the states they
    lead to, whether a word ends in it, and the number of words it accepts."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple[int, int]]] = []  # letter: (state, words before it)
        self.final: list[bool] = []
        self.size: list[int] = []
        self.both: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = final, tuple(arcs)
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.arcs)
            before, places = int(final), {}
            for letter, to in arcs:
                places[letter] = to, before
                before += self.size[to]
            self.arcs.append(places)
            self.final.append(final)
            self.size.append(before)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state of the acceptor of different words, given in order."""
        path: list[list] = [[False, []]]
        before = ""
        for word in words:
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            self._close(path, before, same)
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            before = word
        self._close(path, before, 0)
        return self._state(*path[0])

    def _close(self, path: list, word: str, depth: int) -> None:
        """Turn what stands below a depth into states; it can't change any more."""
        while len(path) > depth + 1:
            final, arcs = path.pop()
            path[-1][1].append((word[len(path) - 1], self._state(final, arcs)))

    def shared(self, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Places, among the words of two states, of the words that both accept."""
        waiting = [(p, q)]
        while waiting:
            pair = a, b = waiting[-1]
            if pair in self.both:
                waiting.pop()
                continue
            if a == b:
                places = np.arange(self.size[a])
                self.both[pair] = places, places
                continue
            onward = [
                (arc, self.arcs[b][letter])
                for letter, arc in self.arcs[a].items()
                if letter in self.arcs[b]
            ]
            missing = [(x[0], y[0]) for x, y in onward if (x[0], y[0]) not in self.both]
            if missing:
                waiting += missing
                continue
            found = [(self.both[x[0], y[0]], x[1], y[1]) for x, y in onward]
            self.both[pair] = _together(found, self.final[a] and self.final[b])
        return self.both[p, q]

    def replaced(self, root: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs of words, smaller first, in which one letter differs."""
        done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting = [root]
        while waiting:
            state = waiting[-1]
            arcs = list(self.arcs[state].values())
            missing = [to for to, _ in arcs if to not in done]
            if state in done or not missing:
                waiting.pop()
                if state not in done:
                    found = [(done[to], before, before) for to, before in arcs]
                    for i, (one, first) in enumerate(arcs):
                        for two, second in arcs[i + 1 :]:
                            found.append((self.shared(one, two), first, second))
                    done[state] = _together(found, False)
            else:
                waiting += missing
        return done[root]

    def inserted(self, short: int, long: int, at_end: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs of a word of ``short`` and a word of ``long`` with one letter more,
        each under the last place where it can stand; ``at_end`` takes in the very end."""
        done: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        waiting = [(short, long)]
        while waiting:
            pair = p, q = waiting[-1]
            onward = [
                (arc, self.arcs[q][letter])
                for letter, arc in self.arcs[p].items()
                if letter in self.arcs[q]
            ]
            missing = [(x[0], y[0]) for x, y in onward if (x[0], y[0]) not in done]
            if pair in done or not missing:
                waiting.pop()
                if pair not in done:
                    found = [(done[x[0], y[0]], x[1], y[1]) for x, y in onward]
                    for letter, (to, before) in self.arcs[q].items():
                        # The word goes on with another letter than the one put in.
                        for next_letter, (after, skipped) in self.arcs[p].items():
                            if next_letter != letter and next_letter in self.arcs[to]:
                                end, more = self.arcs[to][next_letter]
                                found.append((self.shared(after, end), skipped, before + more))
                        if at_end and self.final[p] and self.final[to]:
                            here = np.zeros(1, np.int64)
                            found.append(((here, here), 0, before))
                    done[pair] = _together(found, False)
            else:
                waiting += missing
        return done[short, long]


_NONE = np.empty(0, np.int64)


def _together(found: list, both_end: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places, moved by what stands before them; both_end adds the words that end."""
    found = [f for f in found if len(f[0][0])]
    start = [np.zeros(1, np.int64)] if both_end else []
    if not found:
        return (start[0], start[0]) if both_end else (_NONE, _NONE)
    return (
        np.concatenate(start + [pairs[0] + one for pairs, one, _ in found]),
        np.concatenate(start + [pairs[1] + two for pairs, _, two in found]),
    )


def near_in_partition(short: list[str], long: list[str], at_end: bool) -> Iterator[np.ndarray]:
    """Pairs of places of words one edit apart in the sorted lists of middle parts, of one
    length and of one letter more; places in ``long`` count on from those in ``short``."""
    acceptor = Acceptor()
    root = acceptor.add(short)
    if len(short) > 1:
        yield np.stack(acceptor.replaced(root))
    if long:
        one, two = acceptor.inserted(root, acceptor.add(long), at_end)
        yield np.stack([one, two + len(short)])


_KEY = ["class", "low", "high", "head", "tail"]


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (word, n, class, low, high) with what must be equal and the part between."""
    behind = F.col("class") - F.col("high")
    length = F.length("word")
    return rows.select(
        "word",
        "n",
        "class",
        "low",
        "high",
        F.expr("substring(word, 1, low)").alias("head"),
        F.substring("word", length - behind + 1, behind).alias("tail"),
        F.substring("word", F.col("low") + 1, length - behind - F.col("low")).alias("middle"),
    )


def _halves(low: Column, high: Column) -> Column:
    middle = F.floor((low + high) / 2).cast("int")
    return F.explode(
        F.array(
            F.struct(low.alias("low"), middle.alias("high")),
            F.struct(middle.alias("low"), high.alias("high")),
        )
    )


def partitions(words: DataFrame) -> DataFrame:
    """Every word (word, n) in the partitions that hold its pairs, none larger than
    PARTITION_WORDS unless its interval is one place."""
    length = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("class"))
    halves = _halves(F.lit(0), F.col("class"))
    rows = sized.where("class > 0").select("word", "n", "class", halves.alias("part"))
    rows = _dealt(rows.select("word", "n", "class", "part.low", "part.high"))
    while True:
        sizes = rows.where("high - low > 1").groupBy(_KEY).agg(F.count(F.lit(1)).alias("size"))
        large = stage(sizes.where(F.col("size") > PARTITION_WORDS).drop("size"))
        if large.isEmpty():
            return rows
        again = rows.join(large, _KEY, "left_semi")
        part = _halves(F.col("low"), F.col("high")).alias("part")
        again = again.select("word", "n", "class", part)
        again = _dealt(again.select("word", "n", "class", "part.low", "part.high"))
        rows = stage(rows.join(large, _KEY, "left_anti").unionByName(again))


_BEST = "word string, n_near long, form_n long, form string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each word within its partition: their number and the most frequent one.
    Rows come sorted by partition, length and middle part."""
    found: list[tuple] = []
    for key, rows in _runs(batches):
        size, _, high = key[:3]
        if len(rows) == 1 or len(rows[0][0]) > size:
            continue  # no word of the shorter length
        n_short = next((i for i, r in enumerate(rows) if len(r[0]) > size), len(rows))
        middles = [r[2] for r in rows]
        pairs = list(near_in_partition(middles[:n_short], middles[n_short:], high == size))
        one, two = np.concatenate([np.empty((2, 0), np.int64), *pairs], axis=1)
        if not len(one):
            continue
        ends, others = np.concatenate([one, two]), np.concatenate([two, one])
        # Words from the best form down: the most frequent, ties to the smallest.
        order = sorted(range(len(rows)), key=lambda i: (-rows[i][1], rows[i][0]))
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        best = np.full(len(rows), len(rows))
        np.minimum.at(best, ends, place[others])
        counts = np.bincount(ends, minlength=len(rows))
        for i in np.flatnonzero(counts).tolist():
            form = rows[order[best[i]]]
            found.append((rows[i][0], int(counts[i]), form[1], form[0]))
        if len(found) > 20_000:
            yield _batch(found)
            found = []
    if found:
        yield _batch(found)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "form_n", "form"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, [(word, n, middle)]) of each partition."""
    held, rows = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in _KEY))
        values = zip(*(batch.column(c).to_pylist() for c in ("word", "n", "middle")))
        for key, value in zip(keys, values):
            if key != held:
                if rows:
                    yield held, rows
                held, rows = key, []
            rows.append(value)
    if rows:
        yield held, rows


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of a staged vocabulary (word, n).

    Near words differ by one letter put in, left out or replaced. form is the most frequent
    near word (ties: the smallest), if at least ``factor`` times as frequent, else null;
    root is where the forms lead, the word itself if it has none. An empty vocabulary gives
    no rows; words must be different and not null; long words are no special case.
    """
    dealt = partitions(words).repartition(*_KEY)
    dealt = dealt.sortWithinPartitions(*_KEY, F.length("word"), "middle")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    near = dealt.mapInArrow(_search, _BEST)
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    joined = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.form")).alias("form"),
        F.when(-F.col("best.less") >= factor * F.col("n"), -F.col("best.less")).alias("form_n"),
    )
    joined = stage(joined)
    roots = _roots(joined.where("form is not null").select("word", "form"), words, factor)
    root = F.coalesce("root", "word").alias("root")
    return joined.join(roots, "word", "left").select("word", "n", "form", root, "n_near", "form_n")


def _roots(forms: DataFrame, words: DataFrame, factor: int) -> DataFrame:
    """(word, root): every step of a chain is ``factor`` times as frequent, so the counts
    bound its length; each join doubles the steps taken."""
    least, most = words.agg(F.min("n"), F.max("n")).first()
    steps, reach = 0, least or 1
    while reach * factor <= (most or 0):
        steps, reach = steps + 1, reach * factor
    found = forms.withColumnRenamed("form", "root")
    done = 1
    while done < steps:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(onward, "root", "left")
        found = stage(found.select("word", F.coalesce("next", "root").alias("root")))
        done *= 2
    return found


def group(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
    factor: int = FACTOR,
    drop_every: int | None = None,
) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of all words of a table; see ``vocabulary`` and
    ``variants``. Nulls, empty tables, repeated rows and further columns are as told there."""
    words = vocabulary(df, id_col, text_col, letters, occurrences, drop_every)
    return variants(stage(words), factor)
