"""Toxicity of texts after a noisy channel is undone.

Words may be disguised: letters by look-alike digits and signs, letters set apart by blanks
or marks, letters repeated. Such a piece of text becomes a lattice of what could have been
meant, and the path that is cheapest under the channel's costs and a character language
model is taken as its restored form (Viterbi). The model counts characters in threes over
all words of the corpus; its size is fixed by the size of its alphabet.

The restored words are then scored. Each word, and its beginnings, has a share of toxic
documents among the labelled documents that hold it, drawn towards the overall share while
they are few; a text's score is the chance that one of its words is a sign of toxicity.
Near copies among the labelled documents share one vote for each label.
"""

import re
from itertools import chain, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from standwise.llm.bpe import pieces_of
from standwise.llm.common import carried, column, texts
from standwise.llm.minhash import near_duplicates
from standwise.sources.staging import stage

# Letters the language model tells apart, besides the end of a word and all other letters.
ALPHABET = 94
# Signs that stand for letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
BETWEEN = " .-_*~'/,"
# Channel costs, in nats: a sign for a letter, a mark put between letters, a letter repeated
# once more or often, a repetition that is meant, a sign that is no letter.
SIGN, MARK, DOUBLED, STRETCHED, MEANT, KEPT = 1.0, 0.3, 6.0, 0.5, 8.0, 9.0

PREFIXES = (4, 5, 6, 7)
# A share of toxic documents is drawn to the overall one as if by so many documents more.
DOUBT = 4.0
# A word is a sign if its share reaches LEAST_SHARE and LEAST_LIFT times the overall one, and
# chance explains it with e ** -SURE at most.
LEAST_SHARE, LEAST_LIFT, SURE = 0.5, 2.0, 10.0
# Features of a fitted model, the surest ones; labelled documents that may be broadcast.
FEATURES, BROADCAST_LABELS = 200_000, 1_000_000
# One in so many clean documents is counted with the toxic ones.
EARLY = 4
THRESHOLD = 0.3
REMEMBERED = 200_000
# First letters by which plain words are told from possible signs.
BEGINNING = 6
# Readings of one word that are looked up by themselves; beyond, the cheapest one is.
READINGS = 256
# Parts of a word set apart that are joined whatever the decoder finds.
PARTS = 16

_PLAIN = re.compile(r"[^\W\d_]+\Z")
_INNER_I = re.compile(r"(?<=[a-z])I(?=[a-z])")  # as good as a small l
_DOUBLED = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1*", re.S)
_HEAD = re.compile(r"(?:(.)\1*){1,4}", re.S)  # all that decides on four letters
_SIGNS = re.escape("".join(LOOK_ALIKES))
_EDGES = ".,;:?)]}\"'<>=#([{*_-~/\\…“”«»"
# Look-alikes that are no number or amount.
_DISGUISED = re.compile(rf"(?![+$€£]*\d*[+$€£!]*\Z)[{_SIGNS}]{{2,}}\Z|[@$!|(]{{2,}}\Z")
# Words in three parts or more, each of a letter or sign or of two with a letter among them.
_LETTER, _GAP = r"[^\W\d_]", rf"[{re.escape(BETWEEN)}]{{1,3}}"
_UNIT = rf"(?:{_LETTER}[{_SIGNS}]|{_LETTER}{{1,2}}|[{_SIGNS}]{_LETTER}|[{_SIGNS}])"
_SPACED = re.compile(rf"(?<![^\W_]){_UNIT}(?:{_GAP}{_UNIT}(?![^\W_])){{2,}}")
# Its second part and third part, found sooner: there is a part one to four places before.
_SECOND = re.compile(rf"[{re.escape(BETWEEN)}]{_UNIT}(?![^\W_]){_GAP}{_UNIT}(?![^\W_])")
_GAPS = re.compile(rf"[{re.escape(BETWEEN)}]+")


def _spaced_runs(text: str) -> list[str]:
    """All that ``_SPACED`` finds in a text."""
    found, at = [], 0
    while (second := _SECOND.search(text, at)) is not None:
        place = second.start()
        for start in range(max(at, place - 4), place):
            if (run := _SPACED.match(text, start)) is not None and run.end() > place + 1:
                found.append(run[0])
                at = run.end()
                break
        else:
            at = place + 1
    return found


class CharacterModel:
    """Costs of a letter after two others, for words with an end mark on either side."""

    END, OTHER = 0, 1

    def __init__(self, letters: str, counts: np.ndarray):
        """counts: triples by first, second and third letter, flat or not."""
        self.number = {c: i + 2 for i, c in enumerate(letters)}
        n = len(letters) + 2
        three = counts.reshape(n, n, n).astype("f8")
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        one = (one + 0.5) / (one + 0.5).sum()
        pair = (two + 5.0 * one) / (two.sum(axis=1, keepdims=True) + 5.0)
        chance = (three + 5.0 * pair[None]) / (three.sum(axis=2, keepdims=True) + 5.0)
        self.cost = (-np.log(chance)).astype("f4")

    def of(self, letter: str) -> int:
        return self.number.get(letter, self.OTHER)


class Restorer:
    """Undoes look-alikes, spacing and repetition in pieces of text."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.cost = model.cost.tolist()
        self.coded: dict[tuple[str, int], list[tuple[list[int], str, float]]] = {}

    def _options(self, sign: str, times: int) -> list[tuple[str, float]]:
        """What a run of one sign may stand for: output, channel cost. A blank ends a word."""
        found = []
        if sign in BETWEEN:
            return [("", MARK), (" ", KEPT / 2)]
        letters = LOOK_ALIKES.get(sign, "")
        if sign.isalpha():
            letters, extra = sign, 0.0
        else:
            found.append((" ", KEPT * times))
            extra = SIGN
        for c in letters:
            if times == 1:
                found.append((c, extra))
            elif times == 2:
                found += [(c + c, 2 * extra), (c, extra + DOUBLED)]
            else:
                found += [(c, extra + STRETCHED), (c + c, extra + 2 * STRETCHED), (c * times, MEANT)]
        return found

    def _coded(self, sign: str, times: int) -> list[tuple[list[int], str, float]]:
        """Options with the numbers of their letters; those of short runs are remembered."""
        found = self.coded.get((sign, times))
        if found is None:
            number, end = self.model.of, CharacterModel.END
            options = self._options(sign, times)
            found = [([end if c == " " else number(c) for c in o], o, x) for o, x in options]
            if times <= 3 and len(self.coded) < REMEMBERED:
                self.coded[sign, times] = found
        return found

    def _pairs(self, text: str) -> str | None:
        """The cheapest reading of letters of which some stand twice, or None if more than two
        or two pairs stand together.

        The two readings of a pair differ in what is paid for the letters of the pair and the
        one behind; from there on both paths are in one state. So each pair is settled alone.
        """
        number, cost, end = self.model.of, self.cost, CharacterModel.END
        parts, at = [], 0
        for pair in _DOUBLED.finditer(text):
            i = pair.start()
            behind = text[i + 2 : i + 3]
            if (at and i == at) or behind == pair[1]:
                return None
            b, c = number(text[i - 1]) if i else end, number(pair[1])
            d = number(behind) if behind else end
            once = DOUBLED + cost[b][c][d] < cost[b][c][c] + cost[c][c][d]
            parts.append(text[at : i + 1] if once else text[at : i + 2])
            at = i + 2
        return "".join([*parts, text[at:]])

    def decode(self, text: str) -> str:
        """The cheapest reading of a piece of text in lower case."""
        if text.isalpha() and (told := self._pairs(text)) is not None:
            return told
        number, cost, end = self.model.of, self.cost, CharacterModel.END
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(end, end): (0.0, ())}
        for run in _RUN.finditer(text):
            sign, times = run[1], len(run[0])
            onward: dict[tuple[int, int], tuple[float, tuple]] = {}
            if times == 1 and sign.isalpha():  # the one thing it can mean
                c = number(sign)
                for (a, b), (so_far, told) in paths.items():
                    total = so_far + cost[a][b][c]
                    best = onward.get((b, c))
                    if best is None or total < best[0]:
                        onward[b, c] = (total, (told, sign))
                paths = onward
                continue
            for codes, output, extra in self._coded(sign, times):
                for (a, b), (so_far, told) in paths.items():
                    total, x, y = so_far + extra, a, b
                    for c, letter in zip(codes, output):
                        if c == end:
                            if y != end:
                                total += cost[x][y][end]
                                told = (told, " ")
                            x = y = end
                        else:
                            total += cost[x][y][c]
                            x, y = y, c
                            told = (told, letter)
                    best = onward.get((x, y))
                    if best is None or total < best[0]:
                        onward[x, y] = (total, told)
            paths = onward
        total, told = min(
            ((t + (cost[a][b][end] if b != end else 0.0), told) for (a, b), (t, told) in paths.items()),
            key=lambda p: p[0],
        )
        letters = []
        while told:
            told, letter = told
            letters.append(letter)
        return "".join(reversed(letters)).strip()

    def restore_piece(self, piece: str) -> str:
        """The restored form of what stands between blanks, in lower case without edge marks."""
        core = _INNER_I.sub("|", piece.strip(_EDGES).rstrip("!")).lower()
        if not core or (_PLAIN.match(core) and _DOUBLED.search(core) is None):
            return core
        if not any(c.isalpha() for c in core) and not _DISGUISED.match(core):
            return core  # a number or a mark
        return self.decode(core)

    def readings(self, piece: str) -> list[str]:
        """All words that letters and signs may stand for, each repetition as one letter, two
        or as it is; none if they are more than READINGS or there are other characters."""
        options, n = [], 1
        for run in _RUN.finditer(piece):
            sign = run[1]
            letters = sign if sign.isalpha() else LOOK_ALIKES.get(sign, "")
            times = {1, min(2, len(run[0])), len(run[0])}
            options.append([c * k for c in letters for k in times])
            n *= len(options[-1])
            if not 0 < n <= READINGS:
                return []
        return ["".join(x) for x in product(*options)]

    def spaced_run(self, run: str) -> set[str]:
        """Restored forms of a run of short parts; a short word may stand before or behind
        a word in parts, so also without the first or last part or both."""
        letters = run.lower()
        gaps = list(_GAPS.finditer(letters))
        low, high = gaps[0].end(), gaps[-1].start()
        return {self.decode(x) for x in (letters, letters[low:], letters[:high], letters[low:high])}

    def spaced(self, text: str) -> list[str]:
        """Restored forms of all runs of short parts in a text."""
        return [x for run in _spaced_runs(text) for x in self.spaced_run(run)]

    def restore(self, text: str) -> str:
        """A whole text with its disguised words restored, in lower case."""
        joined = _SPACED.sub(lambda m: self.decode(m[0].lower()), text)
        return " ".join(filter(None, map(self.restore_piece, pieces_of(joined))))


class _Words(dict):
    """Restored words of a piece, remembered; what is not met again for long is forgotten."""

    def __init__(self, find):
        super().__init__()
        self.find, self.older = find, {}

    def __missing__(self, piece: str):
        value = self.older.get(piece)
        if value is None:
            value = self.find(piece)
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


_LEAD = 40


def lead(word: str) -> int:
    """24 bits for the first letters, which all features of a word begin with."""
    return xxh3_64_intdigest("l " + word[: PREFIXES[0]]) & 0xFFFFFF


def features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings, led by the hash of its first letters."""
    names = ["w " + word] + ["p " + word[:n] for n in PREFIXES if len(word) > n]
    top, rest = lead(word) << _LEAD, (1 << _LEAD) - 1
    return [top | (xxh3_64_intdigest(name) & rest) for name in names]


class Scorer:
    """Chance of toxicity of a text, from the shares of toxic documents of its words."""

    def __init__(self, restorer: Restorer, shares: dict[int, float], base: float):
        self.restorer, self.shares, self.base = restorer, shares, base
        self.leads = {f >> _LEAD for f in shares}
        self.begins = _Words(self._begins)
        self.opens = _Words(self._opens)
        self.dull = _Words(self._dull)
        self.of_piece = _Words(self._of_piece)
        self.of_run = _Words(self._of_run)
        self.silent: set[str] = set()
        self.silent_before: set[str] = set()

    def _begins(self, letters: str) -> bool:
        """Whether some sign may begin with these letters."""
        return lead(letters) in self.leads

    def _opens(self, piece: str) -> bool:
        """Whether some word that a piece in lower case may be read as begins like a sign.

        Words begin at its start and behind whatever is no letter, and may end there. What has
        been read of all of them is followed together, in one pass.
        """
        begins, most = self.begins, PREFIXES[0]
        read: set[str] = set()
        start = True
        for run in _RUN.finditer(piece):
            sign = run[1]
            if start:
                read.add("")
                start = False
            if not sign.isalpha():
                start = True
                if any(begins[r] for r in read if r):
                    return True
                letters = LOOK_ALIKES.get(sign, "")
                grown = set(read) if sign in BETWEEN else set()
            elif read:
                letters, grown = sign, set()
            else:
                continue
            times = run.end() - run.start()
            for c in letters:
                for r in read:
                    grown.add(r + c)
                    if times > 1:
                        grown.update((r + c + c, r + c * times))
                    if r.endswith(c):
                        grown.add(r)  # doubled across a gap
            read = set()
            for r in grown:
                if len(r) < most:
                    read.add(r)
                elif begins[r[:most]]:
                    return True
        return any(begins[r] for r in read if r)

    def _tells(self, piece: str) -> bool:
        """Whether some word that a piece may be read as begins like a sign, or it is no word."""
        core = piece.strip(_EDGES)
        if core.isalpha() and core[1:].islower():
            return self.opens[_HEAD.match(core.lower())[0]]
        return not any(map(str.isalpha, core)) or self._opens(_INNER_I.sub("|", core).lower())

    def _dull(self, letters: str) -> bool:
        """Whether no plain word with these first letters may be read as a sign."""
        lower = letters.lower()
        head = _HEAD.match(lower)[0]
        known = len(head) < len(lower) and letters.isalpha() and letters[1:].islower()
        return known and not self.opens[head]

    def _of_word(self, word: str) -> float:
        if not self.begins[word[: PREFIXES[0]]]:
            return 0.0
        get = self.shares.get
        return max([get(f, 0.0) for f in features(word)])

    def _signs(self, words: set[str], disguised: set[str]) -> tuple[tuple[str, float], ...]:
        """Known signs among words; if there are none, the surest reading of the disguised."""
        found = tuple((w, s) for w in words if (s := self._of_word(w)) > 0)
        if found or not disguised:
            return found
        read = {r for w in disguised for r in self.restorer.readings(w)}
        share, word = max(((self._of_word(r), r) for r in read), default=(0.0, ""))
        return ((word, share),) if share > 0 else ()

    def _of_piece(self, piece: str) -> tuple[tuple[str, float], ...]:
        if not self._tells(piece):
            return ()
        core = piece.strip(_EDGES)
        if core.isalpha() and core[1:].islower():
            lower = core.lower()
            if lower.isalpha() and _DOUBLED.search(lower) is None:  # reads as itself alone
                share = self._of_word(lower)
                return ((lower, share),) if share > 0 else ()
        raw = piece.lower().strip(_EDGES + "!")
        words = {raw, *self.restorer.restore_piece(piece).split()} - {""}
        if not any(c.isalpha() for c in raw) and not _DISGUISED.match(raw):
            return self._signs(words, set())
        return self._signs(words, {w for w in words if not w.isalpha() or _DOUBLED.search(w)})

    def _of_run(self, run: str) -> tuple[tuple[str, float], ...]:
        if not self._opens(run.lower()):
            return ()
        parts = _GAPS.split(run.lower())
        words = {w for told in self.restorer.spaced_run(run) for w in told.split()}
        if found := self._signs(words, {w for w in words if _DOUBLED.search(w)}):
            return found
        # Among several short words the cheapest path may part elsewhere: whole words only.
        joined = {"".join(parts[i:j]) for i in range(len(parts)) for j in range(i + 3, min(i + PARTS, len(parts)) + 1)}
        read = {r for w in joined for r in self.restorer.readings(w) if self.begins[r[: PREFIXES[0]]]}
        share, word = max(((self.shares.get(features(r)[0], 0.0), r) for r in read), default=(0.0, ""))
        return ((word, share),) if share > 0 else ()

    def _is_dull(self, piece: str) -> bool:
        """Whether the first letters alone tell that a piece holds no sign."""
        return (
            self.dull[piece[:BEGINNING]]
            and piece[1:].islower()
            and (piece.isalpha() or (piece[:-1].isalpha() and piece[-1] in _EDGES))
        )

    def _silence(self, piece: str) -> None:
        """Remember a piece without signs, in two generations."""
        if len(self.silent) >= REMEMBERED:
            self.silent_before, self.silent = self.silent, set()
        if len(piece) <= 64:
            self.silent.add(piece)

    def score(self, text: str) -> float:
        signs = {}
        for piece in set(pieces_of(text)) - self.silent - self.silent_before:
            found = () if self._is_dull(piece) else self.of_piece[piece]
            if found:
                signs.update(found)
            else:
                self._silence(piece)
        for run in _spaced_runs(text):
            signs.update(self.of_run[run])
        clean = 1.0 - self.base / 4  # toxic without a known sign
        for share in sorted(signs.values()):
            clean *= 1.0 - share
        return 1.0 - clean


def character_model(rows: DataFrame) -> CharacterModel:
    """Counts over every word of (id, body), with sums in Spark; the alphabet and then the
    table of triples, whose size is fixed, are all that reaches the driver."""

    def letters(batches):
        total = np.zeros(0x110000, np.int64)
        for codes in _codes(batches):
            some = np.bincount(codes)
            total[: len(some)] += some
        found = [c for c in np.flatnonzero(total).tolist() if chr(c).isalpha()]
        yield pa.RecordBatch.from_pydict(
            {"code": pa.array(found, pa.int32()), "n": pa.array(total[found], pa.int64())}
        )

    often = rows.mapInArrow(letters, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    often = often.orderBy(F.desc("n"), "code").limit(ALPHABET).collect()
    alphabet = "".join(chr(r.code) for r in often)
    size = len(alphabet) + 2
    table = np.zeros(0x110000, np.uint8)
    for i, c in enumerate(alphabet):
        table[ord(c)] = i + 2

    def triples(batches):
        number = table
        total = np.zeros(size**3, np.int64)
        for codes in _codes(batches):
            x = np.concatenate([[0, 0], number[codes], [0]]).astype(np.int32)
            # Within a word two letters come before; a word's first ones have end marks.
            first = np.where(x[1:-1] == 0, 0, x[:-2])
            codes3 = (first * size + x[1:-1]) * size + x[2:]
            used = (x[1:-1] != 0) | (x[2:] != 0)
            total += np.bincount(codes3[used], minlength=size**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"triple": pa.array(some), "n": pa.array(total[some])})

    found = rows.mapInArrow(triples, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    counts = np.zeros(size**3)
    found = found.toArrow()
    counts[found.column("triple").to_numpy()] = found.column("n").to_numpy()
    return CharacterModel(alphabet, counts)


def _codes(batches):
    """Code points of the texts in lower case, some hundred thousand at a time; texts are
    parted by a line break."""
    held: list[bytes] = []
    size = 0

    def told() -> np.ndarray:
        text = b"\n".join(held).decode("utf-8", "replace").lower()
        return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")

    for batch in batches:
        for body in batch.column("body").to_pylist():
            held.append(body)
            size += len(body)
            if size > 1 << 19:
                yield told()
                held, size = [], 0
    if held:
        yield told()


def _votes(labelled: DataFrame) -> DataFrame:
    """(id, toxic, vote) of (id, body, toxic): near copies, linked on their full sets of
    shingles, share one vote for each label among them. Texts without words share one."""
    groups = near_duplicates(labelled, "id", "body")
    some = F.col("n_shingles") > 0
    groups = groups.select("id", some.alias("some"), F.when(some, F.col("component_id")).otherwise(0).alias("part"))
    # Repeated rows of an id have one label; each row of them has its own part.
    label = labelled.select("id", "toxic").distinct()
    rows = stage(groups.join(label, "id"))
    sizes = stage(rows.groupBy("some", "part", "toxic").agg(F.count(F.lit(1)).alias("size")))
    rows = rows.join(sizes, ["some", "part", "toxic"])
    return stage(rows.select("id", "toxic", (1 / F.col("size")).alias("vote")))


def _votes_by_feature(
    rows: DataFrame, restorer: Restorer, wanted: frozenset[int] | None = None
) -> DataFrame:
    """(feature, toxic, clean): the votes of the documents that have it, from (body, toxic,
    vote). Only ``wanted`` features are counted, if given: then words that do not begin like
    one of them are passed over, as in scoring."""
    tool = restorer if wanted is None else Scorer(restorer, dict.fromkeys(wanted, 0.0), 0.0)
    shared = rows.sparkSession.sparkContext.broadcast(tool)

    def run(batches):
        tool = shared.value
        told_by = lambda words: tuple(f for w in words for f in features(w))
        all_of_piece = lambda p: told_by(tool.restore_piece(p).split())
        all_of_run = lambda r: told_by({w for told in tool.spaced_run(r) for w in told.split()})
        find_piece, find_run, passed = all_of_piece, all_of_run, None
        if wanted is not None:
            scorer, tool = tool, tool.restorer
            some = lambda found: tuple(f for f in found if f in scorer.shares)
            find_piece = lambda p: some(all_of_piece(p)) if scorer._tells(p) else ()
            find_run = lambda r: some(all_of_run(r)) if scorer._opens(r.lower()) else ()
            passed = scorer._is_dull
        of_piece, of_run = _Words(find_piece), _Words(find_run)
        of = lambda name: of_piece[name] if isinstance(name, str) else of_run[name[0]]
        numbers: dict[str | tuple[str], int] = {}  # pieces, and runs in tuples, of some documents
        held: list[np.ndarray] = []  # their numbers, by document
        votes: list[tuple[float, float]] = []
        size = 0

        def told():
            """Votes of every feature, once for each document that has it."""
            told_by_name = list(map(of, numbers))
            n_of = np.fromiter(map(len, told_by_name), np.int64, len(numbers))
            flat = np.fromiter(chain.from_iterable(told_by_name), np.uint64, n_of.sum())
            kinds, place = np.unique(flat, return_inverse=True)
            first = np.cumsum(n_of) - n_of
            names = np.concatenate(held)
            document = np.repeat(np.arange(len(held)), [len(x) for x in held])
            times = n_of[names]
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            pairs = np.repeat(document, times) * len(kinds) + place[np.repeat(first[names], times) + within]
            document, place = np.divmod(np.unique(pairs), max(1, len(kinds)))
            given = np.array(votes)
            sums = [np.bincount(place, given[document, k], len(kinds)) for k in (0, 1)]
            return pa.RecordBatch.from_pydict(
                {"feature": pa.array(kinds.view(np.int64)), "toxic": sums[0], "clean": sums[1]}
            )

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("body", "toxic", "vote")]
            for body, toxic, vote in zip(*columns):
                text = body.decode("utf-8", "replace")
                names = set(pieces_of(text))
                if passed is not None:
                    names = {name for name in names if not passed(name)}
                names.update(zip(_spaced_runs(text)))
                found = [numbers.setdefault(name, len(numbers)) for name in names]
                held.append(np.array(found, np.int64))
                votes.append((vote * toxic, vote * (1 - toxic)))
                size += len(found)
                if size > 1 << 18:
                    yield told()
                    numbers, held, votes, size = {}, [], [], 0
        if held:
            yield told()

    counts = rows.mapInArrow(run, "feature long, toxic double, clean double").groupBy("feature")
    return stage(counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _shares(rows: DataFrame, restorer: Restorer) -> tuple[dict[int, float], float]:
    """Share of toxic documents by feature, from (body, toxic, vote), and the overall share.

    All features of toxic documents and of a part of the others are counted first. More clean
    documents only lower a share, and without enough toxic ones chance explains it, so in the
    other documents only features that may still be signs are counted.
    """
    given = F.col("vote") * F.col("toxic"), F.col("vote") * (1 - F.col("toxic"))
    total = rows.agg(F.sum(given[0]).alias("toxic"), F.sum(given[1]).alias("clean")).first()
    if not total.toxic:
        return {}, 0.0
    base = total.toxic / (total.toxic + total.clean)
    least = max(LEAST_SHARE, LEAST_LIFT * base)
    share = (F.col("toxic") + DOUBT * base) / (F.col("toxic") + F.col("clean") + DOUBT)
    early = (F.col("toxic") != 0) | (F.pmod(F.xxhash64("body"), F.lit(EARLY)) == 0)
    counts = _votes_by_feature(rows.where(early), restorer)
    # What is not quite enough may be so by rounding.
    known = F.col("toxic") * -np.log(base).item() >= SURE * (1 - 1e-9)
    counts = counts.where(known & (share >= least * (1 - 1e-9)))
    wanted = None
    if counts.count() <= FEATURES:
        wanted = frozenset(r.feature % 2**64 for r in counts.select("feature").collect())
    if wanted is None or wanted:
        counts = counts.union(_votes_by_feature(rows.where(~early), restorer, wanted))
        counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = F.col("toxic") + F.col("clean")
    gain = lambda part, rate: F.when(part > 0, part * F.ln(part / n / rate)).otherwise(0.0)
    sure = gain(F.col("toxic"), base) + gain(F.col("clean"), max(1 - base, 1e-9))
    signs = counts.withColumn("share", share).withColumn("sure", sure)
    signs = signs.where((F.col("share") >= least) & (F.col("sure") >= SURE))
    signs = signs.orderBy(F.desc("sure"), "feature").limit(FEATURES).select("feature", "share")
    return {r.feature % 2**64: r.share for r in signs.collect()}, base


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Scorer:
    """A scorer with the language model of all texts of ``df`` and the shares of toxic
    documents among those that ``labels`` names. Of several labels of one id the highest
    counts; null labels and ids say nothing. Without toxic labels every score is 0."""
    rows = texts(df, id_col, text_col)
    restorer = Restorer(character_model(rows))
    known = labels.select(
        column(id_col).cast("long").alias("id"), column(label_col).cast("int").alias("toxic")
    )
    known = known.where("id is not null and toxic is not null").groupBy("id")
    known = stage(known.agg(F.max("toxic").alias("toxic")))
    small = known.count() <= BROADCAST_LABELS
    votes = _votes(stage(rows.join(F.broadcast(known) if small else known, "id")))
    # A repeated id has repeated votes: one is enough to join by.
    votes = votes.groupBy("id", "toxic").agg(F.sum("vote").alias("vote"), F.count(F.lit(1)).alias("n"))
    votes = votes.select("id", "toxic", (F.col("vote") / F.col("n")).alias("vote"))
    voted = rows.join(F.broadcast(votes) if small else votes, "id").select("body", "toxic", "vote")
    return Scorer(restorer, *_shares(voted, restorer))


def _scored(rows: DataFrame, scorer: Scorer, names: list[str], text_of) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    from pyspark.sql import types as T

    fields = [rows.schema[n] for n in names] + [T.StructField("score", T.DoubleType())]
    schema = T.StructType(fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        tool = shared.value
        for batch in batches:
            scores = [tool.score(text) for text in text_of(batch)]
            columns = [batch.column(n) for n in names] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return rows.mapInArrow(run, schema)


def score(
    df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", *more: Column
) -> DataFrame:
    """(id, more..., score) for every row; null and empty texts have the lowest score. Further
    columns keep whatever name they have."""
    rows = texts(df, id_col, text_col, *([F.struct(*more).alias("more")] if more else []))
    names = [n for n in rows.columns if n != "body"]
    read = lambda batch: [b.decode("utf-8", "replace") for b in batch.column("body").to_pylist()]
    found = _scored(rows, scorer, names, read)
    return found.select(F.col("id").alias(id_col), *(["more.*"] if more else []), "score")


def drop_toxic(
    df: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose score stays under the threshold, with all their columns."""
    read = lambda batch: [t or "" for t in batch.column("row").field(text_col).to_pylist()]
    found = _scored(carried(df), scorer, ["row"], read)
    return found.where(F.col("score") < threshold).select("row.*")
