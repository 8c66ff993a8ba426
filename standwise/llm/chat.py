"""Chat formatting: turn spans and loss masks by rendering growing prefixes of a conversation.

The template is a black box, a function from turns to text. Rendering turns 1..k and 1..k+1
and comparing the two outputs gives the span of turn k+1; an output that does not begin with
the one before it shows a template that rewrites history. Inside a turn, rendering two
different marks in place of its text shows where the text begins.

A conversation is one training example and one output row; its turns meet in one task,
which streams through sorted rows and holds one conversation at a time.
"""

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standwise.llm.common import bounded, column

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# Control strings of this template and of common others; none may appear in a text.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [START, MIDDLE, END, "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>"]
CONTROL += ["<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)) + r"|\\")
_ESCAPE = re.compile(r"\\(\\?)")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END), re.S)
# Two letters of the private use area that no template treats differently.
MARKS = ("\ue000", "\ue001")
# Where windows are asked for, the turns before a turn that are rendered with it.
NEAR = 8
# Rendered turns that the template of this module remembers, and the longest text of one.
REMEMBERED, SHORT = 4096, 4096


def escape(text: str) -> str:
    """Break every control string with a backslash after its first letter; double backslashes."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def _marked(role: str, text: str) -> str:
    return f"{START}{escape(role)}{MIDDLE}{escape(text)}{END}\n"


# A turn is rendered again in every prefix that holds it.
_remembered = lru_cache(REMEMBERED)(_marked)


def marked_turns(turns: list[Turn]) -> str:
    """The template of this module."""
    return "".join(
        (_remembered if len(role) + len(text) <= SHORT else _marked)(role, text)
        for role, text in turns
    )


def read_turns(formatted: str) -> list[Turn]:
    """Turns back from the output of ``marked_turns``."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Located:
    """Output of a template, with the spans of turns and of the texts inside them."""

    def __init__(self, text: str, turns: list[tuple[int, int]], texts: list[tuple[int, int]]):
        self.text, self.turns, self.texts = text, turns, texts
        self.rewritten_at: int | None = None


class _Refused(Exception):
    """A template raised something for turns that begin midway."""


def _refusing(render: Template) -> Template:
    """The template, with whatever it raises told apart from errors around it."""

    def asked(turns: list[Turn]) -> str:
        try:
            return render(turns)
        except Exception as why:
            raise _Refused from why

    return asked


def _text_span(render: Template, before: list[Turn], role: str, whole: str) -> tuple[int, int]:
    """Where the last turn's text stands in ``whole``, which renders it after ``before``."""
    one, two = (render([*before, (role, mark)]) for mark in MARKS)
    start = _common(one, two)
    after = len(one) - start - len(MARKS[0])
    return start, len(whole) - after


def locate(render: Template, turns: list[Turn], windows_beyond: int | None = None) -> Located:
    """Spans by comparing the outputs of successive prefixes.

    ``rewritten_at`` is the first turn (from 0) whose rendering changes what stood before;
    spans are then given for the turns before it only. Every prefix is rendered whole,
    however long the conversation is.

    ``windows_beyond`` trades that for speed where the template is known to look back no
    further than ``NEAR`` turns: a conversation of more turns is then rendered with the turns
    near each turn alone, and the pieces are compared with one rendering of the whole; if
    they differ, or the template takes no such pieces, every prefix is rendered after all. A
    template that rewrites history at one length and back at the next goes unnoticed there.
    """
    if windows_beyond is not None and len(turns) > windows_beyond:
        try:
            found = _prefixes(_refusing(render), turns, NEAR)
        except _Refused:
            found = None
        if found is not None and found.rewritten_at is None and found.text == render(turns):
            return found
    return _prefixes(render, turns, len(turns))


def _prefixes(render: Template, turns: list[Turn], near: int) -> Located:
    parts, spans, inner, at = [], [], [], 0
    full = near >= len(turns)
    earlier = render([]) if full else ""
    parts.append(earlier)
    at = len(earlier)
    for k, (role, _) in enumerate(turns):
        low = max(0, k - near)
        before = turns[low:k]
        if not full:
            earlier = render(before) if before else ""
        whole = render(turns[low : k + 1])
        if not whole.startswith(earlier):
            found = Located(render(turns) if full else "", spans, inner)
            found.rewritten_at = k
            return found
        start, end = _text_span(render, before, role, whole)
        shift = at - len(earlier)
        parts.append(whole[len(earlier) :])
        spans.append((at, at + len(whole) - len(earlier)))
        inner.append((start + shift, end + shift))
        at = spans[-1][1]
        if full:
            earlier = whole
    return Located("".join(parts), spans, inner)


_SCHEMA = (
    "id long, formatted string, n_turns long, rewritten_at int, turns array<array<long>>, "
    "loss array<array<long>>"
)


def format_conversations(
    df: DataFrame,
    render: Template = marked_turns,
    learned: str = "assistant",
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    windows_beyond: int | None = None,
) -> DataFrame:
    """(id, formatted, n_turns, rewritten_at, turns, loss): one row for each conversation.

    turns and loss are [start, end) in code points of ``formatted``: all turns, and the texts
    (as the template escaped them) of the role that is learned. Turns are taken in ascending
    order, nulls first, equal ones by role and text; null roles and texts are empty; a null
    id is a conversation of its own. An empty table gives no rows. Texts of any length are
    kept whole. Only the four named columns are read, so further ones may have any name.
    ``windows_beyond`` is that of ``locate``; without it all prefixes are rendered whole.
    """
    bounded(df.sparkSession)
    rows = df.select(
        column(id_col).cast("long").alias("id"),
        column(turn_col).cast("long").alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text")

    def run(batches):
        for keys, conversations in _grouped(batches):
            located = [locate(render, turns, windows_beyond) for turns in conversations]
            loss = [
                [list(s) for s, (role, _) in zip(found.texts, turns) if role == learned]
                for found, turns in zip(located, conversations)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(keys, pa.int64()),
                    "formatted": pa.array([x.text for x in located], pa.string()),
                    "n_turns": pa.array([len(t) for t in conversations], pa.int64()),
                    "rewritten_at": pa.array([x.rewritten_at for x in located], pa.int32()),
                    "turns": pa.array(
                        [[list(s) for s in x.turns] for x in located], pa.list_(pa.list_(pa.int64()))
                    ),
                    "loss": pa.array(loss, pa.list_(pa.list_(pa.int64()))),
                }
            )

    return rows.mapInArrow(run, _SCHEMA).withColumnRenamed("id", id_col)


def _grouped(batches: Iterator[pa.RecordBatch]):
    """Whole conversations, some hundred at a time, from rows sorted by conversation."""
    keys: list[int | None] = []
    found: list[list[Turn]] = []
    held = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("id", "role", "text")]
        for key, role, text in zip(*columns):
            if not keys or key != keys[-1]:
                if held > 1 << 20:
                    yield keys, found
                    keys, found, held = [], [], 0
                keys.append(key)
                found.append([])
            found[-1].append((role, text))
            held += len(text)
    if keys:
        yield keys, found


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the
    output of ``format_conversations`` with this module's template.

    turns_sha256 is over role, line break, text, line break of each turn; loss_* is the text
    under the loss mask, unescaped, without anything between.
    """

    def run(batches):
        for batch in batches:
            ids, texts, masks = (
                batch.column(n).to_pylist() for n in ("id", "formatted", "loss")
            )
            turns = [read_turns(t) for t in texts]
            learned = [
                "".join(unescape(t[a:b]) for a, b in mask) for t, mask in zip(texts, masks)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(ids, pa.int64()),
                    "n_turns": pa.array([len(t) for t in turns], pa.int64()),
                    "turns_sha256": pa.array(
                        [_digest("".join(f"{role}\n{text}\n" for role, text in t)) for t in turns]
                    ),
                    "loss_chars": pa.array([len(x) for x in learned], pa.int64()),
                    "loss_sha256": pa.array([_digest(x) for x in learned]),
                    "formatted_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    schema = (
        "id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    rows = formatted.select(F.col(id_col).alias("id"), "formatted", "loss")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
