"""Pairing of tags within a row's markup, as array expressions.

Tags that open and close are steps up and down; a tag that opens at some height is closed by
the next tag that comes back to it. So all tags of a page are paired by one running sum and
one sort, in n^1.5 additions and n log n comparisons, however they are nested and whether or
not they are closed. Values used inside lambdas are bound first: Spark works an expression
out again for each element otherwise.
"""

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standwise.llm.common import bounded

# Elements that have no content and no closing tag.
VOID = "area base br col embed hr img input link meta param source track wbr".split()

VOID_NAMES = frozenset(VOID)

# Any tag, and its name behind the sign it opens with.
TAG = r"(?i)</?[a-z][a-z0-9]*\b[^>]*>"
NAME = re.compile("[A-Za-z][A-Za-z0-9]*")

# Length of tags that are remembered, and how many of them.
SHORT, REMEMBERED = 16, 10_000

# Characters of elements that are handed on at once.
CHARS_AT_ONCE = 16_000_000

# What is no markup of the page: comments, scripts and styles.
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blocks(values: Column) -> Column:
    """An array, bound before, cut into about as many blocks as each of them is long."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), width - 1), lambda b: F.slice(values, b * width + 1, width)
    )


def running_sums(values: Column) -> Column:
    """Sums of the first one, two, ... numbers of an array: of blocks, then within them."""

    def add(total: Column, x: Column) -> Column:
        return total + x

    def within(cut: Column, totals: Column) -> Column:
        return F.flatten(
            F.transform(
                cut,
                lambda block, b: bound(
                    F.aggregate(F.slice(totals, F.lit(1), b), F.lit(0), add),
                    lambda base: F.transform(
                        block, lambda _, i: F.aggregate(F.slice(block, F.lit(1), i + 1), base, add)
                    ),
                ),
            )
        )

    def of_blocks(cut: Column) -> Column:
        totals = F.transform(cut, lambda block: F.aggregate(block, F.lit(0), add))
        return bound(totals, lambda totals: within(cut, totals))

    return bound(values, lambda values: bound(blocks(values), of_blocks))


def spans(tags: Column) -> Column:
    """(open, end) of every element, by the place of its opening tag.

    ``tags`` are structs of name and step: 1 opens, -1 closes, 0 does neither. end is the
    place of the closing tag of the same name; an element that is never closed ends where
    the next one of its name opens or the closed element around it ends, whichever comes
    first, or after the last tag. Closing tags that close nothing are passed over.
    """

    def ends(events: Column, n: Column) -> Column:
        closed = F.transform(
            events,
            lambda e, i: bound(
                F.get(events, i + 1),
                lambda following: F.struct(
                    e["name"].alias("name"),
                    e["at"].alias("open"),
                    F.when(
                        (following["name"] == e["name"]) & (following["level"] == e["level"]),
                        following["at"],
                    ).alias("close"),
                    e["step"].alias("step"),
                ),
            ),
        )
        openings = F.array_sort(F.filter(closed, lambda e: e["step"] == 1))

        def end(openings: Column) -> Column:
            closed_ones = F.transform(
                F.filter(openings, lambda e: e["close"].isNotNull()),
                lambda e: F.struct(e["open"].alias("open"), e["close"].alias("end")),
            )
            return bound(
                span_blocks(F.array_sort(closed_ones)),
                lambda cut: F.transform(
                    openings,
                    lambda e, i: F.struct(
                        e["open"].alias("open"),
                        F.coalesce(e["close"], cut_short(openings, cut, e, i)).alias("end"),
                    ),
                ),
            )

        def cut_short(openings: Column, cut: Column, e: Column, i: Column) -> Column:
            """Where an element ends that is never closed."""
            following = F.get(openings, i + 1)
            same = F.when(following["name"] == e["name"], following["open"])
            return F.least(same, innermost(cut, e["open"])["end"], n)

        return F.array_sort(bound(openings, end))

    def levels(order: Column) -> Column:
        def events(sums: Column) -> Column:
            return F.array_sort(
                F.transform(
                    order,
                    lambda o, i: F.struct(
                        o["name"].alias("name"),
                        (F.get(sums, i) - F.when(o["step"] == 1, 1).otherwise(0)).alias("level"),
                        o["at"].alias("at"),
                        o["step"].alias("step"),
                    ),
                )
            )

        return bound(running_sums(F.transform(order, lambda o: o["step"])), events)

    def paired(tags: Column) -> Column:
        order = F.array_sort(
            F.filter(
                F.transform(
                    tags,
                    lambda t, i: F.struct(
                        t["name"].alias("name"), i.alias("at"), t["step"].alias("step")
                    ),
                ),
                lambda o: o["step"] != 0,
            )
        )
        events = bound(order, levels)
        return bound(events, lambda events: ends(events, F.size(tags)))

    return bound(tags, paired)


def paired_tags(names: list[str], steps: list[int]) -> tuple[list[int], list[int]]:
    """Openings and ends of the elements of one page, as ``spans`` finds them, in one pass."""
    n = len(names)
    waiting: dict[str, list[int]] = {}
    closed: dict[int, int] = {}
    following: dict[int, int] = {}
    newest: dict[str, int] = {}
    openings = []
    for at in range(n):
        step, name = steps[at], names[at]
        if step == 1:
            openings.append(at)
            waiting.setdefault(name, []).append(at)
            if name in newest:
                following[newest[name]] = at
            newest[name] = at
        elif step == -1 and waiting.get(name):
            closed[waiting[name].pop()] = at
    ends = []
    around: list[int] = []
    for at in openings:
        end = closed.get(at)
        if end is None:
            # A closed element that has ended stands around nothing further on.
            while around and around[-1] <= at:
                around.pop()
            ends.append(min(following.get(at, n), around[-1] if around else n))
        else:
            ends.append(end)
            around.append(end)
    return openings, ends


def with_spans(df: DataFrame, tags: str, name: str) -> DataFrame:
    """``spans`` of an array column of tags in its place, under another name.

    For whole pages: their many tags are paired by one pass over plain lists.
    """
    bounded(df.sparkSession)
    rest = [c for c in df.columns if c != tags]
    span = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("open", "end")]))
    schema = T.StructType([*[df.schema[c] for c in rest], T.StructField(name, span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = _lists(batch.column(tags))
            names, steps = (_plain(flat.field(i)) for i in range(2))
            opens, ends, sizes = [], [], [0]
            for low, high in zip(offsets, offsets[1:]):
                some, their = paired_tags(names[low:high], steps[low:high])
                opens += some
                ends += their
                sizes.append(len(opens))
            found = pa.StructArray.from_arrays(
                [pa.array(opens, pa.int32()), pa.array(ends, pa.int32())], ["open", "end"]
            )
            columns = [batch.column(c) for c in rest]
            columns.append(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), found))
            yield pa.RecordBatch.from_arrays(columns, [*rest, name])

    return df.mapInArrow(run, schema)


def names_and_steps(
    tags: list[str], known: dict[str, tuple[str, int]]
) -> tuple[list[str], list[int]]:
    """Names of tags, and 1 for one that opens, -1 for one that closes, 0 for one that is whole.

    ``known`` remembers short tags, which come again.
    """
    found = []
    for tag in tags:
        both = known.get(tag)
        if both is None:
            closes = tag[1] == "/"
            name = NAME.match(tag, 2 if closes else 1).group().lower()
            both = name, -1 if closes else 0 if name in VOID_NAMES or tag.endswith("/>") else 1
            if len(tag) <= SHORT and len(known) < REMEMBERED:
                known[tag] = both
        found.append(both)
    return [name for name, _ in found], [step for _, step in found]


def places(plain: str, tags: list[str]) -> tuple[list[int], list[int]]:
    """Where the tags of a text begin and end: each is the first one like it behind the one before."""
    starts, stops, at = [], [], 0
    for tag in tags:
        start = plain.index(tag, at)
        at = start + len(tag)
        starts.append(start)
        stops.append(at)
    return starts, stops


def around(openings: list[int], ends: list[int], wanted: Iterable[int]) -> list[tuple[int, int]]:
    """The innermost element around each of some places, which ascend: its opening and end, or
    (-1, -1) outside all elements."""
    found, inside, k = [], [], 0
    for at in wanted:
        while k < len(openings) and openings[k] < at:
            inside.append((openings[k], ends[k]))
            k += 1
        # An element that has ended stands around nothing further on.
        while inside and inside[-1][1] <= at:
            inside.pop()
        found.append(inside[-1] if inside else (-1, -1))
    return found


def _lists(column: pa.ListArray) -> tuple[pa.Array, list[int]]:
    """The values of all lists of a batch, and where each list begins."""
    offsets = column.offsets.to_numpy()
    first, last = int(offsets[0]), int(offsets[-1])
    return column.values.slice(first, last - first), (offsets - first).tolist()


def _plain(values: pa.Array) -> list:
    """Values without nulls as a list; by way of numpy, which takes a fraction of the time."""
    return values.to_numpy(zero_copy_only=False).tolist()


def cut_elements(
    df: DataFrame,
    pick: Callable[[list[int], list[int], list[int]], Iterable[tuple[int, int, list[int]]]],
    at_once: int = CHARS_AT_ONCE,
) -> DataFrame:
    """(page_id, seq, wanted, inside): a row for each element picked from a page, counted in
    the page, with some of what is wanted of it and with what stands between its tags.

    ``df`` holds (page_id, plain, tags, wanted), where wanted are structs of a tag's place and
    more. ``pick`` takes openings and ends of a page's elements and the wanted places, and
    gives opening, end and numbers of wanted ones for each element picked. The opening -1 stands
    for the whole page. Rows are handed on once they hold ``at_once`` characters.
    """
    bounded(df.sparkSession)
    schema = T.StructType(
        [
            df.schema["page_id"],
            T.StructField("seq", T.IntegerType()),
            df.schema["wanted"],
            T.StructField("inside", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, int]] = {}
        for batch in batches:
            flat_tags, tag_at = _lists(batch.column("tags"))
            flat_wanted, wanted_at = _lists(batch.column("wanted"))
            every_tag, every_place = _plain(flat_tags), _plain(flat_wanted.field(0))
            ids, rows, seqs, chosen, sizes, insides, size = batch.column("page_id"), [], [], [], [0], [], 0

            def joined() -> pa.RecordBatch:
                some = pa.ListArray.from_arrays(
                    pa.array(sizes, pa.int32()), flat_wanted.take(pa.array(chosen, pa.int64()))
                )
                columns = [ids.take(pa.array(rows, pa.int64())), pa.array(seqs, pa.int32()), some]
                return pa.RecordBatch.from_arrays([*columns, pa.array(insides, pa.string())], schema.names)

            for row, plain in enumerate(_plain(batch.column("plain"))):
                tags = every_tag[tag_at[row] : tag_at[row + 1]]
                base = wanted_at[row]
                openings, ends = paired_tags(*names_and_steps(tags, known))
                starts, stops = places(plain, tags)
                picked = pick(openings, ends, every_place[base : wanted_at[row + 1]])
                for seq, (opening, end, numbers) in enumerate(picked):
                    low = stops[opening] if opening >= 0 else 0
                    high = starts[end] if 0 <= end < len(tags) else len(plain)
                    rows.append(row)
                    seqs.append(seq)
                    chosen += [base + n for n in numbers]
                    sizes.append(len(chosen))
                    insides.append(plain[low:high])
                    size += high - low
                    if size > at_once:
                        yield joined()
                        rows, seqs, chosen, sizes, insides, size = [], [], [], [0], [], 0
            yield joined()

    return df.mapInArrow(run, schema)


def interleaved(parts: Column, tags: Column) -> Column:
    """Part, tag, part, ..., part and an empty text: tag k stands at 2 k + 1."""
    return bound(
        tags,
        lambda tags: F.flatten(
            F.transform(parts, lambda p, i: F.array(p, F.coalesce(F.get(tags, i), F.lit(""))))
        ),
    )


def between(both: Column, span: Column) -> Column:
    """What stands between an element's tags; ``both`` is bound and interleaved."""
    places = F.sequence(span["open"] * 2 + 2, span["end"] * 2)
    return F.array_join(F.transform(places, lambda k: F.get(both, k)), "")


def innermost(cut: Column, at: Column) -> Column:
    """The innermost element around a place, null outside all; ``cut`` is bound.

    ``cut`` are blocks of spans with the place where the first of a block opens and the
    last place any of them reaches. Only the block that opens around the place can reach
    it without an element around it, so the last two that could hold one are looked into.
    """

    def last(near: Column) -> Column:
        some = F.slice(near, F.greatest(F.size(near) - 1, F.lit(1)), F.lit(2))
        around = F.filter(
            F.flatten(F.transform(some, lambda b: b["spans"])),
            lambda s: (s["open"] < at) & (s["end"] > at),
        )
        return F.try_element_at(around, F.lit(-1))

    return bound(F.filter(cut, lambda b: (b["first"] < at) & (b["reach"] > at)), last)


def span_blocks(found: Column) -> Column:
    """Blocks of spans as ``innermost`` takes them."""
    cut = F.transform(
        bound(found, blocks),
        lambda block: F.struct(
            F.get(block, F.lit(0))["open"].alias("first"),
            F.array_max(F.transform(block, lambda s: s["end"])).alias("reach"),
            block.alias("spans"),
        ),
    )
    return F.filter(cut, lambda b: F.size(b["spans"]) > 0)
