"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles of five words. Two collections of ``bands``
short band keys are made from few minhashes each; a table is a pair of a band of the first
and a band of the second, so bands * bands tables are keyed by 2 * bands * rows minhashes
instead of bands * bands * 2 * rows. Documents that meet in a table are candidates; links
are confirmed on the full sets.

Documents with equal sets are one class from the start. A table's members are not paired
with each other: each is compared with the member of the smallest id. The documents of
tables that these links leave in several parts are then joined across the parts by their
rarest shingles, which misses no link. So every candidate pair is confirmed, refuted or
already joined through others, and a group of n copies costs some n comparisons.

What rows with hot keys are joined to has one row for each key, and is staged before, so
that Spark can split the partition of a hot key.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from standwise.llm.common import carried, column, per_batch, texts
from standwise.llm.components import components
from standwise.sources.staging import stage

SHINGLE = 5
# Links: PART * union <= WHOLE * intersection.
PART, WHOLE = 75, 100
# Per collection; a pair of similarity 0.75 meets in some table with probability 0.9997.
BANDS, ROWS = 16, 3
SEED = 20
# Ids that may be broadcast: 8 bytes each.
BROADCAST_IDS = 1_000_000
REMEMBERED_WORDS = 200_000
# Size of the bitmaps that refute pairs, at most 4096.
BITS = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2**64 over the golden ratio, made odd


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxh3_64_intdigest(word)
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        if len(word) < 64:
            self[word] = value
        return value


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def shingles(body: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; with fewer words, of the
    whole sequence; none without words."""
    words = body.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mix(total + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(total)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sorted sets reaches PART / WHOLE."""
    if not len(a) or not len(b) or WHOLE * min(len(a), len(b)) < PART * max(len(a), len(b)):
        return False
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    both = int(np.count_nonzero(b[place] == a))
    return WHOLE * both >= PART * (len(a) + len(b) - both)


class Sketcher:
    """Band keys of both collections from the minhashes of a set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        draw = np.random.default_rng(seed)
        n = 2 * bands * rows
        self.bands, self.rows = bands, rows
        self.flip = draw.integers(0, 2**64, n, np.uint64)
        self.turn = draw.integers(0, 2**64, n, np.uint64) | np.uint64(1)

    def keys(self, found: np.ndarray) -> np.ndarray:
        least = np.full(len(self.flip), 2**64 - 1, np.uint64)
        for low in range(0, len(found), 2048):
            block = (found[low : low + 2048, None] ^ self.flip) * self.turn
            np.minimum(least, block.min(axis=0), out=least)
        parts = least.reshape(2 * self.bands, self.rows)
        key = np.arange(2 * self.bands, dtype=np.uint64)
        for i in range(self.rows):
            key = _mix(key + parts[:, i])
        return key.view(np.int64)


def sketches(rows: DataFrame, bands: int = BANDS, n_rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, class, first, second) of (id, body); class identifies the set.

    Empty sets have neither class nor keys.
    """

    def make():
        sketcher = Sketcher(bands, n_rows)

        def work(batch):
            out = {"id": batch.column("id"), "n_shingles": [], "class": [], "first": [], "second": []}
            for body in batch.column("body").to_pylist():
                found = shingles(body)
                out["n_shingles"].append(len(found))
                if len(found):
                    keys = sketcher.keys(found)
                    out["class"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    out["first"].append(keys[:bands])
                    out["second"].append(keys[bands:])
                else:
                    for name in ("class", "first", "second"):
                        out[name].append(None)
            return out

        return work

    schema = "id long, n_shingles long, class binary, first array<long>, second array<long>"
    return per_batch(rows, schema, make)


def tables(classes: DataFrame) -> DataFrame:
    """(key, id): the tables in which a class may meet another.

    A band of the first collection that no other class has makes no candidates, whatever
    it is paired with, so only the others are paired with bands of the second.
    """
    first = classes.select("id", F.posexplode("first").alias("band", "part"))
    first = first.select("id", F.xxhash64("band", "part").alias("part"))
    shared = first.groupBy("part").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = stage(shared.where("low < high").select("part"))
    own = first.join(shared, "part").groupBy("id").agg(F.collect_set("part").alias("parts"))
    pairs = own.join(classes.select("id", "second"), "id")
    pairs = pairs.select("id", "second", F.explode("parts").alias("part"))
    pairs = pairs.select("id", "part", F.posexplode("second").alias("band", "other"))
    return pairs.select(F.xxhash64("part", "band", "other").alias("key"), "id")


def led_pairs(members: DataFrame) -> DataFrame:
    """(a, b, n): each member with the smallest id of its table, and in how many tables."""
    leaders = members.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("high"))
    leaders = stage(leaders.where("b < high").select("key", "b"))
    pairs = members.join(leaders, "key").where("id <> b")
    return pairs.groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("n"))


def confirmed(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    one = bodies.select(F.col("id").alias("a"), F.col("body").alias("body_a"))
    two = bodies.select(F.col("id").alias("b"), F.col("body").alias("body_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")

    def run(batches):
        last, found = None, None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("a", "b", "body_a", "body_b")]
            good = []
            for a, b, body_a, body_b in zip(*columns):
                if body_b != last:  # rows of one b stand together
                    last, found = body_b, shingles(body_b)
                if similar(shingles(body_a), found):
                    good.append((a, b))
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([a for a, _ in good], pa.int64()),
                    "b": pa.array([b for _, b in good], pa.int64()),
                }
            )

    return both.mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, groups: DataFrame, name: str, label: str) -> DataFrame:
    """Add the component of the id in column ``name``; an id in no link is its own."""
    known = groups.select(F.col("node").alias(name), F.col("component").alias(label))
    return rows.join(known, name, "left").withColumn(label, F.coalesce(label, name))


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not yet in one component."""
    both = _labelled(_labelled(pairs, groups, "a", "group_a"), groups, "b", "group_b")
    return both.where("group_a <> group_b").select("a", "b")


def bitmap(found: np.ndarray) -> np.ndarray:
    """BITS bits, one of them set by each element of a set."""
    bits = np.zeros(BITS, np.uint8)
    bits[(found >> np.uint64(64 - 12)).astype(np.int64) % BITS] = 1
    return np.packbits(bits).view(np.int64)


def _missing(one: str, two: str) -> Column:
    """Bits of one bitmap that the other lacks: each stands for an element it lacks."""
    lacking = lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))
    return F.aggregate(F.zip_with(one, two, lacking), F.lit(0), lambda n, x: n + x)


def _left_over(members: DataFrame, groups: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, b): pairs still to compare among the documents of tables whose members are not
    all in one component.

    Two similar sets share one of the rarest shingles of each: of n, ordered from rare to
    frequent, one of the first n - 0.75 * n + 1, and enough must follow the first that they
    share. Elements that a bitmap proves to be in one set alone are counted off as well.
    None of this drops a similar pair; documents that each differ in their own way from a
    common source are mostly not compared.
    """
    rows = _labelled(members, groups, "id", "part")
    mixed = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    mixed = stage(mixed.where("low < high").select("key"))
    open_ids = rows.join(mixed, "key").select("id", "part").distinct()
    texts_of = stage(bodies.join(open_ids, "id").select("id", "part", "body"))

    def elements(batches):
        for batch in batches:
            for key, body in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist()):
                found = shingles(body).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), key, np.int64)), pa.array(found)],
                    names=["id", "shingle"],
                )

    def maps(batches):
        for batch in batches:
            sets = [shingles(body) for body in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("part"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([bitmap(x) for x in sets], pa.list_(pa.int64())),
                ],
                names=["id", "part", "n", "bits"],
            )

    words = stage(texts_of.mapInArrow(elements, "id long, shingle long"))
    sets = stage(texts_of.mapInArrow(maps, "id long, part long, n long, bits array<long>"))
    often = words.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    order = Window.partitionBy("id").orderBy(F.coalesce("often", F.lit(1)), "shingle")
    ranked = words.join(often, "shingle", "left").withColumn("place", F.row_number().over(order))
    ranked = ranked.where("often is not null").select("id", "shingle", "place").join(sets, "id")
    first = F.col("n") - F.ceil(F.col("n") * PART / WHOLE) + 1
    rare = stage(ranked.where(F.col("place") <= first))
    one = rare.withColumnRenamed("id", "a")
    two = rare.select("shingle", *[F.col(c).alias(c + "_b") for c in ("id", "part", "n", "place", "bits")])
    # A link needs (PART + WHOLE) * both >= PART * (n + n_b).
    least = F.lit(PART) * (F.col("n") + F.col("n_b"))
    enough = lambda both: F.lit(PART + WHOLE) * both >= least
    apart = (
        (F.col("a") > F.col("id_b"))
        & (F.col("part") != F.col("part_b"))
        & enough(F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) + 1)
        & enough(F.col("n") - _missing("bits", "bits_b"))
        & enough(F.col("n_b") - _missing("bits_b", "bits"))
    )
    return one.join(two, "shingle").where(apart).select("a", F.col("id_b").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): one row for each row of the table.

    Words are runs without ASCII white space, ASCII letters in lower case. component_id is
    the smallest id reached over links between documents of a similarity of 0.75 or more;
    kept marks the row whose id that is. Null, empty and blank texts have no shingles and
    are linked with nothing. Rows of one id with different texts each follow their own
    text; fully repeated rows are all kept or all not. Rows without id take no part: they
    are kept, and their component is null. An empty table gives no rows.
    """
    marked = _marked(df, id_col, text_col)
    return marked.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _marked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, n_shingles, component_id, kept); tag tells texts of one id apart, if any id
    has several, and is null else."""
    rows = texts(df, id_col, text_col).withColumn("tag", F.xxhash64("body"))
    per_id = rows.where("id is not null").groupBy("id")
    several = per_id.agg(F.min("tag").alias("low"), F.max("tag").alias("high")).where("low <> high")
    if several.isEmpty():
        grouped = _grouped(rows.select("id", "body"))
        return grouped.withColumn("tag", F.lit(None).cast("long"))
    # Every text of an id is a document of its own, under a number of its own.
    nodes = rows.where("id is not null").select("id", "tag").distinct()
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()))
    numbered = rows.join(nodes, ["id", "tag"], "left").select(F.col("node").alias("id"), "body")
    grouped = stage(_grouped(numbered).withColumnRenamed("id", "node"))
    named = grouped.drop("kept").join(nodes, "node", "left")
    least = named.where("component_id is not null").groupBy("component_id")
    least = least.agg(F.min(F.struct("id", "node")).alias("least"))
    return named.join(least, "component_id", "left").select(
        "id",
        "tag",
        "n_shingles",
        F.col("least.id").alias("component_id"),
        F.coalesce(F.col("node") == F.col("least.node"), F.lit(True)).alias("kept"),
    )


def _grouped(rows: DataFrame) -> DataFrame:
    """(id, n_shingles, component_id, kept) of rows (id, body) whose ids have one text each."""
    found = stage(sketches(rows))
    whole = found.where("id is not null and class is not null")
    classes = whole.groupBy("class").agg(
        F.min("id").alias("id"),
        F.min("n_shingles").alias("n"),
        F.min("first").alias("first"),
        F.min("second").alias("second"),
    )
    classes = stage(classes)
    members = stage(tables(classes))
    pairs = stage(led_pairs(members))

    # The texts that some comparison may need: classes that share a table with another.
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    needed = stage(needed)
    if needed.count() <= BROADCAST_IDS:
        bodies = rows.join(F.broadcast(needed), "id", "left_semi")
    else:
        bodies = rows.join(needed, "id", "left_semi")
    bodies = stage(bodies.distinct())

    # First the table partner met most often, then what that leaves apart.
    best = pairs.groupBy("a").agg(F.max(F.struct("n", F.negative("b").alias("b"))).alias("best"))
    best = best.select("a", F.negative("best.b").alias("b"))
    links = stage(confirmed(best, bodies))
    groups = stage(components(links))
    rest = stage(_apart(pairs.join(best, ["a", "b"], "left_anti"), groups))
    links = links.union(stage(confirmed(rest, bodies)))
    groups = stage(components(links))
    left = stage(_left_over(members, groups, bodies))
    links = links.union(stage(confirmed(left, bodies)))
    groups = stage(components(links))

    labelled = _labelled(classes.select("class", "id"), groups, "id", "component")
    known = stage(labelled.groupBy("class").agg(F.min("component").alias("component")))
    out = found.select("id", "n_shingles", "class").join(known, "class", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        "id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of a table that stay, with all their columns: one of each group.

    A row that is not the one of the smallest id in its group goes, by its id and its text;
    of repeated rows all stay.
    """
    gone = _marked(df, id_col, text_col).where("not kept").select("id", "tag").distinct()
    gone = gone.select(F.col("id").alias("gone_id"), F.col("tag").alias("gone_tag"))
    rows = carried(df)
    name, text = (rows["row"].getField(c) for c in (id_col, text_col))
    body = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    same = F.coalesce(gone["gone_tag"] == F.xxhash64(body), F.lit(True))
    out = rows.join(gone, (name.cast("long") == gone["gone_id"]) & same, "left_anti")
    return out.select("row.*")
