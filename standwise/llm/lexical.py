"""Ranked lexical search: term at a time over an inverted index, with limited accumulators.

Documents are indexed in shards (one Arrow batch each). A row of the index is a term's
postings in a shard: places of documents and the term's occurrences in them; one more row
of each shard lists its documents. Items are taken in blocks. A block meets a shard in one
task, which takes the terms of an item from the rarest to the most frequent and adds their
parts of the score to accumulators. Once k accumulators hold more than all terms to come
could add to a new one, no more are created; those that exist are brought to their exact
scores. The best k of every shard and item are merged into the best k of all.

What a task holds is bounded by a shard and a block, whatever the tables' size. Weights
need the whole corpus: its counts are sums over all shards.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from standwise.llm.common import column, texts
from standwise.sources.staging import stage

# Terms: runs of digits, ASCII letters (in lower case) and characters beyond ASCII.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# Different terms of the items that meet a shard in one task.
BLOCK_TERMS = 50_000
# Bits of the table that says which terms an index is made for; more terms than that can
# tell apart only let more postings through to the join on terms, which is exact.
WANTED_BITS = 1 << 23
# Bytes of a text that are split into terms at once.
SPLIT_BYTES = 4 << 20
# Groups in which the lists of shards are merged before they meet.
MERGES = 64
# Fixed values of the score.
SCALE, FULL, SLOPE, BASE, LENGTH = 1_000_000_000, 1000, 8, 100 - 75, 75

INDEX = "shard long, term binary, at array<int>, tf array<int>, ids array<long>, ns array<long>"


class _Numbers(dict):
    """Numbers things in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = len(self)
        return self[key]


def _split(body: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of a bounded size."""
    low = 0
    while low < len(body):
        high = low + SPLIT_BYTES
        if high < len(body):
            plain = body[low:high].translate(_TERM_BYTES)
            cut = plain.rfind(b" ")
            while cut < 0 and high < len(body):  # a term longer than a piece stays whole
                high += SPLIT_BYTES
                plain = body[low:high].translate(_TERM_BYTES)
                cut = plain.rfind(b" ")
            if high < len(body):
                plain, high = plain[:cut], low + cut
        else:
            plain = body[low:].translate(_TERM_BYTES)
        yield plain.split()
        low = high


def _postings(bodies: list[bytes], wanted: np.ndarray | None) -> tuple:
    """(terms, term of each posting, place, occurrences; terms of each document): postings by
    term and place."""
    numbers = _Numbers()
    codes, lengths = [], np.zeros(len(bodies), np.int64)
    for place, body in enumerate(bodies):
        for found in _split(body):
            codes.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
            lengths[place] += len(found)
    terms = list(numbers)
    keys = np.concatenate([*codes, np.empty(0, np.int64)])
    keys = keys * max(1, len(bodies)) + np.repeat(np.arange(len(bodies)), lengths)
    if wanted is not None:
        slots = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % WANTED_BITS
        known = wanted[slots >> 3] >> (slots & 7) & 1
        keys = keys[known[keys // max(1, len(bodies))] == 1]
    keys, counts = np.unique(keys, return_counts=True)
    return terms, keys // max(1, len(bodies)), keys % max(1, len(bodies)), counts, lengths


def index(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    wanted: np.ndarray | None = None,
) -> DataFrame:
    """Postings of every whole text, by shard and term; see INDEX.

    ``at`` are places in the list of documents that the shard's row with a null term holds
    (``ids``, and their numbers of terms ``ns``). ``wanted``, from ``wanted_by``, leaves out
    terms that no item has. Nulls and texts without terms are listed with no terms; a null
    id is an id like others; repeated rows are documents of their own; an empty table gives
    an empty index. Long texts are split piece by piece. The numbers of shards follow the
    partitions, so stage the index before using it twice.
    """

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            terms, codes, places, counts, lengths = _postings(
                batch.column("body").to_pylist(), wanted
            )
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            bounds = pa.array(np.append(starts, len(codes)), pa.int32())
            rows, none = len(starts), pa.array([0], pa.int32())
            shard = first + number
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(np.full(rows, shard), pa.int64()),
                    "term": pa.array([terms[c] for c in codes[starts]], pa.binary()),
                    "at": pa.ListArray.from_arrays(bounds, pa.array(places, pa.int32())),
                    "tf": pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int32())),
                    "ids": pa.nulls(rows, pa.list_(pa.int64())),
                    "ns": pa.nulls(rows, pa.list_(pa.int64())),
                }
            )
            whole = pa.array([0, batch.num_rows], pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int64()),
                    "term": pa.array([None], pa.binary()),
                    "at": pa.nulls(1, pa.list_(pa.int32())),
                    "tf": pa.nulls(1, pa.list_(pa.int32())),
                    "ids": pa.ListArray.from_arrays(whole, batch.column("id")),
                    "ns": pa.ListArray.from_arrays(whole, pa.array(lengths, pa.int64())),
                }
            )

    return texts(df, id_col, text_col).mapInArrow(run, INDEX)


def terms_of(text: Column) -> Column:
    """Terms of a text, repeats included; none for a null."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item, term, repeats) of items: equal rows are one query, rows of one id with
    different texts are queries of their own."""
    rows = items.select(column(item_col).alias("item"), column(text_col).cast("string").alias("text"))
    rows = stage(rows.distinct().withColumn("query", F.monotonically_increasing_id()))
    terms = rows.select("query", "item", F.explode(terms_of(F.col("text"))).alias("term"))
    return terms.groupBy("query", "item", "term").agg(F.count(F.lit(1)).alias("repeats"))


def wanted_by(terms: DataFrame) -> np.ndarray:
    """Bits of the terms that items have, WANTED_BITS however many there are."""
    # Spark's buckets count values from 1.
    slot = F.crc32(F.col("term").cast("binary")) % WANTED_BITS + 1
    bits = (
        terms.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    out = np.zeros(WANTED_BITS // 8, np.uint8)
    for row in bits.collect():  # at most 256 rows of 4 KB
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def _best(scores: np.ndarray, ids: pa.Array, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0; equal scores by id, null ids last."""
    found = np.flatnonzero(scores > 0)
    if len(found) > k:
        least = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= least]
    return found[np.lexsort((order[found], -scores[found]))][:k]


class Shard:
    """A shard's documents and postings of the terms in hand, ready to be searched."""

    def __init__(self, ids: pa.Array, ns: np.ndarray, n_docs: int, n_terms: int):
        self.ids = ids
        self.m = BASE + (LENGTH * ns * n_docs) // max(1, n_terms)
        keys = ids.fill_null(0).to_numpy(zero_copy_only=False)
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        self.order = np.empty(len(ids), np.int64)
        self.order[np.lexsort((keys, missing))] = np.arange(len(ids))
        self.lists: list[tuple[int, np.ndarray, np.ndarray, int]] = []

    def add(self, weight: int, at: np.ndarray, tf: np.ndarray) -> None:
        """The next term: its weight, the places of its documents, its occurrences there."""
        tf = tf.astype(np.int64)
        parts = (SCALE * tf) // (FULL * tf + SLOPE * self.m[at])
        self.lists.append((weight, at, parts, int(parts.max(initial=0))))

    def search(self, terms: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the best k documents for (term, repeats) of one item."""
        steps = sorted(
            ((self.lists[t][0], t, self.lists[t][0] * r) for t, r in terms), reverse=True
        )
        rest = sum(w * self.lists[t][3] for _, t, w in steps)
        scores = np.zeros(len(self.ids), np.int64)
        held = None  # places of the accumulators, once no more are created
        for _, t, w in steps:
            _, at, parts, most = self.lists[t]
            if held is None:
                some = scores[scores > 0]
                # A document not met so far can get ``rest`` at most.
                if len(some) >= k and rest < np.partition(some, len(some) - k)[len(some) - k]:
                    held = np.flatnonzero(scores)
            rest -= w * most
            if held is None:
                scores[at] += w * parts
            elif len(held) < len(at):
                found = np.searchsorted(at, held)
                found[found == len(at)] = 0
                met = at[found] == held
                scores[held[met]] += w * parts[found[met]]
            else:
                met = scores[at] > 0
                scores[at[met]] += w * parts[met]
        best = _best(scores, self.ids, self.order, k)
        return best, scores[best]


_FOUND = "query long, id long, score long, shard long"


def _searcher(n_docs: int, n_terms: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        term = table.column("w")
        listing = table.filter(pa.compute.is_null(term))
        rows = table.filter(pa.compute.is_valid(term))
        ids = listing.column("ids").combine_chunks().flatten()
        shard = Shard(ids, listing.column("ns").combine_chunks().flatten().to_numpy(), n_docs, n_terms)
        wants: dict[int, list[tuple[int, int]]] = {}
        columns = [rows.column(c).combine_chunks() for c in ("w", "at", "tf", "queries")]
        for i in range(rows.num_rows):
            w, at, tf, queries = (c[i] for c in columns)
            shard.add(w.as_py(), at.values.to_numpy(), tf.values.to_numpy())
            asked, repeats = queries.values.flatten()
            for q, r in zip(asked.to_pylist(), repeats.to_pylist()):
                wants.setdefault(q, []).append((i, r))
        found = [(q, *shard.search(terms, k)) for q, terms in wants.items()]
        places = np.concatenate([np.empty(0, np.int64), *(p for _, p, _ in found)])
        return pa.table(
            {
                "query": pa.array(np.repeat([q for q, *_ in found], [len(p) for _, p, _ in found]), pa.int64()),
                "id": ids.take(pa.array(places, pa.int64())),
                "score": pa.array(np.concatenate([np.empty(0, np.int64), *(s for *_, s in found)]), pa.int64()),
                "shard": pa.array(np.full(len(places), table.column("shard")[0].as_py()), pa.int64()),
            }
        )

    return run


def search(built: DataFrame, terms: DataFrame, k: int = 10) -> DataFrame:
    """(query, item, rank, id, score): the k best documents of a staged index for every query
    of ``item_terms``.

    A term's weight is floor(1000 * ln((2 N + 2) / (2 df + 1))), N being the documents with
    terms and df those with this one; a document's score sums weight times
    (10^9 tf) div (1000 tf + 8 m) over the query's terms with repeats, with
    m = 25 + 75 n N div L. Only scores above 0 rank; equal ones rank by id, null ids last,
    and repeated documents each take a rank. A query without terms, or none of whose terms
    occur, gives no rows.
    """
    listed = built.where("term is null")
    sizes = listed.select(F.explode("ns").alias("n")).where("n > 0")
    n_docs, n_terms = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    postings = built.where("term is not null").withColumn("term", F.col("term").cast("string"))
    df = postings.groupBy("term").agg(F.sum(F.size("at")).alias("df"))
    blocks = -(-terms.count() // BLOCK_TERMS)
    share = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")
    wants = (
        terms.join(df, "term")
        .groupBy(F.pmod(F.xxhash64("query"), F.lit(max(1, blocks))).alias("block"), "term")
        .agg(
            F.collect_list(F.struct("query", "repeats")).alias("queries"),
            F.floor(1000 * F.log(F.first(share))).alias("w"),
        )
    )
    met = postings.join(wants, "term").select("shard", "block", "w", "at", "tf", "queries", "ids", "ns")
    everywhere = listed.select(
        "shard",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, blocks - 1)).cast("long"))).alias("block"),
        *(F.lit(None).cast(met.schema[c].dataType).alias(c) for c in ("w", "at", "tf", "queries")),
        "ids",
        "ns",
    )
    found = (
        everywhere.unionByName(met)
        .groupBy("shard", "block")
        .applyInArrow(_searcher(n_docs, n_terms, k), _FOUND)
    )
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    near = Window.partitionBy("query", F.pmod(F.xxhash64("shard"), F.lit(MERGES))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    everyone = Window.partitionBy("query").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(everyone)).where(F.col("rank") <= k)
    names = terms.select("query", "item").distinct()
    return found.join(names, "query").select("query", "item", "rank", "id", "score")


def rank(
    df: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item, rank, id, score): the k best documents of ``df`` for every item.

    Both tables may hold nulls, empty, long and repeated rows and further columns of any
    name (see ``index``, ``item_terms`` and ``search``); empty tables give no rows. The
    index covers every document and the items' terms; it is staged.
    """
    terms = stage(item_terms(items, item_col, item_text_col))
    built = stage(index(df, id_col, text_col, wanted_by(terms)))
    found = search(built, terms, k)
    return found.select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
