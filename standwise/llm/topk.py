"""Exact top-k search: tiles of queries and candidates, partial selection, tree merging.

Candidates are packed into shards, queries into blocks, both as matrices of integers. Every
block meets every shard once, on the shard's number; a tile's product is one matrix
multiplication, of which only the best k of each query leave the task. The lists of a query
are merged up a tree of fixed fan-in, so no task sees all lists of a query at once.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from standwise.llm.common import bounded, column
from standwise.sources.staging import stage

SHARD = 4096
BLOCK = 1024
FAN_IN = 16
# Whole numbers up to here are exact in floating point.
EXACT = 2.0**53

_PACKED = "part int, seq int, n int, width int, ids binary, cells binary"


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, v): one row for each id, with floor(scale * x) of every component.

    Rows whose vector or one of its components is null or not finite are left out, and so
    are null ids; of rows with one id the smallest vector counts.
    """
    x = F.transform(column(vector_col), lambda x: x.cast("double"))
    rows = df.select(column(id_col).cast("long").alias("id"), x.alias("x")).where(
        F.col("id").isNotNull()
        & F.coalesce(
            F.forall(
                "x",
                lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
            ),
            F.lit(False),
        )
    )
    rows = rows.groupBy("id").agg(F.min("x").alias("x"))
    return rows.select("id", F.transform("x", lambda x: F.floor(x * F.lit(scale))).alias("v"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of each task packed into matrices of up to ``size`` vectors of one width."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}
        for batch in batches:
            for key, vector in zip(
                batch.column("id").to_pylist(), batch.column("v").to_pylist()
            ):
                group = held.setdefault(len(vector), [])
                group.append((key, vector))
                if len(group) == size:
                    yield _matrix(part, seq, held.pop(len(vector)))
                    seq += 1
        for group in held.values():
            yield _matrix(part, seq, group)
            seq += 1

    return rows.mapInArrow(run, _PACKED)


def _matrix(part: int, seq: int, group: list) -> pa.RecordBatch:
    ids = np.array([key for key, _ in group], "<i8")
    cells = np.array([vector for _, vector in group], "<i8").reshape(len(group), -1)
    values = [part, seq, len(group), cells.shape[1], ids.tobytes(), cells.tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["part", "seq", "n", "width", "ids", "cells"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _read(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    n, width = row[prefix + "n"], row[prefix + "width"]
    return (
        np.frombuffer(row[prefix + "ids"], "<i8"),
        np.frombuffer(row[prefix + "cells"], "<i8").reshape(n, width),
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; the shorter rows count as padded by zeros."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype("f8")).max(initial=0)) * float(np.abs(b.astype("f8")).max(initial=0))
    if most * width < EXACT:
        return (a.astype("f8") @ b.T.astype("f8")).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    limits = np.iinfo(np.int64)
    return np.clip(exact, limits.min, limits.max).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, best first."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _tiles(pairs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                query_ids, queries = _read(row, "q_")
                ids, cells = _read(row, "")
                for query, scores in zip(query_ids.tolist(), products(queries, cells)):
                    places = best(scores, ids, k + 1)
                    chosen = [p for p in places if ids[p] != query][:k]
                    out += [(query, row["shard"], int(ids[p]), int(scores[p])) for p in chosen]
            names = ["query_id", "node", "vec_id", "score"]
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return pairs.mapInArrow(run, "query_id long, node long, vec_id long, score long")


def top_k(
    df: DataFrame,
    queries,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product for each query.

    ``queries`` is a condition on ``id``; candidates are all rows but the query's own. Scores
    are whole numbers, of components floor(scale * x). Ties go to the smaller id. Vectors
    that are null, or hold nulls or values that are not finite, take no part; ids that repeat
    count once; vectors of different lengths are compared over the shorter one. Fewer than k
    candidates give fewer rows; an empty table or no query gives none.
    """
    spark = df.sparkSession
    bounded(spark)
    rows = stage(quantised(df, id_col, vector_col, scale))
    shards = stage(_packed(rows, SHARD))
    number = F.row_number().over(Window.orderBy("part", "seq")) - 1
    # One row per shard and block: some thousand vectors each.
    names = shards.select("part", "seq").withColumn("shard", number.cast("long"))
    count = names.count()
    blocks = _packed(rows.where(queries).coalesce(max(1, count // 4)), BLOCK)
    blocks = blocks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, count - 1)).cast("long"))).alias("shard"),
        *[F.col(c).alias("q_" + c) for c in ("n", "width", "ids", "cells")],
    )
    pairs = blocks.join(shards.join(names, ["part", "seq"]), "shard")
    # Each row is a matrix: small batches keep few of them in a worker.
    found = _tiles(pairs, k)
    while count > 1:
        count = -(-count // FAN_IN)
        found = _merged(found.withColumn("node", F.floor(F.col("node") / FAN_IN)), k)
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", ranked.alias("rank"), "vec_id", "score")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
