"""Exact top-k search by inner product.

Queries are packed in blocks, candidates in shards; a tile is one matrix product of a block and a shard, of which each
query keeps its k best. The lists of a query are then merged in a tree of bounded fan-in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

LARGEST = float(2**62)
EXACT = float(2**53)


def usable_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v``: rows with an id and a vector of finite components, as doubles."""
    v = F.col(embedding).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull())
        .where(sound)
        .select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    )


def _pack(rows: DataFrame, size: int, scale: float, slots: int) -> DataFrame:
    """Packs of at most ``size`` vectors of one length: ``dim, slot, ids, matrix`` (little-endian, floor(scale * x))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        part = TaskContext.get().partitionId()
        waiting: dict[int, list] = {}

        def packed(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, values = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            number += 1
            slot = (part * 7919 + number * 104_729) % slots
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([slot], pa.int32()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                names=["dim", "slot", "ids", "matrix"],
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = np.clip(np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale), -LARGEST, LARGEST)
            flat = flat.astype(np.int64)
            ends = np.cumsum(lengths, dtype=np.int64)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                values = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                for first in range(0, len(at), size):
                    waiting.setdefault(int(dim), []).append((ids[at[first : first + size]], values[first : first + size]))
                    if sum(len(x[0]) for x in waiting[int(dim)]) >= size:
                        yield packed(int(dim))
        for dim in list(waiting):
            yield packed(dim)

    return rows.mapInArrow(run, "dim int, slot int, ids binary, matrix binary")


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < EXACT:  # every partial sum is exact in doubles
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[list, list]:
    """The k best (score, id) of one row, without the query's own id; equal scores by smaller id, an id once."""
    if len(scores) > 4 * k:
        bound = np.partition(scores, len(scores) - 2 * k)[len(scores) - 2 * k]
        near = np.flatnonzero(scores >= bound)
    else:
        near = np.arange(len(scores))
    while True:
        order = near[np.lexsort((ids[near], -scores[near]))]
        order = order[ids[order] != own]
        _, first = np.unique(ids[order], return_index=True)
        order = order[np.sort(first)]
        if len(order) >= k or len(near) == len(scores):
            return scores[order[:k]].tolist(), ids[order[:k]].tolist()
        near = np.arange(len(scores))  # the best places were taken by repeated rows


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_rows: int = 2048,
    shard_rows: int = 16384,
    fan_in: int = 16,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row of ``vectors`` where ``is_query`` (a condition on ``vec_id``) holds.

    The score is the integer inner product of the vectors after floor(scale * x); equal scores go to the smaller id.
    Rows with a null id, a null vector or a null or non-finite component take no part; vectors of different length are
    not compared; empty vectors score 0 with each other. Of rows that share an id only the best counts, for candidates
    and queries alike. A query with fewer than k candidates gets all of them, one without any has no row. Components
    beyond 2**62 count as 2**62, and sums wrap like a long. Other columns are left out.

    A task holds one tile: a block of queries, a shard of vectors and the scores of 256 queries.
    """
    rows = usable_vectors(vectors, vec_id, embedding)
    queries = rows.where(is_query)
    n_rows, n_queries = rows.count(), queries.count()
    slots = max(1, math.ceil(n_rows / shard_rows))
    shards = _pack(rows.repartition(slots), shard_rows, scale, slots)
    blocks = _pack(queries.repartition(max(1, math.ceil(n_queries / block_rows))), block_rows, scale, 1)
    # every block goes to every slot of shards: the query set against all rows, in blocks
    sent = blocks.select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        F.col("ids").alias("query_ids"),
        F.col("matrix").alias("query_matrix"),
    )
    tiles = shards.join(sent, ["dim", "slot"]).select("dim", "slot", "ids", "matrix", "query_ids", "query_matrix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, slot = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                ids, query_ids = (np.frombuffer(batch.column(j)[i].as_py(), np.int64) for j in (2, 4))
                c = np.frombuffer(batch.column(3)[i].as_py(), np.int64).reshape(len(ids), dim)
                q = np.frombuffer(batch.column(5)[i].as_py(), np.int64).reshape(len(query_ids), dim)
                for first in range(0, len(query_ids), 256):
                    own = query_ids[first : first + 256]
                    scores = _product(q[first : first + 256], c)
                    best = [_best(s, ids, int(o), k) for s, o in zip(scores, own)]
                    tops = [[{"score": a, "vec_id": b} for a, b in zip(*pair)] for pair in best]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), pa.array([slot] * len(own), pa.int32()),
                         pa.array(tops, pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())])))],
                        names=["query_id", "part", "top"],
                    )

    lists = tiles.mapInArrow(run, "query_id long, part int, top array<struct<score:long,vec_id:long>>")
    parts = slots
    while True:
        # each round merges up to fan_in lists of a query
        parts = math.ceil(parts / fan_in)
        lists = lists.groupBy("query_id", (F.col("part") / fan_in).cast("int").alias("part")).agg(
            F.flatten(F.collect_list("top")).alias("all")
        )
        ranked = F.array_sort(
            F.array_distinct(F.transform("all", lambda x: F.struct((-x["score"]).alias("down"), x["vec_id"])))
        )
        # of an id that came with several scores, the best one stays
        lists = lists.withColumn("ranked", ranked).withColumn("once", F.expr(
            "filter(ranked, (x, i) -> NOT exists(slice(ranked, 1, i), y -> y.vec_id = x.vec_id))"
        )).select(
            "query_id", "part",
            F.transform(F.slice("once", 1, k), lambda x: F.struct((-x["down"]).alias("score"), x["vec_id"])).alias("top"),
        )
        if parts == 1:
            break
    return lists.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
