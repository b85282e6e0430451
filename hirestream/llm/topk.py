"""Exact top-k search by inner product with the three-phase uniform threshold.

The components are dealt out to a few lists; in each list every vector has a
partial score, and the score is the sum of the partial ones.

1. Each list gives its best entries per query.  Sums of what is known, with the
   list's smallest partial score for the rest, bound the k-th best score from below.
2. Above the smallest partial scores of the lists, that bound is shared out
   evenly: a vector below its share in every list cannot be among the best.  The
   share is sent to all lists, which give every entry that reaches it.
3. The scores of the vectors named by any list are resolved exactly.

Queries are taken in blocks of fixed size, so what is broadcast is bounded; the
table of vectors is shuffled only once, to make its ids unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirestream.llm.common import run_starts, stage

LISTS = 2
QUERY_BLOCK = 2048
ROWS = 4096
#: Found entries a task holds beyond the best ones before it keeps the best of them.
MERGE = 1 << 20
#: Scaled components up to this size keep inner products exact in 64-bit floats and integers.
LARGEST = 1 << 20


def scaled(vectors: DataFrame, asks: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, v array<long>, asks)``: components times ``scale``, rounded down; rows with NULL or non-finite parts are left out.

    Components beyond the 64-bit range are clamped to it.
    """
    v = F.col(f"`{vector_col}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(v, lambda x: F.least(F.greatest(F.floor(scale * x.cast("double")).cast("double"), F.lit(-(2.0**62))),
                                             F.lit(2.0**62)).cast("bigint"))
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull()).where(F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), whole.alias("v"), F.coalesce(asks, F.lit(False)).alias("asks"))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products ``q @ x.T``; plain integers of any size where floats could round."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if max(np.abs(q).max(), np.abs(x).max()) <= LARGEST and q.shape[1] <= 4096:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    exact = q.astype(object) @ x.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Queries:
    """A block of queries of one length, as sent to the tasks."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lists: int):
        self.ids, self.vectors = ids, vectors
        self.parts = [p for p in np.array_split(np.arange(vectors.shape[1]), lists) if len(p)] or [np.arange(0)]


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrices of the vectors of the given length, some thousand at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            sizes = np.diff(part.column(1).offsets.to_numpy())
            fit = sizes == width
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = flat[np.repeat(fit, sizes)].reshape(int(fit.sum()), width)
            if len(rows):
                yield part.column(0).to_numpy(zero_copy_only=False)[fit], rows


def _local_best(vectors: DataFrame, block: Queries, k: int) -> DataFrame:
    """Phase 1 in each task: ``(query, list, vec_id, part, least)``, the best entries of a list and its smallest part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        least = [np.full(len(block.ids), np.iinfo(np.int64).max) for _ in block.parts]
        for ids, x in _chunks(batches, block.vectors.shape[1]):
            for j, dims in enumerate(block.parts):
                part = _products(block.vectors[:, dims], x[:, dims])
                own = block.ids[:, None] == ids[None, :]
                least[j] = np.minimum(least[j], part.min(1))
                part = np.where(own, np.iinfo(np.int64).min, part)
                names = np.broadcast_to(ids, part.shape)
                if j in best:
                    part, names = np.concatenate([best[j][0], part], 1), np.concatenate([best[j][1], names], 1)
                if part.shape[1] > k:
                    top = np.argpartition(-part, k - 1, axis=1)[:, :k]
                    part, names = np.take_along_axis(part, top, 1), np.take_along_axis(names, top, 1)
                best[j] = part, names
        for j, (part, names) in best.items():
            q = np.repeat(block.ids, part.shape[1])
            flat, named = part.ravel(), names.ravel()
            real = flat > np.iinfo(np.int64).min
            low = np.repeat(least[j], part.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(q[real]), pa.array(np.full(int(real.sum()), j, np.int32)), pa.array(named[real]), pa.array(flat[real]),
                 pa.array(low[real])], ["query", "list", "vec_id", "part", "least"])

    return vectors.mapInArrow(run, "query long, list int, vec_id long, part long, least long")


def _best(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``(query, vec_id, score)`` the ``k`` best of each query, ties to the smaller id."""
    q, ids, score = (np.concatenate([r[i] for r in rows]) for i in range(3))
    order = np.lexsort((ids, -1 - score, q))
    q, ids, score = q[order], ids[order], score[order]
    first = run_starts(q)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return q[rank < k], ids[rank < k], score[rank < k]


def _reaching(vectors: DataFrame, block: Queries, cut: dict[int, tuple[int, list[int]]], k: int) -> DataFrame:
    """Phases 2 and 3: the vectors that reach the share in some list, with their scores.

    Of these a task gives those that reach the bound on the k-th best score, and at
    most the ``k`` best of each query, so what is shuffled is bounded by tasks and queries.

    ``cut``: per query the bound above the lists' smallest parts, and these parts.
    A list is tested in whole numbers: lists * (part - least) >= bound.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(block.parts)
        known = np.array([q in cut for q in block.ids.tolist()])
        bound = np.array([float(cut[q][0]) if q in cut else 0.0 for q in block.ids.tolist()])
        least = np.array([cut[q][1] if q in cut else [0] * m for q in block.ids.tolist()], np.float64).reshape(-1, m)
        low, high = -(1 << 63), (1 << 63) - 1
        reach = np.array([min(max(cut[q][0] + sum(cut[q][1]), low), high) if q in cut else low for q in block.ids.tolist()], np.int64)
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for ids, x in _chunks(batches, block.vectors.shape[1]):
            hit = np.repeat(~known[:, None], len(ids), 1)
            for j, dims in enumerate(block.parts):
                part = _products(block.vectors[:, dims], x[:, dims])
                # beyond 2**53 floats round: one unit in a thousand million is added as slack
                over = m * (part.astype(np.float64) - least[:, j : j + 1])
                hit |= over >= (bound - np.abs(bound) * 1e-9 - np.where(np.abs(bound) < 2**50, 0, 1))[:, None]
            hit &= block.ids[:, None] != ids[None, :]
            a, b = np.nonzero(hit)
            if not len(a):
                continue
            score = np.empty(len(a), np.int64)
            for at in range(0, len(a), 1 << 16):
                s = slice(at, at + (1 << 16))
                score[s] = _pairwise(block.vectors[a[s]], x[b[s]])
            enough = score >= reach[a]
            best.append((block.ids[a[enough]], ids[b[enough]], score[enough]))
            held += int(enough.sum())
            if held > MERGE:
                best = [_best(best, k)]
                held = 0
        if best:
            q, ids, score = _best(best, k)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def _pairwise(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if q.size and max(np.abs(q).max(), np.abs(x).max()) > LARGEST:
        return np.clip((q.astype(object) * x.astype(object)).sum(1), -(1 << 63), (1 << 63) - 1).astype(np.int64)
    return (q * x).sum(1)


def top_k(vectors: DataFrame, asks: Column, k: int = 10, lists: int = LISTS, scale: int = 1024,
          query_block: int = QUERY_BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best vectors of each query, all if there are fewer.

    Queries are the rows for which ``asks``, a condition on any columns, holds;
    every other row is a candidate.
    The score is the inner product of the scaled, rounded-down components; ties go
    to the smaller id.  Vectors that are NULL, hold a NULL or non-finite component
    or have no id take no part; vectors of another length than the query are no
    candidates for it.  Rows with equal ids are one vector (the first by value).
    Extra columns are ignored.
    """
    spark = vectors.sparkSession
    rows = scaled(vectors, asks, id_col, vector_col, scale).groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    rows = stage(rows, "vectors")
    ask = rows.where("asks").drop("asks")
    rows = rows.drop("asks")
    schema = "query_id long, rank int, vec_id long, score long"
    widths = [r[0] for r in ask.select(F.size("v")).distinct().collect()]
    found = []
    for width in sorted(widths):
        mine = ask.where(F.size("v") == width)
        n = mine.count()
        blocks = -(-n // query_block)
        for b in range(blocks):
            # blocks by hash: bounded up to chance, and each is gathered on its own
            part = mine.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
            if not part:
                continue
            part.sort(key=lambda r: r[0])
            block = Queries(np.array([r[0] for r in part], np.int64),
                            np.array([r[1] for r in part], np.int64).reshape(len(part), width), lists)
            found.append(_search_block(rows, block, k))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_block(rows: DataFrame, block: Queries, k: int) -> DataFrame:
    m = len(block.parts)
    local = stage(_local_best(rows, block, k), "local-best")
    low = local.groupBy("query", "list").agg(F.min("least").alias("least"))
    lows: dict[int, list[int]] = {}
    for r in low.collect():  # as many rows as queries in the block, times lists
        lows.setdefault(r["query"], [0] * m)[r["list"]] = r["least"]
    # what is known of a vector, and the list's smallest part for the rest
    above = local.drop("least").join(low, ["query", "list"]).groupBy("query", "vec_id").agg(
        F.sum(F.col("part") - F.col("least")).alias("above"))
    nth = above.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.desc("above"), "vec_id"))).where(
        F.col("n") == k).select("query", "above")
    cut = {r["query"]: (r["above"], lows[r["query"]]) for r in nth.collect()}
    return _reaching(rows, block, cut, k)
