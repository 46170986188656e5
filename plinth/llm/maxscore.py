"""Exact top-k inner-product search by MaxScore over sharded, quantised vectors.

A dimension is a term, its column in a shard a posting list, and q_j times the largest (or smallest) value of the list the
score bound of term j. Per query the terms are sorted by bound. With a threshold (the k-th best score so far) they split into
essential terms, whose lists are traversed, and non-essential ones, whose bounds together can't lift a row over the threshold by
themselves: those are probed term group by term group for rows that are still competitive (partial score + remaining
bounds >= threshold; equal counts, for ties). Shards are merged by score, ties to the smaller id. Scores are sums of integers in
float64 where the greatest possible sum of a shard and query stays below 2**53, else in integers of any length; a score beyond 64 bits is an error, as is a component beyond them.

Candidates are dealt to shards once, each to one. Queries go to every shard and stream past its postings in batches; within a task a shard comes before its queries. So a task holds one shard of
about ``SHARD_ROWS`` rows and one batch, and what is shuffled is the candidates plus queries times shards. No side is broadcast, and a shard returns at most k rows per query.

Defined cases: rows with a null id, and vectors that are null or hold a null or non-finite component take no part; vectors of
unequal length, however long, are padded with zeros; rows that repeat an id are separate candidates, a query leaves out all rows of its own id; repeated query
ids are asked once (the greatest vector); fewer than k candidates: all are returned; of equal scores the smaller id comes first; empty tables give no rows; other columns, whatever they are called, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plinth.llm.common import materialize, pieces_for

K = 10
SCALE = 1024
SHARD_ROWS = 65_536
LEAST_SHARDS = 16  # of tables with LEAST_ROWS for each, so that small tables use several cores
LEAST_ROWS = 2048
_SEEDS = 64
_STEP = 8


def quantise(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id long, v array<long> = floor(scale * x) of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(fine).select(F.col(id_column).cast("long").alias("id"), F.transform(x, lambda c: F.when(F.abs(c * float(scale)) >= 2.0**63, F.raise_error(F.lit("a component beyond 64 bits")).cast("long")).otherwise(F.floor(c * float(scale)))).alias("v"))


def search_shard(ids: np.ndarray, rows: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query id, row id, score of each query's k best rows (more at ties with the k-th) in one shard."""
    most, least = rows.max(axis=0), rows.min(axis=0)
    lists = np.asfortranarray(rows)
    dims = rows.shape[1]
    out_q, out_i, out_s = [], [], []
    for q_id, q in zip(q_ids, queries, strict=True):
        bound = np.maximum(q * most, q * least)
        order = np.argsort(-(bound - np.minimum(q * most, q * least)), kind="stable")  # widest range first
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # rest[e]: bound of terms from e on
        e = max(1, dims // 4)
        partial = lists[:, order[:e]] @ q[order[:e]]
        partial[ids == q_id] = -np.inf
        seeds = min(len(ids), max(_SEEDS, 4 * k))
        best = np.argpartition(-partial, seeds - 1)[:seeds]
        exact = partial[best] + rows[best][:, order[e:]] @ q[order[e:]]
        threshold = np.partition(exact, seeds - k)[seeds - k] if seeds >= k else -np.inf
        # essential: the terms without which no row can reach the threshold
        essential = max(e, int(np.argmax(rest < threshold)) if (rest < threshold).any() else e)
        essential = min(essential, dims // 2)
        if essential > e:
            partial += lists[:, order[e:essential]] @ q[order[e:essential]]
            e = essential
        alive = np.flatnonzero((partial + rest[e] >= threshold) & (partial > -np.inf))
        score = partial[alive]
        while e < dims and len(alive):
            to = min(dims, e + _STEP)
            terms = order[e:to]
            score = score + rows[alive][:, terms] @ q[terms]
            e = to
            if len(score) > k:
                held = score + rest[e] >= threshold
                alive, score = alive[held], score[held]
        if len(score) > k:
            held = score >= np.partition(score, len(score) - k)[len(score) - k]
            alive, score = alive[held], score[held]
        cut = np.lexsort((ids[alive], -score))[:k]
        out_q.append(np.full(len(cut), q_id))
        out_i.append(ids[alive[cut]])
        out_s.append(score[cut].astype(np.int64))
    return np.concatenate(out_q).astype(np.int64), np.concatenate(out_i), np.concatenate(out_s)


def _exact(ids: np.ndarray, rows: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """search_shard for numbers whose products don't fit a float: every score in integers of any length."""
    out: list[tuple[int, int, int]] = []
    for q_id, q in zip(q_ids.tolist(), queries, strict=True):
        scores = [(-sum(map(int.__mul__, r, q)), i) for i, r in zip(ids.tolist(), rows, strict=True) if i != q_id]
        out += [(q_id, i, -s) for s, i in sorted(scores)[:k]]
    return tuple(np.array([x[i] for x in out], np.int64) for i in range(3))


def _matrix(v: list[list[int]]) -> np.ndarray:
    """Rows padded with zeros to one width of at least 1, as 64-bit integers."""
    width = max((len(x) for x in v), default=0) or 1
    if all(len(x) == width for x in v):
        return np.array(v, np.int64).reshape(len(v), width)
    out = np.zeros((len(v), width), np.int64)
    for i, x in enumerate(v):
        out[i, : len(x)] = x
    return out


class Shard:
    """The postings of a shard, for batches of queries."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.floats = rows.astype(np.float64)
        self.most = np.abs(self.floats).max(axis=0, initial=0)

    def search(self, q_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = max(self.rows.shape[1], queries.shape[1])
        pad = lambda a: np.pad(a, ((0, 0), (0, width - a.shape[1])))
        q = queries.astype(np.float64)
        if (np.abs(pad(q)) @ np.pad(self.most, (0, width - len(self.most)))).max(initial=0) >= 2**52:
            return _exact(self.ids, pad(self.rows).tolist(), q_ids, pad(queries).tolist(), k)
        return search_shard(self.ids, pad(self.floats), q_ids, pad(q), k)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id long, rank int, id long, score long. candidates and queries: id long, v array<long>."""
    candidates = materialize(candidates.select("id", "v"), "candidates")
    queries = materialize(queries.groupBy("id").agg(F.max("v").alias("v")), "queries")
    rows = candidates.count()
    shards = max(pieces_for(rows, shard_rows), min(LEAST_SHARDS, rows // LEAST_ROWS), 1)
    # dealt by row number, not by content: rows that repeat each other are no hot shard
    stored = candidates.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), "id", "v")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks"), "id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, shard = None, [], None
        for b in batches:
            number, asks = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = [0, *(np.flatnonzero(np.diff(number) | np.diff(asks)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if number[lo] != at:
                    at, held, shard = number[lo], [], None
                ids, v = b.column(2).to_numpy(zero_copy_only=False)[lo:hi], b.column(3)[lo:hi]
                if not asks[lo]:
                    held.append((ids, _matrix(v.to_pylist())))
                    continue
                if held:
                    width = max(m.shape[1] for _, m in held)
                    shard = Shard(np.concatenate([i for i, _ in held]), np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in held]))
                    held = []
                if shard is not None:
                    found = shard.search(ids, _matrix(v.to_pylist()), k)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["query_id", "id", "score"])

    dealt = stored.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    found = dealt.mapInArrow(run, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
