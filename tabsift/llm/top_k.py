"""Exact top-k search by inner product with MaxScore pruning.

A query's terms are the components, a posting list is one component of all vectors of a shard. The largest product
that a term can give inside a shard bounds it; terms go by falling bound. Vectors come in blocks. Those terms are
essential whose successors' bounds together reach the k-th best score so far: their postings are read in full, for
many queries by one product (a term that is not essential to a query has no weight there). The other terms alone can't lift a vector to that score, so they are probed only for vectors that are still competitive.
Finished vectors raise the k-th best score, and with it the split, for the blocks that follow. A first round of shards
hands each query's k-th best score to the rest of them. Blocks of queries and shards meet in pairs of bounded size;
the k best of each shard are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabsift.llm.common import staged

#: Vectors of a shard, bytes of the queries that meet it, queries that read postings together, vectors of the first
#: and of the largest block, and non-essential terms probed at a time.
SHARD_ROWS, QUERY_BYTES, TOGETHER, BLOCK_ROWS, LARGEST_BLOCK, STEP = 8_192, 16_000_000, 256, 256, 2_048, 8
#: Of so many shards one is searched in the first round.
FIRST_ROUND = 8
#: Whole numbers up to here are exact as doubles.
EXACT = 2**53


def whole_vectors(vectors: DataFrame, *, id_col: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, dim, terms): floor(scale * x) per component as 64-bit bytes; only vectors that take part.

    Out are vectors without an id, null or empty ones, and those with null or non-finite components. Products of
    components past the range of 64 bits end at its limits.
    """
    source = vectors.select(F.col(id_col).alias("vec_id"), F.transform(vector, lambda x: x.cast("double")).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, terms = [], [], []
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("v")):
                if vec_id is None or not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                x = np.floor(v.values.to_numpy(zero_copy_only=False) * scale)
                if np.isfinite(x).all():
                    ids.append(vec_id), dims.append(len(x))
                    terms.append(np.clip(x, -(2.0**62), 2.0**62).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(terms, pa.binary())],
                names=["vec_id", "dim", "terms"])

    return source.mapInArrow(run, "vec_id long, dim int, terms binary")


def _matrix(part: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(part["terms"]), "<i8").reshape(len(part), -1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, -k)[-k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products that doubles can't hold: whole numbers of any size, cut to 64 bits."""
    scores = [sum(int(a) * int(b) for a, b in zip(query, row)) for row in rows]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in scores], np.int64)


def max_score(
    queries: np.ndarray, postings: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray,
    trace: list | None = None,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the places and scores of the k best vectors but those with id ``own``, of those that reach ``floors``.

    ``trace`` gets per block: its vectors, and by query the essential terms, the postings probed beyond these, and the
    k-th best score before the block.
    """
    bounds = np.maximum(queries * postings.max(1), queries * postings.min(1))
    order = np.argsort(-bounds, axis=1, kind="stable")
    falling = np.take_along_axis(bounds, order, 1)
    # What the terms from here on can add at most.
    rest = np.append(np.cumsum(falling[:, ::-1], 1)[:, ::-1], np.zeros((len(queries), 1)), 1)
    turn = np.argsort(order, axis=1)
    dim, needed = queries.shape[1], floors.copy()
    found = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
    begin, rows = 0, BLOCK_ROWS
    while begin < len(ids):
        block = slice(begin, begin + rows)
        # Essential are the terms up to the last one from which on the bounds still reach the score.
        reaching = rest[:, :-1] >= needed[:, None]
        essential = np.where(reaching.any(1), dim - np.argmax(reaching[:, ::-1], 1), 0)
        partial = np.where(turn < essential[:, None], queries, 0.0) @ postings[:, block]
        least = needed - rest[np.arange(len(queries)), essential]
        alive = (partial >= least[:, None]) & (ids[block] != own[:, None])
        probed, before = np.zeros(len(queries), np.int64), needed.copy()
        for i in np.flatnonzero(alive.any(1)).tolist():
            places = np.flatnonzero(alive[i])
            scores = partial[i, places]
            for at in range(int(essential[i]), dim, STEP):
                some = order[i, at:at + STEP]
                scores = scores + queries[i, some] @ postings[np.ix_(some, begin + places)]
                probed[i] += len(some) * len(places)
                stay = scores + rest[i, at + len(some)] >= needed[i]
                places, scores = places[stay], scores[stay]
                if not len(places):
                    break
            places, scores = np.append(found[i][0], begin + places), np.append(found[i][1], scores)
            best = _best(scores, ids[places], k)
            found[i] = places[best], scores[best]
            if len(best) == k:
                needed[i] = max(needed[i], scores[best[-1]])
        if trace is not None:
            trace.append((len(ids[block]), essential, probed, before))
        begin, rows = begin + rows, min(2 * rows, LARGEST_BLOCK)
    return found


def search_shard(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best vectors of a shard for each query, but those with the query's own id or below the query's ``floor``."""
    shard = shard.loc[shard.index.repeat(shard["copies"])].sort_values("vec_id", kind="stable")
    ids, whole, asked = shard["vec_id"].to_numpy(), _matrix(shard), _matrix(queries)
    found: list[tuple] = []
    top = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (whole, asked)]
    small = top[0] * top[1] * whole.shape[1] < EXACT
    names, keys = queries["vec_id"].to_numpy(), queries["key"].tolist()
    if small:
        postings = np.ascontiguousarray(whole.T.astype(float))
        floors = queries["floor"].astype(float).fillna(-np.inf).to_numpy()
        for begin in range(0, len(asked), TOGETHER):
            some = slice(begin, begin + TOGETHER)
            hits = max_score(asked[some].astype(float), postings, ids, names[some], k, floors[some])
            for vec_id, key, (best, scores) in zip(names[some].tolist(), keys[some], hits):
                found += [(vec_id, key, int(i), int(s)) for i, s in zip(ids[best], scores)]
    else:
        for vec_id, key, query in zip(names.tolist(), keys, asked):
            others = np.flatnonzero(ids != vec_id)
            exact = _exact(query, whole[others])
            best = _best(exact, ids[others], k)
            found += [(vec_id, key, int(i), int(s)) for i, s in zip(ids[others][best], exact[best])]
    return pd.DataFrame(found, columns=["query_id", "key", "vec_id", "score"])


def top_k(
    vectors: DataFrame, is_query: Column, *, k: int = 5, id_col: str = "vec_id", vector: str = "embedding",
    scale: float = 256.0, shard_rows: int = SHARD_ROWS, query_rows: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query with all other rows.

    ``is_query`` is a condition on vec_id. Components become floor(scale * x). Ties go to the smaller id. Vectors
    that can't take part (see ``whole_vectors``) are neither asked nor found; lengths must agree to meet. Rows of
    the query's id are never its results; repeated query rows count once if equal, and are asked on their own if
    not. Fewer other rows than k give all of them; an empty table gives no rows. A block of queries has
    ``query_rows``, by default what QUERY_BYTES hold of the longest vectors; each shard is sent once per block.
    """
    # Of equal rows no more than k can be among the results: a much repeated row burdens no shard.
    rows = staged(whole_vectors(vectors, id_col=id_col, vector=vector, scale=scale).groupBy("vec_id", "dim", "terms").agg(
        F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies")), "whole-vectors")
    queries = rows.where(is_query).drop("copies").withColumn("key", F.xxhash64("terms"))
    vectors_, queries_, longest = rows.groupBy().agg(
        F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    shards = max(1, math.ceil(vectors_ / shard_rows))
    blocks = max(1, math.ceil(queries_ / (query_rows or max(1, QUERY_BYTES // (8 * longest)))))
    first = max(1, shards // FIRST_ROUND)
    # The place in a shard must not depend on the id alone: one id may be on many rows.
    dealt = rows.select("vec_id", "dim", "terms", "copies", F.pmod(F.xxhash64("vec_id", "terms"), F.lit(shards)).cast("int").alias("shard"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    placed = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))
    keys = ["shard", "block", "dim"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "key", "vec_id", "score")})
        return search_shard(left, right, k)

    def searched(asked: DataFrame, begin: int, end: int) -> DataFrame:
        sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(begin), F.lit(end - 1))))
        met = dealt.where(F.col("shard").between(begin, end - 1)).toDF(*dealt.columns)  # columns of its own: both sides are of ``rows``
        return sent.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInPandas(
            search, "query_id long, key long, vec_id long, score long")

    best = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    found = ranked(searched(placed.withColumn("floor", F.lit(None).cast("long")), 0, first))
    if first < shards:
        found = staged(found, "first-shards")
        floors = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "key", F.col("score").alias("floor"))
        later = searched(placed.join(floors, ["vec_id", "key"], "left"), first, shards)
        found = ranked(found.drop("rank").unionByName(later))
    return found.select("query_id", "rank", "vec_id", "score")
