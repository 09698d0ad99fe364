"""Exact centroid clustering in which bounds spare most distances: ns-bounds.

Each vector keeps, per centroid, its last distance to it and the round of that. Centroids of all rounds are kept, so a
stored bound is loosened by the length of the centroid's whole way since then, which is never more than the sum of its
steps. Only centroids whose loosened bound may still beat the own centroid are measured again, and those exactly: in
integers. Rows are never shuffled: each round is one pass over the state table, and what leaves a task are sums per
centroid and component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabsift.llm.common import nullable, small_batches, staged

#: Relative error allowed to bounds, which are doubles; distances that decide are integers.
SLACK = 1e-9
BATCH_ROWS = 10_000
#: Sums leave a task in parts below this.
LIMB = 2**60


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as integers: of 64 bits where squares of differences fit, else Python's own."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if values.size == 0 or np.abs(scaled).max() < fits(values.shape[-1]):
        return scaled.astype(np.int64)
    exact = [math.floor(x) * scale if abs(x) > 2**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def fits(dims: int) -> int:
    """Components below this have squared distances below 2^62."""
    return math.isqrt(2**62 // max(1, dims)) // 2


def root(squares: np.ndarray) -> np.ndarray:
    """Square roots as doubles; of large integers within one, or infinite."""
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    roots = [math.isqrt(int(x)) for x in squares.tolist()]
    return np.array([float(r) if r < 10**300 else math.inf for r in roots])


def way(then: list[int], now: list[int]) -> float:
    """How far a centroid is from where it was."""
    squares = sum((a - b) ** 2 for a, b in zip(then, now))
    if squares < 2**62:
        return math.sqrt(squares)
    return float(math.isqrt(squares) + 1) if squares < 10**600 else math.inf


class Assigner:
    """Assigns rows to the nearest of the centroids of the last round in ``history`` (rounds x centroids x components)."""

    def __init__(self, history: list[list[list[int]]]):
        self.now = history[-1]
        self.round, self.k, dims = len(history) - 1, len(self.now), len(self.now[0])
        self.large = max(abs(x) for centre in self.now for x in centre) >= fits(dims)
        #: Per round and centroid the way to where it is now.
        self.ways = np.array([[way(old, new) for old, new in zip(then, self.now)] for then in history])
        self.measured = 0

    def assign(self, rows: np.ndarray, own: np.ndarray, bounds: np.ndarray, rounds: np.ndarray, last: bool) -> np.ndarray:
        """Bring ``own``, ``bounds`` and ``rounds`` up to date; the squared distance of each row to its centroid.

        ``rounds`` is -1 where nothing was measured yet. Before the ``last`` pass, the distance is -1 where no bound
        had to be measured again.
        """
        large = self.large or rows.dtype == object
        rows = rows.astype(object) if large else rows
        exact = np.full((len(rows), self.k), -1, rows.dtype)
        each, spare = np.arange(len(rows)), 4 if large else 0  # large roots are whole numbers

        def measure(k: int, which: np.ndarray) -> None:
            at = np.flatnonzero(which)
            apart = rows[at] - np.array(self.now[k], rows.dtype)
            exact[at, k] = (apart * apart).sum(1)
            bounds[at, k], rounds[at, k] = root(exact[at, k]), self.round
            self.measured += len(at)

        new = rounds[:, 0] < 0
        for k in range(self.k):
            measure(k, new)
        with np.errstate(invalid="ignore"):  # infinite bounds give no number, and are measured
            loosened = self.ways[rounds, np.arange(self.k)]
            low, high = bounds - loosened, (bounds + loosened)[each, own]
            slack = SLACK * (bounds + loosened) + spare
            rival = ~(low - high[:, None] > slack + SLACK * high[:, None]) & ~new[:, None]
            rival[each, own] = False
            # The own distance may settle what the bounds left open.
            open_ = ~new if last else rival.any(1)
            for k in range(self.k):
                measure(k, open_ & (own == k))
            high = np.where(open_, bounds[each, own], high)
            rival &= ~(low - high[:, None] > slack + SLACK * high[:, None])
        for k in range(self.k):
            measure(k, rival[:, k])
        best = exact[each, own].copy()
        for k in range(self.k):
            mine = exact[:, k]
            better = (mine >= 0) & ((mine < best) | ((mine == best) & (k < own)))
            best[better], own[better] = mine[better], k
        return best


def kept_vectors(vectors: DataFrame, id_col: str, vector: str, dims: int) -> DataFrame:
    """(id, v): vectors of exactly ``dims`` components, none null or not finite."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    # A null component makes forall null, which the filter drops as it does false.
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"))
    return rows.where((F.size("v") == dims) & finite)


def first_centroids(rows: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors of the ``k`` smallest sha256 of ``seed:id``; ties by the vector, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    return [whole_numbers(np.array([r["v"]], float), scale)[0].tolist() for r in first]


def _state(rows: DataFrame, history: list, scale: int, last: bool = False) -> DataFrame:
    """One pass: every row with its centroid, the distance, and its bounds brought up to date."""
    k, dims = len(history[0]), len(history[0][0])
    schema = rows.select(
        "id", "v", F.lit(0).alias("cluster"), F.lit("").alias("distance"), F.lit(b"").alias("bounds"), F.lit(b"").alias("rounds")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(history)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = dict(zip(batch.schema.names, batch.columns))
            numbers = whole_numbers(column["v"].flatten().to_numpy().reshape(n, dims), scale)
            if "bounds" in column:
                own = column["cluster"].to_numpy().copy()
                bounds = np.frombuffer(b"".join(column["bounds"].to_pylist())).reshape(n, k).copy()
                rounds = np.frombuffer(b"".join(column["rounds"].to_pylist()), np.int16).reshape(n, k).copy()
            else:
                own, bounds, rounds = np.zeros(n, np.int32), np.zeros((n, k)), np.full((n, k), -1, np.int16)
            best = assigner.assign(numbers, own, bounds, rounds, last)
            yield pa.RecordBatch.from_arrays(
                [column["id"], column["v"], pa.array(own.astype(np.int32)), pa.array([str(x) for x in best]),
                 pa.array([b.tobytes() for b in bounds], pa.binary()), pa.array([r.tobytes() for r in rounds], pa.binary())],
                names=["id", "v", "cluster", "distance", "bounds", "rounds"])

    return staged(rows.mapInArrow(run, nullable(schema)), "centroid-state")


def _moved(state: DataFrame, centres: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids at floor(sum / count) of their vectors; those of none stay."""
    dims = len(centres[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = whole_numbers(batch.column("v").flatten().to_numpy().reshape(batch.num_rows, dims), scale)
            own, rows = batch.column("cluster").to_numpy(), []
            for k in np.unique(own).tolist():
                mine = numbers[own == k]
                for place, total in enumerate(mine.sum(0).tolist()):
                    rows += [(k, place, limb, len(mine), x) for limb, x in enumerate(limbs(total))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                names=["cluster", "place", "limb", "n", "total"])

    parts = state.select("v", "cluster").mapInArrow(run, "cluster int, place int, limb int, n long, total long")
    found = parts.groupBy("cluster", "place", "limb").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()
    sums: dict = {}  # centroids x components
    for r in found:
        n, total = sums.get((r["cluster"], r["place"]), (0, 0))
        sums[r["cluster"], r["place"]] = max(n, r["n"]), total + int(r["total"]) * LIMB ** r["limb"]
    moved = [list(c) for c in centres]
    for (k, place), (n, total) in sums.items():
        moved[k][place] = total // n
    return moved


def limbs(total: int) -> list[int]:
    """The number in parts, least first, that add up apart; the first one is always there."""
    parts, rest = [], abs(total)
    while rest or not parts:
        rest, part = divmod(rest, LIMB)
        parts.append(part if total > 0 else -part)
    return parts


def cluster_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3,
    scale: int = 64, seed: int = 1,
) -> DataFrame:
    """One row per vector that takes part: id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of exactly ``dims`` components, none null or not finite, take part, with floor(scale * x) of each component
    x. Centroids start as ``first_centroids``; each of ``rounds`` rounds assigns all vectors to the nearest one (ties: the
    smaller number) and moves it to the floor of their mean; a last pass assigns them to what came out. distance is the
    squared one, the inertias its sums over the cluster and over all; the hash is that of the centroid's components
    joined by commas. Repeated rows and null ids are vectors of their own; fewer than ``k`` vectors are as many
    centroids; an empty table gives no rows. Other columns are not read. A sum that no long holds is null.
    """
    small_batches(vectors.sparkSession, BATCH_ROWS)
    rows = kept_vectors(vectors, id_col, vector, dims)
    first = first_centroids(rows, k, seed, scale)
    names = (id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    if not first:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in names[2:5]),
            F.lit("").alias("centroid_sha256"))
    history, state = [first], rows
    for _ in range(rounds):
        state = _state(state, history, scale)
        history.append(_moved(state, history[-1], scale))
    state = _state(state, history, scale, last=True)
    long = lambda c: F.col(c).try_cast("long") if isinstance(c, str) else c.try_cast("long")
    sums = state.groupBy("cluster").agg(_whole_sum("distance").alias("cluster_inertia")).collect()  # one row a centroid
    total = [None if any(r["cluster_inertia"] is None for r in sums) else sum(int(r["cluster_inertia"]) for r in sums)]
    fit = lambda x: None if x is None or not int(x) < 2**63 else int(x)
    of = {r["cluster"]: fit(r["cluster_inertia"]) for r in sums}
    text = {n: ",".join(map(str, c)) for n, c in enumerate(history[-1])}
    by_cluster = lambda table: F.create_map(*(x for n in of for x in (F.lit(n), table(n))))[F.col("cluster")]
    return state.select(
        F.col("id").alias(id_col), "cluster", long("distance").alias("distance"),
        by_cluster(lambda n: F.lit(of[n]).cast("long")).alias("cluster_inertia"),
        F.lit(fit(total[0])).cast("long").alias("inertia"),
        by_cluster(lambda n: F.sha2(F.lit(text[n]), 256)).alias("centroid_sha256"))


def _whole_sum(name: str) -> Column:
    """The sum of whole numbers as a decimal; null if one has more than 38 digits."""
    number = F.col(name).try_cast("decimal(38,0)")
    return F.when(F.count(F.when(number.isNull(), 1)) == 0, F.try_sum(number))
