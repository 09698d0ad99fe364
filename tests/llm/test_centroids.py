"""Centroid clustering against SQL and a plain version."""

import hashlib
import math

import numpy as np
import pytest

from compare import connect, difference, duck_rows, spark_rows
from tabsift.llm import centroids
from tabsift.llm.oracles import ORACLES
from tabsift.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def plain_clusters(rows, dims=64, k=16, rounds=3, scale=64, seed=1):
    """In Python's integers, every distance measured."""
    good = [(i, [math.floor(x) * scale if abs(x) > 2**53 else math.floor(x * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:k]]
    square = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((square(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        mine = [(nearest(v)[1], v) for _, v in good]
        for n in range(len(centres)):
            held = [v for m, v in mine if m == n]
            centres[n] = [sum(x) // len(held) for x in zip(*held)] if held else centres[n]
    last = [(i, *nearest(v)) for i, v in good]
    long = lambda x: x if x < 2**63 else None
    total = lambda n=None: long(sum(d for _, d, m in last if n in (None, m)))
    sha = lambda n: hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()
    return sorted(((i, n, long(d), total(n), total(), sha(n)) for i, d, n in last), key=repr)


def found(df, **options):
    return sorted(map(tuple, centroids.cluster_vectors(df, **options).collect()), key=repr)


def rows_of(df):
    return [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]


def test_clusters_equal_sql(spark, sf):
    got = spark_rows(QUERIES["op11_centroids"](spark, sf))
    assert difference(got, duck_rows(connect(sf), ORACLES["op11_centroids"])) is None


def test_clusters_of_the_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert found(vectors) == plain_clusters(rows_of(vectors))
    assert found(vectors, k=5, rounds=7, seed=3) == plain_clusters(rows_of(vectors), k=5, rounds=7, seed=3)


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(6)
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, 2.0, 3.0]), (5, [NAN, 1.0]), (6, [1.0, None]), (7, [INF, 0.0]), (8, [-INF, 0.0]),
            (9, [0.0, -0.0]), (9, [0.0, -0.0]), (9, [5.0, 5.0]), (None, [1.0, 1.0]), (None, [1.0, 1.0]), (10, [-0.001, 0.999])]
    rows += [(100 + k, rng.normal(size=2).tolist()) for k in range(60)] + [(200 + k, [2.0, 2.0]) for k in range(30)]
    schema = "vec_id long, embedding array<double>, cluster string, distance string, id long, v string, bounds int"
    return spark.createDataFrame([(*r, "clash", "clash", 1, "clash", 2) for r in rows], schema).repartition(3)


@pytest.mark.parametrize("options", [{}, {"k": 3, "rounds": 6}, {"k": 200}, {"rounds": 0}, {"scale": 1}])
def test_clusters_of_odd_rows(odd, options):
    assert found(odd, dims=2, **options) == plain_clusters(rows_of(odd), dims=2, **options)


def test_no_rows(odd):
    assert found(odd.limit(0)) == [] and found(odd) == []
    assert odd.limit(0).columns and centroids.cluster_vectors(odd).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("size", [1e6, 1e12, 1e150, 1e307])
def test_clusters_of_large_components(spark, size):
    rng = np.random.default_rng(1)
    rows = [(k, (size * rng.normal(size=3)).tolist()) for k in range(60)] + [(k, rng.normal(size=3).tolist()) for k in range(60, 90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert found(df, dims=3, k=4) == plain_clusters(rows, dims=3, k=4)


def test_equal_distances_go_to_the_smaller_number(spark):
    rows = [(k, [float(x), float(y)]) for k, (x, y) in enumerate((x, y) for x in range(-4, 5) for y in range(-4, 5))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for rounds in (1, 4, 9):
        assert found(df, dims=2, k=6, scale=1, rounds=rounds) == plain_clusters(rows, 2, 6, rounds, 1)


def test_bounds_spare_distances():
    """Groups apart: after the first pass few distances are measured, and the ways are those of whole moves."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16)) * 1000
    rows = np.floor(np.concatenate([c + rng.normal(size=(50, 16)) for c in centres])).astype(np.int64)
    there = [[int(x) for x in np.floor(c)] for c in centres]
    away = [[x + 40 for x in c] for c in there]
    back = [[x + 1 for x in c] for c in there]
    own, bounds, rounds = np.zeros(400, np.int32), np.zeros((400, 8)), np.full((400, 8), -1, np.int16)
    first = centroids.Assigner([there])
    first.assign(rows, own, bounds, rounds, False)
    assert first.measured == 400 * 8 and (own == np.repeat(np.arange(8), 50)).all()
    later = centroids.Assigner([there, away, back])
    # Steps of 160 add up to 316; the way there and back is 4.
    assert np.allclose(later.ways[0], 4) and np.allclose(later.ways[1], 39 * 4)
    best = later.assign(rows, own, bounds, rounds, True)
    assert later.measured == 400
    assert (best == ((rows - np.array(back)[own]) ** 2).sum(1)).all()


def test_parts_of_sums():
    for x in (0, 1, -1, 2**60, -(2**60), 2**200 + 5, -(2**1000)):
        assert sum(p * centroids.LIMB**n for n, p in enumerate(centroids.limbs(x))) == x
