"""Operators on vectors against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference, duck_rows, spark_rows
from tabsift.llm import components, near_vectors, top_k
from tabsift.llm.oracles import ORACLES
from tabsift.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, class string, block int"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(3)
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [0.99, 0.1], 1), (2, [0.99, 0.1], 1), (3, [0.0, 0.0], 1), (4, None, 1),
            (5, [1.0, None], 1), (6, [NAN, 1.0], 1), (7, [INF, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (10, [], 1),
            (11, [1.0], 1), (50, [1.0, 0.0], 1), (100, [3.0, -2.0], 3), (None, [1.0, 0.0], 1), (150, [1e30, 1e30], 4), (12, [1e30, 1e30], 4)]
    base = rng.normal(size=2)
    rows += [(200 + k, (base + 0.01 * rng.normal(size=2)).tolist(), 5) for k in range(40)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)


def plain_links(rows, threshold):
    unit = []
    for _, v, tag in rows:
        good = v is not None and len(v) and tag is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) / np.abs(v).max() if good else None
        unit.append(x / np.linalg.norm(x) if good else None)
    n = len(rows)
    links, root = [0] * n, list(range(n))
    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) \
                    and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = {}
    for k, (i, _, _) in enumerate(rows):
        held = least.get(root[k])
        least[root[k]] = i if held is None else held if i is None else min(held, i)
    return sorted(((r[0], links[k], least[root[k]], r[0] == least[root[k]]) for k, r in enumerate(rows)), key=repr)


def found_links(df, **options):
    return sorted(map(tuple, near_vectors.near_vectors(df, **options).collect()), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]


def test_near_vectors_of_the_table(vectors):
    assert found_links(vectors) == plain_links(rows_of(vectors), 0.93)


@pytest.mark.parametrize("options", [{}, {"block": 7}])
def test_near_vectors_of_odd_rows(odd, options):
    assert found_links(odd, **options) == plain_links(rows_of(odd), 0.93)
    assert found_links(odd.limit(0), **options) == []


def test_cells_find_nine_of_ten_links(spark):
    """Small cells and groups of near copies around random centres, with one large group."""
    rng = np.random.default_rng(8)
    rows, number = [], 0
    for group in range(150):
        centre = rng.normal(size=32)
        centre /= np.linalg.norm(centre)
        for _ in range(120 if group == 0 else rng.integers(1, 12)):
            rows.append((number, (centre + 0.03 * rng.normal(size=32)).tolist(), 1))
            number += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = found_links(df, cell_rows=50, block=40)
    wanted = plain_links(rows, 0.93)
    links = lambda found: sum(r[1] for r in found)
    assert all(g[1] <= w[1] for g, w in zip(got, wanted)), "no link twice, none below the threshold"
    assert links(got) >= 0.9 * links(wanted)
    once = found_links(df, cell_rows=50, block=40, nearest=1)
    assert links(once) <= links(got)


def test_every_large_label_gets_cells_of_its_own(spark):
    """Many labels at once: none takes the sample of another, parts of a label agree, and recall holds in each."""
    rng = np.random.default_rng(13)
    rows, number = [], 0
    for label in range(12):
        for _ in range(15 if label == 11 else 80):  # the last label is small
            centre = rng.normal(size=24)
            for _ in range(4):
                rows.append((number, (centre + 0.12 * rng.normal(size=24)).tolist(), label))
                number += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    options = {"cell_rows": 64, "sample_rows": 200}
    classes = near_vectors.unit_vectors(df).select("label", "dim", "class", "unit", F.lit(1).alias("n")).cache()
    centres = near_vectors.fit_cells(classes, **options).cache()
    held = {r["label"]: len(r["centres"]) // 8 // 24 for r in centres.collect()}
    assert sorted(held) == list(range(11)) and all(2 <= k <= 5 for k in held.values())
    whole, parts = (sorted((r["class"], r["cells"]) for r in near_vectors.to_cells(classes, centres, 2, n).collect())
                    for n in (50_000, 30))
    assert whole == parts and len(whole) == len(rows)
    assert all(len(c) == 2 or c == [0] for _, c in whole)
    got, wanted = found_links(df, **options), plain_links(rows, 0.93)
    assert all(g[1] <= w[1] for g, w in zip(got, wanted))
    for label in range(12):
        of = {r[0] for r in rows if r[2] == label}
        links = lambda found: sum(r[1] for r in found if r[0] in of)
        assert links(wanted) and links(got) >= 0.9 * links(wanted)


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(60)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: r for x, r in root.items() if x not in alone}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_top_k_equals_sql(spark, sf):
    assert difference(spark_rows(QUERIES["op4_top_k"](spark, sf)), duck_rows(connect(sf), ORACLES["op4_top_k"])) is None


def plain_top(rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {(i, tuple(v)) for i, v in good if i % 50 == 0}
    for i, q in asked:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 3, "query_rows": 1}, {"k": 1}])
def test_top_k_of_odd_rows(odd, options):
    rows = [r for r in rows_of(odd) if r[0] not in (150, 12)]
    df = odd.where("vec_id is null or vec_id not in (150, 12)")
    got = sorted(map(tuple, top_k.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()))
    assert got == plain_top(rows, options.get("k", 5))
    assert top_k.top_k(odd.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_of_huge_components(odd):
    got = top_k.top_k(odd.where("vec_id in (150, 12)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(150, 12, 2**63 - 1)]


def test_pruning_keeps_ties_and_order(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-2, 3, 24).astype(float).tolist(), 1) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = sorted(map(tuple, top_k.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=400).collect()))
    assert got == plain_top(rows, 5)


def test_threshold_rises_and_spares_postings():
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 64))
    vectors = np.floor(64 * (centres[rng.integers(0, 40, 6000)] + 0.1 * rng.normal(size=(6000, 64))))
    ids, postings = np.arange(6000), np.ascontiguousarray(vectors.T)
    for at in (0, 3000, 5999):
        scores = vectors @ vectors[at]
        wanted = sorted((-s, i) for i, s in zip(ids.tolist(), scores.tolist()) if i != at)[:5]
        trace = []
        search = lambda floor, trace: top_k.max_score(
            vectors[[at]], postings, ids, ids[[at]], 5, np.array([floor]), trace=trace)
        places, found = search(-np.inf, trace)[0]
        assert [(-s, i) for i, s in zip(places.tolist(), found.tolist())] == wanted
        rows, essential, probed, needed = zip(*((n, int(e[0]), int(p[0]), float(s[0])) for n, e, p, s in trace))
        essential, needed = list(essential), list(needed)
        assert sum(rows) == 6000 and needed == sorted(needed) and needed[0] == -np.inf
        assert essential == sorted(essential, reverse=True) and essential[0] == 64 > essential[-1]
        rest = [n * (64 - e) for n, e in zip(rows, essential)]
        assert sum(probed) < sum(rest) / 2
        # The best score of other shards spares the first block as well; results at or above it stay, ties included.
        later = []
        places, found = search(-wanted[2][0], later)[0]
        assert [(-s, i) for i, s in zip(places.tolist(), found.tolist())] == [w for w in wanted if w[0] <= wanted[2][0]]
        assert later[0][1] < 64 and all(a[3][0] >= b[3][0] and a[1][0] <= b[1][0] for a, b in zip(later, trace))


def test_rounds_of_shards_and_repeated_rows(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.integers(-2, 3, 12).astype(float).tolist(), 1) for i in range(300)]
    rows += [rows[7]] * 40 + [rows[50]] * 3 + [(100, [1.0] * 12, 1), (100, [2.0] * 12, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    for options in ({"shard_rows": 10}, {"shard_rows": 10, "query_rows": 2}, {"k": 400, "shard_rows": 10}):
        got = sorted(map(tuple, top_k.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()))
        assert got == plain_top(rows, options.get("k", 5))
