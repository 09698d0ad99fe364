"""Patience, settings, category means, samples, sections, and summaries that merge, against plain versions."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from suite import queries as Q
from suite import views as V
from tabsift import Roles
from tabsift.operators import boosting, drift, encoding, search, selection, sketches, splitting
from tabsift.plans import drift_store
from tabsift.sources.sinks import read_sections, write_sections
from tabsift.streaming import quantile_bins, read_stream, run_available, score_requests, sketch_stream


@pytest.fixture(scope="module")
def parts(spark, sf):
    return Q.staged(spark, sf)


def plain_patience(values, patience, tolerance):
    best = chosen = last = None
    for k, v in enumerate(values, start=1):
        if last is not None and last - (chosen or 0) >= patience:
            break
        if v is not None and (best is None or v >= best + tolerance):
            best, chosen = v, k
        last = k
    return chosen, best, last


def test_patience_on_any_curve(spark):
    draw = random.Random(3)
    for n in (1, 2, 12, 40):
        values = [None if draw.random() < 0.1 else 0.5 + 0.3 * (1 - math.exp(-k / 6)) + draw.uniform(-0.01, 0.01) for k in range(n)]
        curve = spark.createDataFrame([(k + 1, v) for k, v in enumerate(values)], "round int, value double").repartition(3)
        for patience, tolerance in ((1, 0.0), (3, 0.01), (10, 0.005)):
            got = boosting.patient_round(curve, patience, tolerance).first()
            assert (got["best_round"], got["best_value"], got["stopped_at"]) == plain_patience(values, patience, tolerance)
    none = boosting.patient_round(spark.createDataFrame([(1, None), (2, None)], "round int, value double")).first()
    assert none["best_round"] is None and none["rounds"] == 2


def test_early_stopping_keeps_the_curve(parts):
    from tabsift.operators import training

    leader = training.train_leader(parts.filled, V.RISK, ["total_price", "acctbal"], "AUC", 1, 0, early_stop=True, most_rounds=6, patience=2)
    values = [r["value"] for r in leader.curve.orderBy("round").collect()]
    assert len(values) == 6 and leader.model.stages[-1].getNumTrees == plain_patience(values, 2, boosting.STOP_TOLERANCE)[0]
    with pytest.raises(ValueError):
        boosting.metric_curve(leader.curve, "value", "RMSE")


def test_halving_keeps_the_best():
    names = [f"s{k}" for k in range(10)]
    shares = []

    def score(some, share):
        shares.append((len(some), share))
        return [None if n == "s3" else 0.5 if n in ("s1", "s2") else int(n[1:]) / 10 * share for n in some]

    board = search.halving(names, score, rungs=3, keep=0.3)
    assert [n for n, _ in shares] == [10, 3, 1] and [s for _, s in shares] == pytest.approx([0.09, 0.3, 1.0])
    first = [r for r in board if r[0] == 1]
    assert [r[3] for r in first[:4]] == ["s1", "s2", "s9", "s8"] and first[-1][3] == "s3" and [r[5] for r in first[:4]] == [True, True, True, False]
    assert [r[3] for r in board if r[0] == 3] == ["s1"]  # a tie goes to the earlier one
    assert [r[5] for r in search.halving(["a", "b"], lambda some, share: [float("nan")] * len(some), rungs=1)] == [True, False]
    for bad in ((0, 0.3), (3, 0.0), (3, 1.0)):
        with pytest.raises(ValueError):
            search.rung_shares(*bad)


def test_settings_are_drawn_from_their_numbers():
    few, many = search.random_settings(4, 7), search.random_settings(11, 7)
    assert many[:4] == few and len({s.name for s in many}) == 11 and search.random_settings(4, 8) != few
    with pytest.raises(ValueError):
        search.random_settings(2, 1, ["forest"])


def test_search_finds_the_planted_setting(parts, monkeypatch):
    """Trees of no depth can't tell; the same seed gives the same board."""
    flat = (("maxDepth", 0), ("maxIter", 1))
    deep = (("maxDepth", 4), ("maxIter", 6))
    monkeypatch.setattr(search, "random_settings", lambda n, seed, families: [
        search.Setting(k + 1, "gradient_boosted_trees", deep if k == 2 else flat) for k in range(n)])
    boards = []
    for _ in range(2):
        found = search.search_leader(parts.filled, V.RISK, ["total_price", "acctbal", "seg_signal"], "AUC", settings=4, rungs=2, keep=0.5)
        boards.append([tuple(r) for r in found.leaderboard.collect()])
        assert found.name == "gradient_boosted_trees-3"
    assert boards[0] == boards[1] and [r[0] for r in boards[0]] == [1] * 4 + [2] * 2
    assert boards[0][0][4] > 0.8 and all(0 <= r[4] <= 0.5 for r in boards[0][1:4])


def test_budget_gives_up_slow_fits(spark):
    def slow():
        return float(spark.range(0, 400, 1, 4).rdd.map(lambda x: time.sleep(0.5) or x).count())

    budget = search.Budget(spark, per_model=1.0)
    began = time.time()
    assert budget.run("slow", slow) is None and time.time() - began < 30
    assert search.Budget(spark, per_model=120).run("quick", lambda: float(spark.range(5).count())) == 5.0
    ended = search.Budget(spark, seconds=0.0)
    assert ended.run("first", lambda: 1.0) == 1.0 and ended.run("second", lambda: 2.0) is None
    with pytest.raises(ZeroDivisionError):
        search.Budget(spark, per_model=60).run("wrong", lambda: 1 / 0)


def plain_means(rows, prior):
    labels = [y for _, _, y, _ in rows if y is not None]
    mean = sum(labels) / len(labels) if labels else 0.0
    out, seen = {}, {}
    for row, category, y, _ in sorted(rows, key=lambda r: r[3]):
        total, n = seen.get(category, (0, 0))
        out[row] = (total + prior * mean) / (n + prior)
        if y is not None:
            seen[category] = (total + y, n + 1)
    return out


@pytest.mark.parametrize("blocks", [1, 7])
def test_ordered_means_never_see_their_own_label(spark, blocks):
    draw = random.Random(5)
    rows = [(k, "hot" if k % 3 else draw.choice(["a", "b", None, f"x{k}"]), None if k % 17 == 0 else draw.randint(0, 1), draw.random()) for k in range(600)]
    df = spark.createDataFrame(rows, "id long, c string, y int, place double").repartition(4)
    got = {r["id"]: r["c__mean"] for r in encoding.ordered_target_means(df, ["c"], "y", F.col("place"), 3.0, blocks).collect()}
    wanted = plain_means([(i, "missing" if c is None else c, y, p) for i, c, y, p in rows], 3.0)
    assert got == pytest.approx(wanted)
    assert encoding.ordered_target_means(df, [], "y", F.col("place")) is df
    assert encoding.ordered_target_means(df.limit(0), ["c"], "y", F.col("place")).collect() == []


def test_splits_are_encoded_by_their_training_rows(parts):
    rows = parts.filled.select("risk_id", "partition_date", "label", "total_price", "seg_signal", "priority", "split")
    got = encoding.encode_splits(rows, V.RISK, ["seg_signal", "priority"])
    assert got.count() == rows.count() and {"seg_signal__mean", "priority__mean"} <= set(got.columns) and "priority" not in got.columns
    late = got.filter("split = 'oot'").select("risk_id", "seg_signal__mean").join(rows.select("risk_id", "seg_signal"), "risk_id")
    assert late.groupBy("seg_signal").agg(F.count_distinct("seg_signal__mean").alias("n")).filter("n <> 1").count() == 0
    strong = {r["feature"]: r["importance"] for r in selection.forest_importance(parts.filled, ["acctbal", "segment", "seg_signal"], "label", ["risk_id"]).collect()}
    assert max(strong, key=strong.get) == "seg_signal" and sum(strong.values()) == pytest.approx(1.0)
    assert selection.boosted_importance(parts.filled, ["acctbal", "seg_signal"], "label", order_by=["risk_id"]).first()["feature"] == "seg_signal"


def test_samples_are_the_smallest_hashes(spark, monkeypatch):
    import hashlib

    rows = [(k % 900, k) for k in range(2000)]
    df = spark.createDataFrame(rows, "id long, row long").repartition(5)
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0]))
    for digits, most in ((1, 4096), (1, 3), (4, 3)):
        monkeypatch.setattr(splitting, "PREFIX_DIGITS", digits)
        monkeypatch.setattr(splitting, "ORDERED_ROWS", most)
        for n in (0, 1, 17, 1000, 1999, 2000, 5000):
            got = [r["id"] for r in splitting.sample_rows(df, n, ["id"]).collect()]
            assert sorted(got) == sorted(i for i, _ in order[:n])
    assert splitting.sample_rows(df.limit(0), 3, ["id"]).collect() == []


def test_sections_are_read_by_their_manifest(spark, tmp_path):
    a = spark.createDataFrame([(1, None, ["x"]), (2, float("inf"), None)], "k int, v double, l array<string>")
    b = spark.createDataFrame([], "k int, text string")
    write_sections({"a": a, "b_2": b}, "2024-01-01", str(tmp_path / "e"))
    got = read_sections(spark, str(tmp_path / "e"))
    assert sorted(map(tuple, got["a"].collect())) == sorted(map(tuple, a.collect())) and got["b_2"].schema == b.schema and got["b_2"].count() == 0
    a.limit(1).write.mode("append").json(str(tmp_path / "e/sections/a"))
    with pytest.raises(ValueError, match="manifest"):
        read_sections(spark, str(tmp_path / "e"))
    with pytest.raises(ValueError):
        write_sections({"../x": a}, "2024-01-01", str(tmp_path / "f"))


def test_drift_store_equals_the_whole(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(k, int(rng.integers(0, 2)), f"2024-{1 + k % 5:02d}-03", float(x), None if k % 9 == 0 else float(y)) for k, (x, y) in enumerate(rng.normal(size=(900, 2)))]
    df = spark.createDataFrame(rows, "id long, label int, day string, x double, y double").withColumn("day", F.to_date("day"))
    roles, path = Roles(("id",), "label", "day"), str(tmp_path / "store")
    train = df.filter("id < 400")
    drift_store.start(train, roles, path)
    for name, where in (("b1", "id % 4 = 0"), ("b2", "id % 4 in (1, 2)"), ("b1", "id % 4 = 0"), ("b3", "id % 4 = 3 and month(day) <> 2"), ("late", "id % 4 = 3 and month(day) = 2")):
        drift_store.add(df.filter(where), roles, path, name)
    got = sorted(map(tuple, drift_store.current(spark, path, 200).collect()))
    wanted = sorted(map(tuple, drift.monthly_psi(train, df, roles, min_rows=200).collect()))
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted])
    assert {r["batch"]: r["rows"] for r in drift_store.batches(spark, path).collect()}["b1"] == 225
    with pytest.raises(ValueError):
        drift_store.add(df, roles, path, "a/b")


def test_sketches_merge_within_their_error(spark):
    rows = spark.range(60_000).select((F.col("id") % 6).alias("m"), F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 60_000).cast("double")).alias("x"))
    held = sketches.quantile_sketches(rows, ["m"], ["x"])
    whole = sketches.merged_quantiles(held, []).first()
    assert held.count() == 6 and whole["n"] == 58_800
    edges = sketches.merged_quantiles(held, []).select(sketches.sketched_edges(F.col("sketch"), 4)).first()[0]
    assert all(abs(e - q * 60_000) <= sketches.rank_error() * 60_000 + 60 for e, q in zip(edges, (0, 0.25, 0.5, 0.75, 1)))
    months = sketches.distinct_sketches(rows, ["m"], ["x"])
    found = sketches.distinct_counts(sketches.merged_distinct(months, [])).first()
    assert found["n_rows"] == 60_000 and found["n_valid"] == 58_800
    assert abs(found["n_unique"] - 58_800) <= 4 * sketches.distinct_error() * 58_800


def test_stream_bins_of_odd_windows(spark, tmp_path):
    rows = [(f"2024-01-{1 + k % 3:02d} 10:00:00", None if k % 5 == 0 else float("nan") if k % 7 == 0 else float(k), k % 2) for k in range(300)]
    rows += [("2024-01-09 10:00:00", 1.0, 0)] * 5 + [("2024-01-12 10:00:00", None, 1)]
    df = spark.createDataFrame(rows, "ts string, s double, y int").withColumn("ts", F.to_timestamp("ts"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), df.schema, max_files=1)
    held = run_available(sketch_stream(stream, "ts", "s", "y", "1 day"), "sketches", "complete")
    sizes = {str(r["window_start"])[:10]: r for r in held.collect()}
    assert sizes["2024-01-12"]["count_population"] == 0 and sizes["2024-01-12"]["missing"] == 1
    bins = quantile_bins(held, 4).collect()
    assert {str(r["window_start"])[8:10] for r in bins} == {"01", "02", "03"}  # one value has no bins
    for r in bins:
        mine = [(s, y) for t, s, y in rows if t[:10] == str(r["window_start"])[:10] and s is not None and not math.isnan(s)
                and (s > r["low"] or r["bin"] == 0) and s <= r["high"]]
        assert abs(len(mine) - r["count_population"]) <= r["error_rows"] + 1 and abs(sum(y for _, y in mine) - r["count_positive"]) <= r["error_rows"] + 1


def test_requests_are_scored_once_and_late_ones_kept(spark, parts, tmp_path):
    from tabsift.operators import training

    leader = training.train_leader(parts.filled, V.RISK, ["total_price"], "AUC", 1, 0)
    make = lambda rows: spark.createDataFrame(rows, "risk_id long, t string, total_price double").select("risk_id", F.to_timestamp("t").alias("ts"), "total_price")
    lots = [
        [(1, "2024-01-01 10:00", 1.0), (1, "2024-01-01 11:00", 2.0), (2, "2024-01-02 00:00", 3.0), (7, None, 1.0)],
        [(2, "2024-01-02 03:00", 4.0), (3, "2024-01-03 00:00", None), (4, "2024-01-01 00:00", 5.0)],
        [(5, "2024-01-01 23:00", 6.0), (6, "2024-01-03 01:00", 7.0), (6, "2024-01-03 01:00", 7.0)],
    ]
    for k, lot in enumerate(lots):
        make(lot).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if k != 1:  # the second run takes two files
            stream = read_stream(spark, str(tmp_path / "in"), make(lot).schema, max_files=1)
            scores, late = score_requests(stream, leader.model, leader.features, ["risk_id", "ts"], ["risk_id"], "ts", str(tmp_path / "out"), "12 hours")
    assert sorted(r["risk_id"] for r in scores.collect()) == [1, 2, 3, 6, 7]
    assert str(scores.filter("risk_id = 1").first()["ts"]) == "2024-01-01 10:00:00"
    assert sorted((r["risk_id"], str(r["watermark"])) for r in late.collect()) == [(4, "2024-01-01 12:00:00"), (5, "2024-01-02 12:00:00")]
