import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tabsift import Roles
from tabsift.functions.columns import linear_probs
from tabsift.functions.pvalues import chi2_tail, f_tail
from tabsift.operators import drift, evaluation, profile, ranking, selection, significance
from tabsift.sources import nan_to_null

ROLES = Roles(("id",), "label", "day")
QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def brute_auc(score, label):
    score, label = np.asarray(score, float), np.asarray(label)
    a, b = score[label == 1], score[label == 0]
    return float(np.mean((a[:, None] > b) + 0.5 * (a[:, None] == b)))


def skewed(n=6000, seed=3):
    """A third of the values is one number; the rest is continuous."""
    rng = np.random.default_rng(seed)
    x = rng.lognormal(0, 3, n)
    x[rng.random(n) < 0.34] = -999999.0
    y = (rng.random(n) < 0.3 + 0.2 * (x > 1)).astype(int)
    return x, y


@pytest.mark.parametrize("probs", [linear_probs(10), [0.5], [0.0, 0.999, 1.0]])
def test_quantiles_equal_numpy(spark, probs):
    x, y = skewed()
    df = frame(spark, x=x, z=np.round(x) + 0.0, g=np.where(y == 1, "a", "b")).repartition(7)
    got = ranking.exact_quantiles(df, ["g"], ["x", "z"], probs).collect()
    assert len(got) == 4
    for r in got:
        mine = (x if r["feature"] == "x" else np.round(x))[np.where(y == 1, "a", "b") == r["g"]]
        assert np.allclose(r["quantiles"], np.quantile(mine, probs), rtol=1e-14) and r["n"] == len(mine)


def test_quantiles_do_not_depend_on_cuts(spark):
    x, _ = skewed(2000)
    df = frame(spark, x=x)
    cuts = [{"x": [0.0]}, {"x": [-999999.0, 0.5, 0.5001, 3.0, 1e6]}, {"x": sorted(set(x))[::5]}]
    results = [ranking.exact_quantiles(df, [], ["x"], [0.1, 0.4, 0.9], c).first()["quantiles"] for c in cuts]
    assert results[0] == results[1] == results[2]


def test_signed_zero_is_one_value(spark):
    df = frame(spark, x=[0.0, -0.0, 0.0, -0.0, 1.0, -1.0], label=[1, 0, 0, 1, 1, 0])
    got = ranking.rank_sums(df, [], ["x"], "label", {"x": [0.0]}).first()
    assert got["positive_rank_sum"] == 3.5 + 3.5 + 6


def test_auc_and_spearman(spark):
    x, y = skewed()
    df = frame(spark, x=x, label=y, m=np.where(np.arange(len(x)) % 3 == 0, "a", "b"))
    got = evaluation.auc(df, "x", "label", ["m"]).collect()
    for r in got:
        mine = np.where(np.arange(len(x)) % 3 == 0, "a", "b") == r["m"]
        assert r["auc"] == pytest.approx(brute_auc(x[mine], y[mine]), abs=1e-12)
    rho = significance.spearman(df, ["x"], "label").first()["rho"]
    assert rho == pytest.approx(pd.Series(x).rank().corr(pd.Series(y)), abs=1e-12)


def test_constant_scores(spark):
    df = frame(spark, s=[0.5] * 30, label=[0, 1, 1] * 10, day=["2024-01-05"] * 30, id=range(30))
    assert evaluation.auc(df, "s", "label").first()["auc"] == 0.5
    assert significance.spearman(df, ["s"], "label").first()["rho"] is None
    bins = evaluation.score_bins(df, ROLES, "s").collect()
    assert len(bins) == 1 and bins[0]["error"] == evaluation.NO_EDGES


def test_average_precision(spark):
    x, y = skewed(3000)
    got = evaluation.average_precision_by(frame(spark, s=x, label=y), "s", "label").first()["average_precision"]
    t = pd.DataFrame({"s": x, "y": y}).groupby("s").y.agg(["sum", "size"]).sort_index(ascending=False)
    tp, n = t["sum"].cumsum(), t["size"].cumsum()
    assert got == pytest.approx(float((t["sum"] / t["sum"].sum() * tp / n).sum()), abs=1e-12)


def pandas_bins(x, q):
    return pd.qcut(x, q=q, labels=False, duplicates="drop")


@pytest.mark.parametrize("q", [10, 5])
def test_score_bins_equal_qcut(spark, q):
    x, y = skewed(2500)
    x = np.where(x > 0, np.round(x, 1), x)
    df = frame(spark, s=x, label=y, day=["2024-02-03"] * len(x), id=range(len(x)))
    got = {r["bin"]: (r["count_population"], r["count_positive"]) for r in evaluation.score_bins(df, ROLES, "s", q).collect()}
    want = pd.DataFrame({"b": pandas_bins(x, q), "y": y}).groupby("b").y.agg(["size", "sum"])
    assert got == {int(b): (int(r["size"]), int(r["sum"])) for b, r in want.iterrows()}


def test_small_and_flat_months(spark):
    days = ["2024-01-02"] * 10 + ["2024-02-02"] * 30 + ["2024-03-02"] * 30
    label = [0, 1] * 5 + [1] * 30 + [0, 1] * 15
    df = frame(spark, s=np.linspace(0, 1, 70), label=label, day=days, id=range(70))
    got = {r["month"]: r for r in evaluation.monthly_auc(df, ROLES, "s").collect()}
    assert got["2024-01"]["error"] and got["2024-02"]["error"] and got["2024-03"]["error"] is None
    halves = {r["period"]: r["months"] for r in evaluation.early_vs_latest(df, ROLES, "s").collect()}
    assert halves == {"early": ["2024-01"], "latest": ["2024-02", "2024-03"]}
    single = evaluation.early_vs_latest(df.filter("day = '2024-03-02'"), ROLES, "s").collect()
    assert [r["error"] for r in single] == [evaluation.NO_PERIODS]


def numpy_psi(expected, actual, bins=10):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    e, a = np.histogram(expected, edges)[0], np.histogram(actual, edges)[0]
    pe, pa = (e + 1e-8) / (e.sum() + 1e-7), (a + 1e-8) / (a.sum() + 1e-7)
    return float(max(0, min(10, np.sum((pa - pe) * np.log(pa / pe)))))


def test_psi_equals_numpy(spark):
    x, y = skewed()
    split = np.where(np.arange(len(x)) % 4 == 0, "oot", "train")
    shifted = np.where(split == "oot", x * 1.7, x)
    df = frame(spark, a=x, b=shifted, c=np.round(x), label=y, split=split)
    got = {r["feature"]: r for r in drift.psi(df, ["a", "b", "c"]).collect()}
    for name, v in (("a", x), ("b", shifted), ("c", np.round(x))):
        assert got[name]["psi"] == pytest.approx(numpy_psi(v[split == "train"], v[split == "oot"]), abs=1e-10)
    assert got["b"]["out_of_range_share"] > 0


def test_psi_undefined(spark):
    df = frame(spark, two=[1.0] * 40, label=[0, 1] * 20, split=["train"] * 30 + ["oot"] * 10)
    few = df.filter("split = 'train'").limit(30).unionByName(df.filter("split = 'oot'").limit(5))
    assert drift.psi(df, ["two"]).first()["psi"] == math.inf
    assert drift.psi(few, ["two"], undefined=0.0).first()["psi"] == 0.0


@QUICK
@given(st.lists(st.integers(-50, 50), min_size=60, max_size=120))
def test_psi_of_itself_is_zero(spark, values):
    pdf = pd.DataFrame({"x": [float(v) for v in values]})
    both = pd.concat([pdf.assign(split="train"), pdf.assign(split="oot")])
    got = drift.psi(spark.createDataFrame(both), ["x"], undefined=0.0).first()["psi"]
    assert got == pytest.approx(0.0, abs=1e-9)


@QUICK
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1)), min_size=12, max_size=80))
def test_auc_of_reversed_and_mapped_scores(spark, rows):
    if len({y for _, y in rows}) < 2:
        return
    pdf = pd.DataFrame(rows, columns=["s", "label"]).astype({"s": float})
    stacked = pd.concat([pdf.assign(k="plain"), pdf.assign(k="minus", s=-pdf.s), pdf.assign(k="cubed", s=pdf.s**3 - 7)])
    got = {r["k"]: r["auc"] for r in evaluation.auc(spark.createDataFrame(stacked).repartition(3), "s", "label", ["k"]).collect()}
    assert got["plain"] + got["minus"] == pytest.approx(1.0) and got["plain"] == got["cubed"]


def test_p_values(spark):
    # Tabulated critical values.
    for x, dof, p in [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05), (1.0, 3, 0.8012519569012009)]:
        assert chi2_tail(x, dof) == pytest.approx(p, abs=1e-12)
    for x, d1, d2, p in [(4.964602743730711, 1, 10, 0.05), (3.841459, 1, 10**9, 0.05), (2.0, 2, 8, 1.5**-4)]:
        assert f_tail(x, d1, d2) == pytest.approx(p, abs=2e-6)
    assert chi2_tail(5000.0, 4) < 1e-300 and chi2_tail(0.0, 3) == 1.0
    assert chi2_tail(2000.0, 2000) == pytest.approx(0.4958, abs=1e-3)


def test_chi2_equals_the_library_without_correction(spark):
    rng = np.random.default_rng(5)
    c, y = rng.integers(0, 6, 900), rng.integers(0, 2, 900)
    df = frame(spark, c=c.astype(float), s=[f"v{v}" for v in c], label=y)
    table = profile.contingency(df, ["s"], "label")
    got = profile.chi2_two_columns(table, F.col("n0"), F.col("n1")).first()
    lib = ChiSquareTest.test(VectorAssembler(inputCols=["c"], outputCol="f").transform(df), "f", "label").first()
    assert got["chi2"] == pytest.approx(lib["statistics"][0], rel=1e-10)
    assert got["p"] == pytest.approx(lib["pValues"][0], rel=1e-9)


def test_two_by_two_is_corrected_and_one_row_has_no_test(spark):
    df = frame(spark, s=["a"] * 30 + ["b"] * 30, t=["x"] * 60, label=[1] * 20 + [0] * 10 + [1] * 10 + [0] * 20)
    got = {r["feature"]: r for r in profile.chi2_two_columns(profile.contingency(df, ["s", "t"], "label"), F.col("n0"), F.col("n1")).collect()}
    assert got["s"]["chi2"] == pytest.approx(60 * (abs(20 * 20 - 10 * 10) - 30) ** 2 / 30**4)
    assert got["t"]["chi2"] is None and got["t"]["p"] is None


def test_mutual_information_bounds(spark):
    df = frame(spark, same=["a", "b"] * 50, free=["a", "a", "b", "b"] * 25, label=[0, 1] * 50)
    got = {r["feature"]: r["mi"] for r in profile.mutual_information(profile.contingency(df, ["same", "free"], "label"), F.col("n0"), F.col("n1")).collect()}
    assert got["same"] == pytest.approx(math.log(2)) and got["free"] == pytest.approx(0, abs=1e-12)


def test_quality_rules(spark):
    n = 400
    rng = np.random.default_rng(2)
    y = np.tile([0, 1, 1, 0], n // 4)
    df = frame(
        spark, id=range(n), day=["2024-01-01"] * n, label=y,
        sparse=[1.0 * i if i < 20 else float("nan") for i in range(n)],
        const=[3.0] * n, good=y + rng.normal(0, 0.1, n), flat=1000.0 + np.tile([0.1, 0.1, 0.2, 0.2], n // 4) * 0.01,
        unique=[f"u{i}" for i in range(n)], single=["a"] * n, tied=np.where(y == 1, "p", "q"),
    ).withColumn("few", F.lit(None).cast("double"))
    df = nan_to_null(df)
    got = {r["feature"]: (r["keep"], r["reason"].split(":")[0].split(" (")[0]) for r in profile.quality_verdict(df, ROLES).collect()}
    assert got == {
        "sparse": (False, "Excessive missing values"), "few": (False, "Excessive missing values"),
        "const": (False, "Zero variance"), "good": (True, "Target correlated"), "flat": (False, "Very low variability"),
        "unique": (False, "High cardinality"), "single": (False, "Single unique value"), "tied": (True, "Target associated"),
    }


def test_grades(spark):
    rows = [(0.9, 0.81), (0.9, 0.8), (0.7, 0.65), (0.9, 0.6), (0.99, 0.8)]
    df = spark.createDataFrame(rows, "train_score double, oot_score double")
    got = [r["performance_level"] for r in evaluation.grade_performance(df, "auc").collect()]
    assert got == [evaluation.LEVELS[i] for i in (0, 1, 2, 3, 1)]
    other = evaluation.grade_performance(df, "accuracy").collect()
    assert other[0]["performance_level"] == evaluation.LEVELS[1]
    assert [r["overfitting_level"] for r in other][3:] == [evaluation.GAP_LEVELS[0], evaluation.GAP_LEVELS[0]]


def test_reconcile_with_repeated_ids(spark):
    a = spark.createDataFrame([(1, 0.1), (1, 0.1), (2, 0.5), (3, 0.2), (5, None), (6, 0.3), (6, 0.9)], "id int, score double")
    b = spark.createDataFrame([(1, 0.1), (2, 0.6), (4, 0.2), (5, None), (6, 0.3)], "id int, score double")
    got = evaluation.reconcile_scores(a, b, ["id"], tolerance=0.01).first()
    assert (got["matched"], got["mismatched"], got["only_a"], got["only_b"]) == (1, 3, 1, 1)


def brute_selection(rows, most=None, fill_to=0):
    """The rules of the selection spelled out on a list of (feature, kind, stability, score)."""
    rows = sorted(rows, key=lambda r: (-r[3], r[0]))
    scores = [r[3] for r in rows]
    mean, floor = np.mean(scores), max(0.001, np.mean(scores) - 2 * np.std(scores))
    high, moderate = [], []
    for f, kind, s, score in rows:
        if score > floor:
            if s is None:
                moderate += [f] if score > mean else []
            elif kind == "numeric":
                (high if s < 0.4 else moderate if s < 1.0 else []).append(f)
            else:
                (high if s > 0.01 else moderate).append(f)
    chosen = high + moderate
    for f, _, _, score in rows:
        if len(chosen) < fill_to and f not in chosen and score > 0:
            chosen.append(f)
    return chosen[:most]


@pytest.mark.parametrize("n, seed, options", [
    (8, 1, {}), (30, 2, {"fill_to": 50}), (30, 2, {"fill_to": 25}), (70, 3, {"most": 20}), (640, 4, {})])
def test_selection_rules(spark, n, seed, options):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = "numeric" if rng.random() < 0.6 else "categorical"
        s = None if rng.random() < 0.1 else float(rng.random() * (1.5 if kind == "numeric" else 0.05))
        rows.append((f"f{i:03d}", kind, s, float(rng.random() ** 3 if rng.random() < 0.8 else 0.0005 * rng.integers(0, 2))))
    df = spark.createDataFrame(rows, "feature string, kind string, stability double, score double")
    got = selection.rank_selected(df, **options).filter("selected").orderBy("rank").collect()
    assert [r["feature"] for r in got] == brute_selection(rows, **options)


def test_monthly_category_psi_equals_numpy(spark):
    rng = np.random.default_rng(9)
    train = pd.DataFrame({"s": rng.choice(list("abcd"), 500, p=[0.4, 0.3, 0.2, 0.1])})
    months = pd.DataFrame({"s": rng.choice(list("abce"), 300), "day": np.where(np.arange(300) < 200, "2024-01-03", "2024-02-03")})
    months.loc[:199, "s"] = months.loc[:199, "s"].replace({"a": "b"})
    df = spark.createDataFrame(months.assign(id=range(300), label=0))
    base = spark.createDataFrame(train.assign(id=range(500), label=0, day="2023-01-01"))
    got = {r["month"]: r["psi"] for r in drift.monthly_category_psi(base, df, ROLES).collect()}
    for month, part in (("2024-01", months.s[:200]), ("2024-02", months.s[200:])):
        values = sorted(set(train.s) | set(part))
        e = np.array([(train.s == v).sum() for v in values])
        a = np.array([(part == v).sum() for v in values])
        pe, pa = (e + 1e-8) / (e.sum() + 1e-7), (a + 1e-8) / (a.sum() + 1e-7)
        assert got[month] == pytest.approx(min(10.0, float(np.sum((pa - pe) * np.log(pa / pe)))), abs=1e-9)
