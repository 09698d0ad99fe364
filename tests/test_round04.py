"""Findings of round 4: short fits side by side whatever their partitions, the last fits of a search while it is judged."""

import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabsift import Roles
from tabsift.operators import search, training

ROLES = Roles(ids=("id",), target="label", date="day")


@pytest.fixture(scope="module")
def told(spark):
    """A column that half tells the label, and a text; in more partitions than the session has cores."""
    rows = spark.range(600, numPartitions=8).select("id", (F.col("id") * 7919 % 5 < 2).cast("int").alias("label"))
    return rows.select("id", "label", (F.col("label") * 2.0 + F.col("id") * 31 % 5).alias("half"), (F.col("id") % 3).cast("string").alias("text")).persist()


@pytest.fixture()
def fits(monkeypatch):
    """Of each fit the rows it learned from, and the most fits that ran at a time; the settings are small."""
    monkeypatch.setattr(search, "random_settings", lambda n, seed, families: [
        search.Setting(k + 1, "gradient_boosted_trees", (("maxDepth", k % 3), ("maxIter", 2))) for k in range(n)])
    held, now, seen, fit = threading.Lock(), [], {"rows": [], "at_once": 0}, Pipeline.fit

    def counted(self, rows, *more):
        n = rows.count()
        with held:
            now.append(n)
            seen["rows"].append(n)
            seen["at_once"] = max(seen["at_once"], len(now))
        try:
            return fit(self, rows, *more)
        finally:
            with held:
                now.remove(n)

    monkeypatch.setattr(Pipeline, "fit", counted)
    return seen


def test_short_tasks_leave_room_for_more_fits(spark, told):
    assert training.at_once(told) == training.SHORT_AT_ONCE > 1
    many = spark.range(4_000_000, numPartitions=8)
    assert training.at_once(many) == 1 < training.at_once(many, 0.25)
    assert training.at_once(told.limit(0)) >= 1


def test_the_last_rung_is_fitted_whole_while_it_is_judged(told, fits):
    features, found = ["half", "text"], {}
    for most in (1, None):
        fits |= {"rows": [], "at_once": 0}
        leader = search.search_leader(told, ROLES, features, "AUC", 4, 2, keep=0.5, parallelism=most)
        rows = training.training_rows(told, ROLES, features, 5, 42)
        scored = [tuple(r["probability"]) for r in leader.model.transform(rows).select("probability").collect()]
        found[most] = (leader.name, leader.leaderboard.collect(), sorted(scored), fits["rows"].count(600), fits["at_once"])
    assert found[1][:3] == found[None][:3]
    assert found[1][3:] == (1, 1) and found[None][3] == 2 and found[None][4] > 1


def test_no_fit_runs_ahead_of_a_time_limit(told, fits):
    search.search_leader(told, ROLES, ["half"], "AUC", 4, 2, keep=0.5, seconds=3600)
    assert fits["rows"].count(600) == 1


def test_one_at_a_time_only_the_leader_is_fitted_on_all_rows(told, fits):
    features, found = ["half", "text"], {}
    for most in (1, 3):
        fits["rows"].clear()
        leader = training.train_leader(told, ROLES, features, "AUC", 2, 2, parallelism=most)
        rows = training.training_rows(told, ROLES, features, 2, 42)
        scored = [tuple(r["probability"]) for r in leader.model.transform(rows).select("probability").collect()]
        found[most] = (leader.name, leader.leaderboard.collect(), sorted(scored))
        assert fits["rows"].count(600) == (1 if most == 1 else 2) and len(fits["rows"]) == (5 if most == 1 else 6)
    assert found[1] == found[3]
