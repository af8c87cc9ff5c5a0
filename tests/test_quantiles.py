import numpy as np
import pytest
from pyspark.sql import functions as F

from tabscope.functions import stats
from tabscope.functions.stats import column_quantiles, exact_quantiles, quantile_values, spread_join
from tests.conftest import plan_of

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def frame(spark, values, schema="g string, x double"):
    return spark.createDataFrame(values, schema)


@pytest.mark.parametrize(
    "name, values",
    [
        ("normal", np.random.default_rng(1).normal(0, 10, 5001)),
        ("heavy tail", np.random.default_rng(2).pareto(0.3, 4000)),
        ("few values", np.random.default_rng(3).integers(-3, 4, 3000)),
        ("one value", np.full(100, 7.25)),
        ("single", np.array([3.0])),
        ("two", np.array([1.0, 2.0])),
        ("signs and zeros", np.array([-1e300, -5.0, -0.0, 0.0, 1e-300, 5.0, 1e300])),
        ("dense in one slice", 1.0 + np.arange(2500) * 1e-9),
        ("neighbours and an outlier", np.r_[1.0 + np.arange(2000) * 2.0**-52, 1.08]),
    ],
)
def test_matches_numpy(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    q = quantile_values(df, ["x"], PROBS)["x"]
    assert q == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_several_columns_skip_missing(spark):
    df = spark.createDataFrame(
        [(1, 10.0, None), (2, None, None), (3, float("nan"), None), (4, 20.0, None)],
        "a int, b double, c double",
    )
    assert quantile_values(df, ["a", "b", "c"], (0.5,)) == {"a": [2.5], "b": [15.0], "c": [None]}
    counts = {r["column"]: r["n"] for r in column_quantiles(df, ["a", "b", "c"], (0.5,)).collect()}
    assert counts == {"a": 4, "b": 2}


def test_groups_with_a_hot_one(spark):
    rng = np.random.default_rng(4)
    groups = {"hot": rng.exponential(100, 6000), "zeros": np.r_[np.zeros(4000), 1.0, -1.0], "b": rng.normal(-50, 1, 700), "c": np.array([1.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    done = exact_quantiles(frame(spark, rows), "x", PROBS, by=["g"]).collect()
    assert {r["g"]: r["n"] for r in done} == {g: len(v) for g, v in groups.items()}
    for r in done:
        assert r["q"] == pytest.approx(list(np.quantile(groups[r["g"]], PROBS)), rel=1e-12)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("over, groups", [(0, 1), (50, 2), (50, 1000), (10**6, 1000)])
@pytest.mark.parametrize("rows", [None, "size"])
def test_spread_join_is_a_join(spark, monkeypatch, how, over, groups, rows):
    monkeypatch.setattr(stats, "SPREAD_OVER", over)
    monkeypatch.setattr(stats, "SPREAD_GROUPS", groups)
    facts = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 1000 = 1 THEN NULL ELSE string(id % 40) END AS g")
    figures = spark.sql("SELECT * FROM VALUES ('hot', 1, 1667), ('5', NULL, 83), ('6', 4, 84), ('nowhere', 3, 0) AS t(g, x, size)")
    got = spread_join(facts, figures, ["g"], ["id"], how, rows).select("id", "g", "x")
    want = facts.join(figures, "g", how).select("id", "g", "x")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_spread_join_of_a_hot_group_is_dealt(spark, monkeypatch):
    """A group with a third of all rows stands in no one partition."""
    monkeypatch.setattr(stats, "SPREAD_OVER", 1000)
    settings = {"adaptive.coalescePartitions.enabled": "false", "shuffle.partitions": "16", "autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in settings}
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        facts = spark.range(0, 30_000, 1, 4).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS g")
        figures = facts.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        joined = spread_join(facts, figures, ["g"], ["id"], rows="n")
        parts = joined.select(F.spark_partition_id().alias("p"), (F.col("g") == 0).alias("hot")).groupBy("p", "hot").count()
        sizes = [r["count"] for r in parts.where("hot").collect()]
        assert sum(sizes) == 10_000 and len(sizes) == 16 and max(sizes) < 1000
        assert joined.where("top IS NULL").count() == 0 and joined.count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)


def test_two_keys_and_awkward_names(spark):
    rows = [("a", i % 2, float(i)) for i in range(100)]
    df = frame(spark, rows, "`v` string, `n` int, `c` double")
    done = {r["n"]: r["q"][0] for r in exact_quantiles(df, "c", (0.5,), by=["v", "n"]).collect()}
    assert done == {0: 49.0, 1: 50.0}


def test_plans_have_no_nested_loops(spark):
    df = frame(spark, [("a", 1.0), ("b", 2.0)])
    for plan in (exact_quantiles(df, "x", (0.5,), by=["g"]), column_quantiles(df, ["x"], (0.5,), lazy=True)):
        assert "NestedLoop" not in plan_of(plan) and "Cartesian" not in plan_of(plan)


def test_selection_ends_on_the_data(spark, monkeypatch):
    """Rounds as the values need them, and the same figures as the plan gives."""
    rounds = []
    ask = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, *a, **k: rounds.append(1) or ask(self, *a, **k))
    cases = {"few": np.repeat([1.0, 2.0, 4.0], 50), "spread": np.random.default_rng(1).normal(0, 10, 3000),
             "tight": np.r_[1.0 + np.arange(2000) * 2.0**-52, 1.08], "ends": np.array([-np.inf, 0.0, 3.0, np.inf])}
    needed = {}
    for name, values in cases.items():
        df = spark.createDataFrame([(float(v), float(-v)) for v in values], "x double, y double")
        rounds.clear()
        got = stats.selected(df, ["x", "y", "x"], (0.25, 0.5))
        needed[name] = len(rounds)
        if name != "ends":
            want = {r["column"]: (r["n"], r["q"]) for r in column_quantiles(df, ["x", "y"], (0.25, 0.5), lazy=True).collect()}
            assert {k: (n, pytest.approx(q, rel=1e-12)) for k, (n, q) in got.items()} == want
            assert got["x"][1] == pytest.approx(list(np.quantile(values, (0.25, 0.5))), rel=1e-12)
    assert needed["few"] == 1 and needed["spread"] <= 3 and needed["tight"] <= 5
    assert stats.selected(df.where("false"), ["x"], (0.5,)) == {} and stats.selected(df, [], (0.5,)) == {}
