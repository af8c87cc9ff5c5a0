import numpy as np
import pytest

from tabscope.functions import stats
from tabscope.operators import charts
from tests.conftest import column, keyed


@pytest.fixture(scope="module")
def sales(spark):
    rows = [("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", 5.0), ("b", "x", 7.0), ("a", None, 2.0),
            (None, "x", 4.0), ("c", "y", None)]
    return spark.createDataFrame(rows, "cat string, grp string, val double")


def test_bar(sales):
    rows = {r["label"]: r for r in charts.bar(sales, "cat", "val").collect()}
    assert (rows["a"]["top"], rows["a"]["bottom"], rows["a"]["n"]) == (3.0, 1.0, 3)
    assert rows["c"]["top"] is None and rows["c"]["n"] == 0


def test_bar_grouped(sales):
    rows = {(r["x"], r["group"]): r["mean"] for r in charts.bar(sales, "cat", "val", "grp").collect()}
    assert rows == {("a", "x"): 1.0, ("a", "y"): 3.0, ("b", "x"): 6.0, ("c", "y"): None}
    assert keyed(charts.bar_wide(sales, "cat", "val", "grp", ["x", "y"]), "cat", "x") == {"a": 1.0, "b": 6.0, "c": None}


def test_points_are_whole(sales):
    assert charts.line(sales, "cat", "val").count() == 7
    assert charts.line(sales, "cat", "val", "grp").count() == 6
    assert charts.scatter(sales, "cat", "val").count() == 5
    assert charts.scatter(sales, "cat", "val", "grp").count() == 4


def bins(df, **where):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    rows.sort(key=lambda r: r["bin"])
    return [r["count"] for r in rows], [r["lo"] for r in rows] + [rows[-1]["hi"]]


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(1).exponential(50, 2000),
        np.arange(0, 101) / 10.0,
        np.array([0.1, 0.2, 0.30000000000000004, 0.7, 2.1]),
        np.array([5.0, 5.0, 5.0]),
        np.array([-3.0, 3.0]),
        np.arange(21.0),
    ],
)
def test_hist_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    counts, edges = bins(charts.hist(df, "v"))
    want, want_edges = np.histogram(values, bins=20)
    assert counts == list(want)
    assert edges == pytest.approx(list(want_edges))


def test_hist_per_group(spark):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(0, 1, 400), "b": rng.normal(100, 20, 300), "c": np.array([1.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [(None, 3.0), ("a", None)]
    done = charts.hist(spark.createDataFrame(rows, "g string, v double"), "v", "g")
    for g, vs in data.items():
        counts, edges = bins(done, group=g)
        want, want_edges = np.histogram(vs, bins=20)
        assert counts == list(want) and edges == pytest.approx(list(want_edges))
    assert done.count() == 60


def test_hist_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert charts.hist(df, "v").count() == 0


def test_pie(sales, spark):
    rows = charts.pie(sales, "cat").collect()
    assert [(r["label"], r["value"], r["share"]) for r in rows] == [("a", 3, 50.0), ("b", 2, 33.3333), ("c", 1, 16.6667)]
    sums = keyed(charts.pie(sales, "cat", "val", "cat"), "label", "value")
    assert sums == {"a": 6.0, "b": 12.0, "c": 0.0}
    many = spark.createDataFrame([(f"k{i:02}",) for i in range(15) for _ in range(i + 1)], "k string")
    shown = charts.pie(many, "k")
    assert shown.count() == 10 and sum(column(shown, "share")) == pytest.approx(100, abs=0.01)


def box_of(values):
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    fliers = [v for v in values if v < lower or v > upper]
    return (q1, median, q3, min(min(v for v in values if v >= lower), q1),
            max(max(v for v in values if v <= upper), q3), len(fliers))


def test_box(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.standard_t(2, 500), "b": rng.exponential(5, 300), "c": np.array([2.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    names = ("q1", "median", "q3", "whisker_lo", "whisker_hi", "n_fliers")
    for r in charts.box(df, "v", "g").collect():
        assert [r[n] for n in names] == pytest.approx(list(box_of(data[r["label"]])))
    whole = np.concatenate([*data.values(), [1.0]])
    row = charts.box(df, "v").first()
    assert row["label"] == "v" and [row[n] for n in names] == pytest.approx(list(box_of(whole)))
    assert charts.box_fliers(df, "v", "g").where("label = 'b'").count() == box_of(data["b"])[-1]


def test_box_of_a_hot_group_of_equal_values(spark, monkeypatch):
    """90 % equal values in a group that holds most rows; repeats of an outlier are all drawn."""
    monkeypatch.setattr(stats, "SPREAD_OVER", 50)
    monkeypatch.setattr(charts, "REPEATS", 7)
    data = {"hot": [5.0] * 1800 + [float(i) for i in range(100)] + [900.0] * 60 + [-0.0] * 40, "few": [1.0, 2.0, 3.0, 50.0], "one": [4.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    names = ("q1", "median", "q3", "whisker_lo", "whisker_hi", "n_fliers")
    rows = charts.box(df, "v", "g").collect()
    assert {r["label"]: r["n"] for r in rows} == {g: len(vs) for g, vs in data.items()}
    for r in rows:
        assert [r[n] for n in names] == pytest.approx(list(box_of(data[r["label"]])))
    drawn = charts.box_fliers(df, "v", "g").where("label = 'hot'").groupBy("value").count()
    want = {float(i): 1 for i in range(1, 100) if i != 5} | {900.0: 60, 0.0: 41}
    assert keyed(drawn, "value", "count") == want


def test_unknown_columns(sales):
    for call in (
        lambda: charts.bar(sales, "nope", "val"),
        lambda: charts.bar(sales, "cat", "grp"),
        lambda: charts.hist(sales, "cat"),
        lambda: charts.line(sales, "cat", "val", "nope"),
    ):
        with pytest.raises(ValueError):
            call()
