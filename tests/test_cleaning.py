import math

import pytest
from pyspark.sql import functions as F

from tabscope.operators import analyze, clean
from tests.conftest import column, keyed, plan_of


@pytest.mark.parametrize(
    "col, strategy, filled",
    [("age", "mean", 32.5), ("age", "median", 32.5), ("score", "mode", 78.0), ("age", "zero", 0.0)],
)
def test_fill(people, col, strategy, filled):
    done = clean.fill_missing(people, col, strategy)
    who = "David" if col == "score" else "Charlie"
    assert keyed(done, "name", col)[who] == filled
    assert done.count() == 5
    assert None not in column(done, col)


def test_fill_drop(people):
    assert sorted(column(clean.fill_missing(people, "age", " DROP "), "name")) == [
        "Alice", "Bob", "David", "Eve",
    ]


def test_fill_mode_of_text_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",), (None,)], "t string")
    assert column(clean.fill_missing(df, "t", "mode"), "t")[-1] == "a"


def test_fill_whole_numbers_become_double(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    done = clean.fill_missing(df, "n", "mean")
    assert done.schema["n"].dataType.simpleString() == "double"
    assert sorted(column(done, "n")) == [1.0, 1.5, 2.0]
    assert clean.fill_missing(df, "n", "zero").schema["n"].dataType.simpleString() == "int"


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (3.0,)], "x double")
    assert sorted(column(clean.fill_missing(df, "x", "mean"), "x")) == [1.0, 2.0, 2.0, 3.0]
    assert sorted(column(clean.fill_missing(df, "x", "drop"), "x")) == [1.0, 3.0]
    assert sorted(column(clean.remove_outliers(df, "x", "iqr"), "x")) == [1.0, 3.0]


def test_fill_of_a_column_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    for strategy in ("mean", "median", "mode"):
        assert column(clean.fill_missing(df, "x", strategy), "x") == [None, None]
    assert column(clean.fill_missing(df, "x", "zero"), "x") == [0.0, 0.0]


def test_outliers_iqr(people):
    assert "David" not in column(clean.remove_outliers(people, "salary", "iqr"), "name")
    # the row with a missing age meets no bound either
    assert clean.remove_outliers(people, "age", "iqr").count() == 4
    assert clean.remove_outliers(people, "salary", "iqr", threshold=100).count() == 5


def test_outliers_zscore(people, spark):
    assert clean.remove_outliers(people, "salary", "zscore").count() == 5
    assert clean.remove_outliers(people, "salary", "zscore", z=1.5).count() == 4
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert clean.remove_outliers(flat, "x", "zscore").count() == 3
    single = spark.createDataFrame([(2.0,)], "x double")
    assert clean.remove_outliers(single, "x", "zscore").count() == 0
    assert clean.remove_outliers(single, "x", "iqr").count() == 1


def test_outliers_of_empty_and_missing(spark):
    empty = spark.createDataFrame([], "x double")
    missing = spark.createDataFrame([(None,)], "x double")
    for method in ("iqr", "zscore"):
        assert clean.remove_outliers(empty, "x", method).count() == 0
        assert clean.remove_outliers(missing, "x", method).count() == 0


def test_scale(people, spark):
    done = clean.normalize_column(people, "salary", "minmax")
    assert column(done, "salary") == pytest.approx([0.0, 0.1, 0.2, 1.0, 0.3])
    done = clean.normalize_column(people, "salary", "standard")
    assert column(done, "salary") == pytest.approx(
        [-0.807607, -0.555230, -0.302853, 1.716165, -0.050475], abs=1e-6
    )
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    for method in ("minmax", "standard"):
        assert column(clean.normalize_column(flat, "x", method), "x") == [2.0, 2.0, None]
    single = spark.createDataFrame([(2.0,)], "x double")
    assert column(clean.normalize_column(single, "x", "standard"), "x") == [None]


def test_unknown_names_raise(people):
    for call in (
        lambda: clean.fill_missing(people, "nope", "mean"),
        lambda: clean.fill_missing(people, "age", "guess"),
        lambda: clean.fill_missing(people, "city", "mean"),
        lambda: clean.remove_outliers(people, "city"),
        lambda: clean.remove_outliers(people, "age", "guess"),
        lambda: clean.normalize_column(people, "city"),
        lambda: clean.normalize_column(people, "age", "guess"),
        lambda: analyze.group_statistics(people, "city", "salary", "median"),
        lambda: analyze.correlation(people, "city", "salary"),
    ):
        with pytest.raises(ValueError):
            call()


def test_drop_duplicates_and_convert(spark):
    df = spark.createDataFrame([(1, "1"), (1, "x"), (2, "3"), (2, "3")], "a int, b string")
    assert clean.drop_duplicates(df, ["a"]).count() == 2
    assert clean.drop_duplicates(df).count() == 3
    assert sorted(column(clean.convert_type(df, "b", "int"), "b"), key=str) == [1, 3, 3, None]


def test_names_with_dots_and_ticks(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "x"), (3.0, "y")], "`a.b` double, `g``h` string")
    assert clean.fill_missing(df, "a.b", "median").where("`a.b` = 2").count() == 1
    assert analyze.group_statistics(df, "g`h", "a.b", "sum").count() == 2


def test_groups(people):
    def by_city(agg):
        return keyed(analyze.group_statistics(people, "city", "salary", agg), "city", f"{agg}(salary)")

    assert by_city("mean") == {"Beijing": 60000, "Guangzhou": 150000, "Shanghai": 70000}
    assert by_city("sum") == {"Beijing": 120000, "Guangzhou": 150000, "Shanghai": 140000}
    assert by_city("count") == {"Beijing": 2, "Guangzhou": 1, "Shanghai": 2}
    assert by_city("min") == {"Beijing": 50000, "Guangzhou": 150000, "Shanghai": 60000}
    assert by_city("max") == {"Beijing": 70000, "Guangzhou": 150000, "Shanghai": 80000}


def test_groups_drop_missing_keys_and_sum_nothing_to_zero(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), ("b", 2.0)], "g string, v double")
    assert keyed(analyze.group_statistics(df, "g", "v", "sum"), "g", "sum(v)") == {"a": 0.0, "b": 2.0}
    assert keyed(analyze.group_statistics(df, "g", "v", "mean"), "g", "mean(v)") == {"a": None, "b": 2.0}


def test_correlation(people, spark):
    row = analyze.correlation(people, "age", "salary").first()
    assert row["coefficient"] == pytest.approx(0.916157, abs=1e-6)
    assert (row["n"], row["strength"], row["direction"]) == (4, "strong", "positive")
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    row = analyze.correlation(flat, "a", "b").first()
    assert row["coefficient"] is None and row["strength"] is None and row["direction"] is None
    down = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], "a double, b double")
    row = analyze.correlation(down, "a", "b").first()
    assert math.isclose(row["coefficient"], -1.0) and row["direction"] == "negative"


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 97).cast("double").alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    assert "GreaterThanOrEqual(x," in plan_of(clean.remove_outliers(df, "x", "iqr"))
    assert "PushedFilters: [IsNotNull(x)" in plan_of(clean.fill_missing(df, "x", "drop"))


def test_the_smallest_of_alike_rows_stays(spark):
    rows = [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0), (2, "a", 0.0), (None, "x", None)]
    df = spark.createDataFrame(rows, "k int, s string, x double").repartition(5)
    kept = clean.drop_duplicates(df, ["k"]).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(1, "a", 3.0), (2, None, 1.0), (None, "x", None)], key=repr)
