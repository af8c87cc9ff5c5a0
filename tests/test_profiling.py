import pytest
from pyspark.sql import functions as F

from tabscope.operators import inspect, profile
from tests.conftest import column, keyed, plan_of


def described(df, name):
    rows = profile.describe_long(df).where(F.col("column") == name).collect()
    return {r["statistic"]: r["value"] for r in rows}


def test_describe(people):
    assert described(people, "age") == pytest.approx(
        {"count": 4, "mean": 32.5, "std": 6.454972, "min": 25, "25%": 28.75, "50%": 32.5,
         "75%": 36.25, "max": 40}, abs=1e-6)
    assert described(people, "salary") == pytest.approx(
        {"count": 5, "mean": 82000, "std": 39623.225512, "min": 50000, "25%": 60000, "50%": 70000,
         "75%": 80000, "max": 150000}, abs=1e-6)
    assert described(people, "score") == pytest.approx(
        {"count": 4, "mean": 85.25, "std": 5.251984, "min": 78, "25%": 83.25, "50%": 86.5,
         "75%": 88.5, "max": 90}, abs=1e-6)
    wide = profile.describe_wide(people)
    assert wide.columns == ["statistic", "age", "salary", "score"]
    assert keyed(wide, "statistic", "age")["75%"] == 36.25


def test_describe_approximate_is_close(people):
    rows = profile.describe_long(people, ["salary"], exact=False).collect()
    assert {r["statistic"]: r["value"] for r in rows}["50%"] == 70000


def test_describe_without_numbers_raises(people):
    with pytest.raises(ValueError):
        profile.describe_long(people.select("name"))
    with pytest.raises(ValueError):
        profile.top_values(people.select("age"))


def test_schema_and_info(people):
    schema = {r["column"]: r for r in inspect.schema_info(people).collect()}
    assert (schema["age"]["dtype"], schema["age"]["non_null_rate"], schema["age"]["unique_count"]) == ("double", 0.8, 4)
    assert schema["city"]["unique_count"] == 3
    info = {r["column"]: r for r in inspect.frame_info(people).collect()}
    assert (info["score"]["non_null"], info["score"]["missing"], info["score"]["unique"]) == (4, 1, 4)
    assert (info["name"]["table_rows"], info["name"]["table_columns"]) == (5, 5)
    approx = {r["column"]: r["unique_count"] for r in inspect.schema_info(people, exact=False).collect()}
    assert approx["name"] == 5


def test_distinct_counts_of_any_type(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (0.0D, float(1.5), array(1), map('a', 1), true, date'2020-01-01', X'01', 1.10BD),
        (-0.0D, float(1.5), array(1), map('a', 1), false, date'2020-01-01', X'02', 1.1BD),
        (double('NaN'), null, array(2), null, null, null, null, null)
        AS t(z, f, arr, m, b, d, bin, dec)"""
    )
    got = keyed(inspect.schema_info(df), "column", "unique_count")
    assert got == {"z": 1, "f": 1, "arr": 2, "m": 1, "b": 2, "d": 1, "bin": 2, "dec": 1}
    assert keyed(inspect.schema_info(df), "column", "non_null_rate")["z"] == pytest.approx(0.6667)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert keyed(inspect.schema_info(df), "column", "non_null_rate") == {"a": 0.0, "b": 0.0}
    assert keyed(profile.missing_summary(df), "column", "null_pct") == {"a": 0.0, "b": 0.0}
    assert described(df, "a")["count"] == 0 and described(df, "a")["50%"] is None
    assert profile.value_distribution(df, "b").count() == 0
    assert inspect.load_info(df).first()["row_count"] == 0
    assert profile.quality_issues(df).count() == 0
    assert profile.quick_profile(df).count() == 2


def test_missing_and_quick(people):
    assert keyed(profile.missing_summary(people), "column", "null_pct") == {
        "name": 0.0, "age": 20.0, "salary": 0.0, "city": 0.0, "score": 20.0}
    quick = {r["column"]: r for r in profile.quick_profile(people).collect()}
    assert quick["salary"]["mean"] == 82000 and quick["salary"]["std"] == 39623.2255
    assert quick["city"]["mean"] is None and quick["city"]["unique_count"] == 3


def test_value_distribution(people):
    rows = profile.value_distribution(people, "city", 3).collect()
    assert [(r["value"], r["count"], r["pct"], r["total_unique"]) for r in rows] == [
        ("Beijing", 2, 40.0, 3), ("Shanghai", 2, 40.0, 3), ("Guangzhou", 1, 20.0, 3)]
    ages = profile.value_distribution(people, "age", 10).collect()
    assert sum(r["count"] for r in ages) == 4 and ages[0]["pct"] == 20.0


def test_top_values_limit_before_gathering(people):
    top = profile.top_values(people, k=1)
    assert keyed(top, "column", "value") == {"name": "Alice", "city": "Beijing"}
    assert "Partial" in plan_of(top) and plan_of(top).count("WindowGroupLimit") >= 2


def test_quality_issues(people):
    rows = {(r["column"], r["issue"]): (r["n"], r["pct"]) for r in profile.quality_issues(people).collect()}
    assert rows == {("age", "missing_values"): (1, 20.0), ("score", "missing_values"): (1, 20.0),
                    ("salary", "iqr_outliers"): (1, 20.0)}


def test_sample(people):
    one = inspect.sample_rows(people, "name", 2)
    assert one.count() == 2
    assert column(one, "name") == column(inspect.sample_rows(people.repartition(3), "name", 2), "name")
    assert inspect.sample_rows(people, "name", 0).count() == 1
    assert inspect.sample_rows(people, "name", 50).count() == 5
    assert "TakeOrderedAndProject" in plan_of(one)
    assert inspect.head(people, 3).count() == 3
