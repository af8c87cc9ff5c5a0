import pytest
from pyspark.sql import functions as F

from tabscope.plans.cleaning import run_plan
from tabscope.operators import clean
from tabscope.plans.versions import VersionedTable
from tests.conftest import column, keyed


def log_rows(run):
    return [tuple(r) for r in run.log.orderBy("step").collect()]


def test_plan_defaults_and_log(people):
    run = run_plan(
        people,
        [
            {"column": "age", "action": "fill_missing"},
            {"column": "salary", "action": "remove_outliers"},
            {"column": "score", "action": "fill_missing", "params": {"strategy": "drop"}},
            {"column": "salary", "action": "normalize_column", "params": {}},
            {"column": "city", "action": "uppercase"},
            {"column": "nope", "action": "fill_missing"},
            {"column": "city", "action": "fill_missing", "params": {"strategy": "mean"}},
        ],
    )
    log = log_rows(run)
    assert [(r[0], r[2], r[3].split(":")[0], r[4], r[5]) for r in log] == [
        (1, "fill_missing", "applied", 5, 5),
        (2, "remove_outliers", "applied", 5, 4),
        (3, "fill_missing", "applied", 4, 4),
        (4, "normalize_column", "applied", 4, 4),
        (5, "uppercase", "skipped", 4, 4),
        (6, "fill_missing", "failed", 4, 4),
        (7, "fill_missing", "failed", 4, 4),
    ]
    done = keyed(run.df, "name", "salary")
    assert done == pytest.approx({"Alice": 0.0, "Bob": 1 / 3, "Charlie": 2 / 3, "Eve": 1.0})
    assert keyed(run.df, "name", "age")["Charlie"] == 32.5


def test_plan_sees_earlier_steps(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 1000]] + [(None,)], "x double")
    run = run_plan(
        df,
        [
            {"column": "x", "action": "remove_outliers", "params": {"threshold": "1.5"}},
            {"column": "x", "action": "remove_outliers", "params": {"method": "zscore"}},
            {"column": "x", "action": "normalize_column", "params": {"method": "minmax"}},
        ],
    )
    assert sorted(column(run.df, "x")) == pytest.approx([0, 1 / 3, 2 / 3, 1])
    assert [r[4:] for r in log_rows(run)] == [(6, 4), (4, 4), (4, 4)]


def test_plan_with_deduplication(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, t string")
    run = run_plan(
        df,
        [
            {"column": "k", "action": "fill_missing", "params": {"strategy": "drop"}},
            {"action": "drop_duplicates"},
            {"column": "k", "action": "drop_duplicates"},
            {"column": "k", "action": "convert_type", "params": {"dtype": "string"}},
        ],
    )
    assert [r[4:] for r in log_rows(run)] == [(4, 3), (3, 2), (2, 2), (2, 2)]
    assert sorted(column(run.df, "k")) == ["1", "2"]


def test_empty_plan(people):
    run = run_plan(people, [])
    assert run.df.count() == 5 and run.log.count() == 0


def test_plan_length_does_not_nest(people):
    steps = [{"column": "age", "action": "fill_missing", "params": {"strategy": "median"}},
             {"column": "salary", "action": "remove_outliers", "params": {"threshold": 50}}] * 3
    run = run_plan(people, steps)
    plan = run.df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Subquery" not in plan
    assert log_rows(run)[-1][5] == 5


@pytest.mark.parametrize("snapshot", [False, True])
def test_versions(spark, snapshot):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "a bigint, b bigint")
    t = VersionedTable(df, snapshot=snapshot)
    assert t.version == 1
    t.apply("step1", lambda d: d.withColumn("a", F.col("a") * 10))
    t.apply("step2", lambda d: d.where("a > 10"))
    assert t.version == 3 and sorted(column(t.df, "a")) == [20, 30]
    history = t.history().orderBy("version").collect()
    assert [(r["label"], r["n_rows"], r["n_cols"]) for r in history] == [("initial", 3, 2), ("step1", 3, 2), ("step2", 2, 2)]
    assert column(t.diffs().orderBy("version"), "rows_delta") == [0, 0, -1]
    t.rollback()
    assert t.version == 2 and sorted(column(t.df, "a")) == [10, 20, 30]
    t.apply("other", lambda d: None)
    assert t.version == 3 and t.history().count() == 3
    t.rollback(10)
    assert t.version == 1 and sorted(column(t.df, "a")) == [1, 2, 3]
    assert t.rollback().version == 1
    assert t.load(df.limit(1), "again").version == 1 and t.df.count() == 1


def test_versions_need_a_table():
    t = VersionedTable()
    assert t.version == 0
    for call in (lambda: t.df, t.history, lambda: t.apply("x", lambda d: d)):
        with pytest.raises(ValueError):
            call()


def test_snapshots_end_lineage(spark):
    t = VersionedTable(spark.range(10).withColumn("x", F.col("id") * 2), snapshot=True)
    assert "Range" not in t.df._jdf.queryExecution().optimizedPlan().toString()


def test_filter_versions_are_one_scan(spark):
    df = spark.createDataFrame([(k, k % 7, None if k % 10 == 0 else float(k)) for k in range(100)], "k int, `__p` int, x double")
    t = VersionedTable(df)
    t.where("present", "x IS NOT NULL").change("filled", lambda d: clean.fill_change(d, "x", "zero"))
    t.where("big", F.col("x") > 50).apply("same", lambda d: None).where("unknown", "k > NULL")
    history = t.history()
    scans = history._jdf.queryExecution().executedPlan().toString().count("Scan")
    assert scans == 1
    assert [(r["version"], r["n_rows"]) for r in history.orderBy("version").collect()] == [(1, 100), (2, 90), (3, 90), (4, 45), (5, 45), (6, 0)]
    assert t.rollback(2).df.count() == 45 and t.version == 4
    assert column(t.diffs().orderBy("version"), "rows_delta") == [0, -10, 0, -45]
    t.apply("new", lambda d: d.limit(7)).where("again", "k % 2 = 0")
    rows = {r["version"]: r["n_rows"] for r in t.history().collect()}
    assert rows[4] == 45 and rows[5] == 7 and rows[6] == t.df.count()
