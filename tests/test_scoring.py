import pytest
from pyspark.sql import functions as F

from tabscope.functions import stats
from tabscope.operators import scoring
from tests.conftest import keyed, most_in_a_partition, written

STEP = "strategy array<struct<column: string, action: string, params: map<string,string>, reason: string>>"
FINDING = "findings array<struct<finding: string, evidence: string, confidence: string>>"


def only(df):
    (row,) = df.collect()
    return row


def test_profile(spark):
    df = spark.sql(
        """SELECT map('rows', '5') AS basic_info, map('a', 'int') AS column_details,
        map('a', '1', 'b', '2') AS numeric_summary, array('a missing', 'b skewed') AS quality_issues,
        map('c', 'x') AS categorical_summary"""
    )
    row = only(scoring.score_profiles(df))
    assert row["overall_score"] == pytest.approx(0.70)
    assert row["dimensions"]["quality_issues_found"] == pytest.approx(2 / 3)
    assert row["agent_name"] == "scout"


@pytest.mark.parametrize(
    "sql, dims",
    [
        ("SELECT map('a', 1.0D) AS descriptive_stats, map('a', 2, 'b', 0) AS missing_values",
         (0.4, 1 / 3, 1 / 3, 0.1)),
        ("SELECT map('a', 0) AS missing_values", (0.2, 0.5, 0.1, 0.1)),
        ("SELECT map('a', 'b') AS basic_info", (0.2, 0.2, 0.1, 0.1)),
        ("SELECT map('a', 'no quality') AS basic_info", (0.2, 0.5, 0.1, 0.1)),
        ("SELECT map('a', string(NULL)) AS basic_info", (0.2, 0.2, 0.1, 0.1)),
        ("SELECT map('a', 'null') AS basic_info", (0.2, 0.5, 0.1, 0.1)),
        ("SELECT CAST(NULL AS map<string,string>) AS basic_info", (0, 0, 0, 0)),
        ("SELECT map('a', 'b') AS basic_info, 'failed' AS error", (0, 0, 0, 0)),
    ],
)
def test_profile_dimensions(spark, sql, dims):
    got = only(scoring.score_profiles(spark.sql(sql)))["dimensions"]
    assert [got[d] for d in scoring.PROFILE_WEIGHTS] == pytest.approx(list(dims))


def plan(spark, steps, issues="none"):
    rows = [(steps, issues if issues != "none" else None)]
    df = spark.createDataFrame(rows, f"{STEP}, issue_columns array<string>")
    return only(scoring.score_plans(df))


def test_plan(spark):
    good = [("a", "fill_missing", {"strategy": "mean"}, None), ("b", "remove_outliers", None, "spiky"),
            ("c", "normalize_column", {"method": "minmax"}, "scale")]
    assert plan(spark, good)["overall_score"] == pytest.approx(0.875)
    assert plan(spark, good, [])["dimensions"]["addresses_issues"] == 0.6
    assert plan(spark, good, ["a", "z", "a"])["dimensions"]["addresses_issues"] == 0.5
    odd = plan(spark, [("a", "explode", {}, "")])
    assert odd["dimensions"]["actions_valid"] == 0 and odd["dimensions"]["params_complete"] == 0
    assert plan(spark, [])["overall_score"] == pytest.approx(0.125)
    assert plan(spark, None)["overall_score"] == 0 and plan(spark, None)["grade"] == "F"


def analysis(spark, *values):
    df = spark.createDataFrame([values], f"summary string, {FINDING}, statistics map<string,string>, data_quality_note string")
    return only(scoring.score_analyses(df))


def test_analysis(spark):
    findings = [("one", "x" * 13, "high"), ("two", "y" * 16, "medium"), ("three", "z" * 6, "low")]
    row = analysis(spark, "s" * 34, findings, {"a": "1"}, "fine")
    assert row["overall_score"] == pytest.approx(0.7655)
    assert row["grade"] == "C"
    short = analysis(spark, "short", [], {}, None)["dimensions"]
    assert (short["has_summary"], short["findings_count"], short["evidence_quality"], short["structure"]) == (0.4, 0.1, 0.0, 0.75)
    assert analysis(spark, "分析失败: timeout", findings, None, None)["overall_score"] == 0
    assert analysis(spark, None, None, None, None)["overall_score"] == 0
    assert analysis(spark, None, [(None, None, None), None], None, None)["dimensions"]["evidence_quality"] == 0


def test_charts(spark):
    df = spark.createDataFrame(
        [(1, ["o/bar_a.png", "o/Line_b.png", "o/pie.png"]), (2, []), (3, None), (4, ["o/trend.png"]), (5, ["bar/x.png"] * 6)],
        "id int, charts array<string>")
    files = spark.createDataFrame([("o/bar_a.png",), ("o/Line_b.png",), ("o/pie.png",), ("o/pie.png",)], "path string")
    assert keyed(scoring.score_charts(df, None), "id", "overall_score")[1] == pytest.approx(0.6)
    scored = scoring.score_charts(df, files)
    assert keyed(scored, "id", "overall_score") == pytest.approx({1: 1.0, 2: 0, 3: 0, 4: 0.19, 5: 0.39})
    assert scored.columns == ["id", "charts", "agent_name", "overall_score", "grade", "dimensions"]
    assert keyed(scored, "id", "dimensions")[5] == {"chart_count": 1.0, "files_exist": 0.0, "type_diversity": 0.3}


def report(spark, text, charts=None):
    df = spark.createDataFrame([(text, charts)], "report string, charts array<string>")
    return only(scoring.score_reports(df, "report", "charts"))["dimensions"]


def test_report(spark):
    text = "# 概述\n## 数据概况\n## 数据清洗\n## 分析发现\n## 可视化\n## 结论\n" + "![a](a.png) ![b](b.png)\n"
    dims = report(spark, text, ["a.png", "b.png"])
    assert dims["structure_complete"] == 1.0 and dims["chart_references"] == 1.0
    assert dims["length_adequate"] == pytest.approx(len(text) / 500 * 0.5)
    assert report(spark, text)["chart_references"] == pytest.approx(2 / 3)
    rich = report(spark, "| a | b |\n" * 5 + "12.5% 3% 4.% " + "1234 " * 5 + "平均 同比 环比")
    assert rich["data_richness"] == pytest.approx((0.6 + 1 + 1 + 0.6) / 4)
    english = report(spark, "Overview, Data Overview, Cleaning, ANALYSIS")
    assert english["structure_complete"] == pytest.approx(4 / 6)
    assert report(spark, "x" * 2500)["length_adequate"] == 1.0
    assert report(spark, "x" * 1000)["length_adequate"] == 0.5
    for void in ("", None, "# 报告生成失败\n" + text):
        assert set(report(spark, void).values()) == {0.0}


def test_runs(spark):
    scores = spark.createDataFrame(
        [("good", s) for s in (0.85, 0.80, 0.75, 0.70, 0.80)] + [("bad", 0.3), ("bad", 0.0)], "run_id string, overall_score double")
    errors = spark.createDataFrame([("bad",), ("bad",), ("none",)], "run_id string")
    runs = spark.createDataFrame([("good",), ("bad",), ("none",)], "run_id string")
    rows = {r["run_id"]: r for r in scoring.score_runs(scores, errors, None, runs).collect()}
    assert (rows["good"]["run_score"], rows["good"]["grade"], rows["good"]["error_rate"]) == (0.846, "B", 0.0)
    assert (rows["bad"]["run_score"], rows["bad"]["grade"], rows["bad"]["error_rate"]) == (0.285, "F", 1.0)
    assert (rows["none"]["run_score"], rows["none"]["grade"], rows["none"]["error_rate"]) == (0.0, "F", 1.0)
    traces = spark.createDataFrame([("good", 1, 2, 30.0)], "run_id string, failed_spans bigint, total_spans bigint, total_agent_time_ms double")
    row = scoring.score_runs(scores, None, traces).where("run_id = 'good'").first()
    assert row["run_score"] == pytest.approx(0.7 * 0.78 + 0.3 * 0.5) and row["total_duration_ms"] == 30.0


def test_recommendations(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('r1', 'scout', 0.5D, map('field_coverage', 0.5D, 'quality_issues_found', 0.2D)),
        ('r1', 'visualizer', 0.7D, map('files_exist', 0.79D)), ('r2', 'scout', 0.8D, map('field_coverage', 0.0D)),
        ('r3', 'reporter', 0.1D, map('other', 0.0D)) AS t(run_id, agent_name, overall_score, dimensions)"""
    )
    got = sorted((r["run_id"], r["dimension"] or "") for r in scoring.recommendations(df).collect())
    assert got == [("r1", "field_coverage"), ("r1", "files_exist"), ("r1", "quality_issues_found"), ("r2", ""), ("r3", "")]


def test_grades_and_table(spark):
    df = spark.createDataFrame([(s,) for s in (0.95, 0.9, 0.89, 0.8, 0.7, 0.6, 0.59)], "s double")
    assert [r[0] for r in df.select(scoring.grade(df.s)).collect()] == list("AABBCDF")
    scored = spark.sql("SELECT 'a' AS id, 'scout' AS agent_name, 0.8461D AS overall_score, 'B' AS grade, map('y', 0.5D, 'x', 1.0D) AS dimensions")
    row = only(scoring.score_table(scored))
    assert (row["score_pct"], row["dimension_scores"]) == (84.6, "x: 100%, y: 50%")


def test_charts_of_repeated_ids(spark):
    lists = [("a", ["x/bar_1.png", "y.png"]), ("a", ["z.png"]), ("a", ["x/bar_1.png", "y.png"]), ("b", None)]
    df = spark.createDataFrame(lists, "id string, charts array<string>")
    files = spark.createDataFrame([("x/bar_1.png",), ("z.png",)], "path string")
    rows = scoring.score_charts(df, files).collect()
    assert len(rows) == 4
    assert sorted(r["dimensions"]["files_exist"] for r in rows) == [0.0, 0.5, 0.5, 1.0]


def test_a_path_that_all_lists_name_is_dealt_on_disk_or_not(spark, sixteen, monkeypatch, tmp_path):
    lists = spark.range(0, 16_000, 1, 4).selectExpr("id", "array(concat('o/bar_', id, '.png'), 'o/trend.png') AS charts")
    lists = written(lists, tmp_path / "lists")
    dealt = []

    def joined(facts, *args):
        dealt.append(stats.spread_join(facts, *args))
        return dealt[-1]

    monkeypatch.setattr(scoring, "spread_join", joined)
    for path, share in (("o/bar_7.png", 1 / 32_000), ("o/trend.png", 0.5)):
        dealt.clear()
        scored = scoring.score_charts(lists, spark.createDataFrame([(path,)], "path string"))
        assert scored.agg(F.avg(F.col("dimensions")["files_exist"])).first()[0] == pytest.approx(share)
        assert most_in_a_partition(dealt[0], "path") < 2000
        assert scored.groupBy(F.col("dimensions")["type_diversity"]).count().collect() == [(pytest.approx(1 / 3), 16_000)]
    facts, known = lists.selectExpr("id", "charts[1] AS path"), spark.createDataFrame([("o/none.png", 1)], "path string, n int")
    left = stats.spread_join(facts, known, ["path"], ["id"], "left")
    assert left.where("n IS NULL").count() == 16_000 and most_in_a_partition(left, "n") < 2000


@pytest.mark.parametrize("there", [True, False])
def test_a_list_that_many_rows_share_is_dealt(spark, sixteen, tmp_path, there):
    lists = spark.range(0, 16_000, 1, 4).selectExpr("id", "array('o/bar_1.png', string(NULL)) AS charts")
    lists = written(lists, tmp_path / "lists")
    files = spark.createDataFrame([("o/bar_1.png" if there else "o/x.png",)], "path string")
    scored = scoring.score_charts(lists, files)
    rows = scored.select("id", F.col("dimensions")["files_exist"].alias("s")).distinct()
    assert rows.where(F.col("s") == (0.5 if there else 0)).count() == 16_000
    assert most_in_a_partition(scored, F.col("dimensions")["files_exist"]) < 2000
