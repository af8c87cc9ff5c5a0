"""Rule-based scores for run artefacts, one artefact per row.

Every scorer adds ``agent_name, overall_score, grade, dimensions`` to the rows it is given.
Weighted sums are taken in the order the weights are listed, so results are bit-stable.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import clamp, ratio
from tabscope.functions.stats import spread_join
from tabscope.operators.telemetry import execution_quality

# --- fixed values -------------------------------------------------------------------------

GRADES = (("A", 0.9), ("B", 0.8), ("C", 0.7), ("D", 0.6))

PROFILE_WEIGHTS = {
    "field_coverage": 0.30,
    "quality_issues_found": 0.25,
    "numeric_stats_present": 0.25,
    "categorical_summary": 0.20,
}
PROFILE_FIELDS = (
    "basic_info", "column_details", "numeric_summary", "quality_issues", "categorical_summary",
)
PROFILE_OTHER_FIELDS = ("descriptive_stats", "missing_values", "categorical_distributions")
QUALITY_WORDS = ("missing", "缺失", "null", "质量", "quality")

PLAN_WEIGHTS = {
    "has_strategy": 0.25,
    "actions_valid": 0.25,
    "params_complete": 0.25,
    "addresses_issues": 0.25,
}
PLAN_ACTIONS = (
    "fill_missing", "remove_outliers", "normalize_column", "drop_duplicates", "convert_type",
)

ANALYSIS_WEIGHTS = {
    "has_summary": 0.20,
    "findings_count": 0.25,
    "evidence_quality": 0.30,
    "structure": 0.25,
}
ANALYSIS_FIELDS = ("summary", "findings", "statistics", "data_quality_note")
ANALYSIS_FAILED = "分析失败"
CONFIDENCES = ("high", "medium", "low")

CHART_WEIGHTS = {"chart_count": 0.30, "files_exist": 0.40, "type_diversity": 0.30}
CHART_TYPES = ("bar", "line", "scatter", "hist", "pie", "box")

REPORT_WEIGHTS = {
    "length_adequate": 0.20,
    "structure_complete": 0.30,
    "chart_references": 0.20,
    "data_richness": 0.30,
}
REPORT_FAILED = "# 报告生成失败"
REPORT_SECTIONS = ("概述", "数据概况", "数据清洗", "分析发现", "可视化", "结论")
REPORT_SECTIONS_EN = (
    "overview", "data overview", "cleaning", "analysis", "visualization", "conclusion",
)
# digits and "any character" as Python's re reads them
IMAGE_REFERENCE = r"!\[[^\n]*?\]\([^\n]*?\)"
REPORT_SIGNS = (
    r"\p{Nd}+\.?\p{Nd}*%",
    r"\|[^\n]*\|[^\n]*\|",
    r"\p{Nd}{4,}",
    r"(?:相关|平均|总计|占比|增长率|同比|环比)",
)
# a text without any of these has no match of the pattern at the same place above
REPORT_SIGN_TRACES = (("%",), ("|",), (), ("相关", "平均", "总计", "占比", "增长率", "同比", "环比"))

RUN_WEIGHTS = (0.7, 0.3)  # average score, execution

# advice where a score below 0.8 has a dimension under its cut: agent, dimension, cut
ADVICE_BELOW = 0.8
ADVICE_RULES = (
    ("scout", "field_coverage", 0.6),
    ("scout", "quality_issues_found", 0.5),
    ("cleaner", "has_strategy", 0.5),
    ("cleaner", "addresses_issues", 0.5),
    ("analyst", "findings_count", 0.5),
    ("analyst", "evidence_quality", 0.5),
    ("visualizer", "chart_count", 0.5),
    ("visualizer", "files_exist", 0.8),
    ("reporter", "structure_complete", 0.6),
    ("reporter", "data_richness", 0.5),
)

# ------------------------------------------------------------------------------------------

ADVICE = {
    "field_coverage": "ask for every expected profile field",
    "quality_issues_found": "detect missing values and outliers automatically",
    "has_strategy": "give the planner a fuller profile",
    "addresses_issues": "treat the columns with known issues first",
    "findings_count": "iterate again or widen the analysis",
    "evidence_quality": "back every finding with figures",
    "chart_count": "produce three to five charts",
    "files_exist": "check where charts are saved",
    "structure_complete": "name the report sections",
    "data_richness": "put concrete figures into the report",
}
ADVICE_NONE = "no change needed"


def grade(score: Column) -> Column:
    letter = F.lit("F")
    for name, cut in reversed(GRADES):
        letter = F.when(score >= cut, name).otherwise(letter)
    return letter


def _scored(
    df: DataFrame, agent: str, weights: Mapping[str, float], values: Mapping[str, Column], void: Column
) -> DataFrame:
    """Adds the score columns; ``void`` artefacts get zero everywhere."""
    kept = df.columns
    dims = df.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.when(void, 0.0).otherwise(values[d]).alias(f"_d_{d}") for d in weights],
    )
    total = reduce(
        lambda acc, d: acc + F.col(f"_d_{d}") * F.lit(weights[d]), weights, F.lit(0.0)
    )
    scored = dims.withColumn("_total", clamp(total))
    pairs = [x for d in weights for x in (F.lit(d), F.col(f"_d_{d}"))]
    return scored.select(
        *[F.col(f"`{c}`") for c in kept],
        F.lit(agent).alias("agent_name"),
        F.col("_total").alias("overall_score"),
        grade(F.col("_total")).alias("grade"),
        F.create_map(*pairs).alias("dimensions"),
    )


def _up_to(count: Column, full: int) -> Column:
    return F.least(count / F.lit(float(full)), F.lit(1.0))


def _count(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags], F.lit(0))


def _truthy(c: Column) -> Column:
    return F.coalesce(c.cast("string") != "", F.lit(False))


def _field(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def score_profiles(df: DataFrame) -> DataFrame:
    """Data profiles. A NULL column is a field the profile does not have.

    Columns, all optional: the five profile fields (``quality_issues`` an array, the others
    maps), the three alternative ones (``missing_values`` a map column -> null count) and
    ``error``.
    """
    named = [f for f in (*PROFILE_FIELDS, *PROFILE_OTHER_FIELDS) if f in df.columns]
    has = {f: F.col(f).isNotNull() for f in named}
    matched = _count([has[f] for f in named])

    def size(name: str) -> Column:
        return F.coalesce(F.size(F.col(name)), F.lit(0)) if name in named else F.lit(0)

    def filled(name: str) -> Column:
        return F.when(F.coalesce(size(name) > 0, F.lit(False)), size(name))

    issues = F.greatest(size("quality_issues"), F.lit(0))
    nulls = F.lit(0)
    if "missing_values" in named:
        nulls = F.coalesce(
            F.size(F.map_filter("missing_values", lambda k, v: F.coalesce(v > 0, F.lit(False)))), F.lit(0)
        )
        nulls = F.greatest(nulls, F.lit(0))
    text = F.to_json(F.struct(*[F.col(f) for f in named])) if named else F.lit("{}")
    text = F.replace(text, F.lit('":null'), F.lit('":'))  # an absent value is not a word
    mentions = reduce(lambda a, b: a | b, [text.contains(w) for w in QUALITY_WORDS])
    found = issues + nulls

    def summary(first: str, second: str) -> Column:
        n = F.coalesce(filled(first), filled(second))
        return F.when(n.isNotNull(), _up_to(n, 3)).otherwise(0.1)

    values = {
        "field_coverage": clamp(matched / F.lit(float(len(PROFILE_FIELDS)))),
        "quality_issues_found": F.when(found > 0, _up_to(found, 3)).otherwise(
            F.when(mentions, 0.5).otherwise(0.2)
        ),
        "numeric_stats_present": summary("numeric_summary", "descriptive_stats"),
        "categorical_summary": summary("categorical_summary", "categorical_distributions"),
    }
    void = (matched == 0) | _truthy(_field(df, "error"))
    return _scored(df, "scout", PROFILE_WEIGHTS, values, void)


def score_plans(df: DataFrame) -> DataFrame:
    """Cleaning plans: ``strategy ARRAY<STRUCT<column, action, params MAP, reason>>``.

    ``issue_columns ARRAY<STRING>`` are the columns the profile flags: empty if it flags none,
    NULL (or absent) if there is no profile. A NULL strategy is an empty plan.
    """
    steps = F.coalesce(F.col("strategy"), F.expr("filter(strategy, s -> false)"))
    n = F.size(steps)
    valid = F.size(F.filter(steps, lambda s: F.coalesce(s["action"].isin(*PLAN_ACTIONS), F.lit(False))))
    complete = F.size(
        F.filter(
            steps,
            lambda s: _truthy(s["column"])
            & _truthy(s["action"])
            & (F.coalesce(F.size(s["params"]) > 0, F.lit(False)) | _truthy(s["reason"])),
        )
    )
    issues = F.array_distinct(_field(df, "issue_columns").cast("array<string>"))
    cleaned = F.transform(steps, lambda s: F.coalesce(s["column"], F.lit("")))
    covered = F.size(F.array_intersect(cleaned, issues))
    values = {
        "has_strategy": _up_to(n, 3),
        "actions_valid": ratio(valid.cast("double"), n.cast("double")),
        "params_complete": ratio(complete.cast("double"), n.cast("double")),
        "addresses_issues": F.when(issues.isNull() | (n == 0), 0.5)
        .when(F.size(issues) == 0, 0.6)
        .otherwise(clamp(ratio(covered.cast("double"), F.size(issues).cast("double")))),
    }
    void = F.col("strategy").isNull() | _truthy(_field(df, "error"))
    return _scored(df, "cleaner", PLAN_WEIGHTS, values, void)


def score_analyses(df: DataFrame) -> DataFrame:
    """Analysis results; a NULL column is a key the result does not have.

    ``summary STRING, findings ARRAY<STRUCT<finding, evidence, confidence>>, statistics MAP,
    data_quality_note STRING``.
    """
    present = [F.col(f).isNotNull() for f in ANALYSIS_FIELDS if f in df.columns]
    length = F.coalesce(F.length("summary"), F.lit(0))
    findings = F.col("findings")
    n = F.coalesce(F.size(findings), F.lit(0))

    def strength(f: Column) -> Column:
        return (
            F.lit(0.0)
            + F.when(_truthy(f["finding"]), 0.3).otherwise(0.0)
            + F.when(F.coalesce(F.length(f["evidence"]) > 10, F.lit(False)), 0.4).otherwise(0.0)
            + F.when(f["confidence"].isin(*CONFIDENCES), 0.3).otherwise(0.0)
        )

    evidence = F.aggregate(findings, F.lit(0.0), lambda acc, f: acc + F.coalesce(strength(f), F.lit(0.0)))
    values = {
        "has_summary": F.when(length > 20, _up_to(length, 100)).when(length > 0, 0.4).otherwise(0.0),
        "findings_count": F.when(n > 0, _up_to(n, 4)).otherwise(0.1),
        "evidence_quality": F.when(n > 0, evidence / n.cast("double")).otherwise(0.0),
        "structure": clamp(_count(present) / F.lit(float(len(ANALYSIS_FIELDS)))),
    }
    failed = F.coalesce(F.col("summary").startswith(ANALYSIS_FAILED), F.lit(False))
    return _scored(df, "analyst", ANALYSIS_WEIGHTS, values, failed | (_count(present) == 0))


def score_charts(df: DataFrame, files: DataFrame | None, key: str = "id") -> DataFrame:
    """Chart lists ``charts ARRAY<STRING>`` against ``files (path)``, the charts on disk.

    Existence is an equi-join of the exploded paths with the listing, spread so that a path
    named in very many lists does not pile up, on disk or not; paths are matched as written.
    Without a listing nothing exists. Equal lists are looked up once, whatever ids they belong to;
    the rows of a list that very many share are dealt by ``key`` to meet what was found.
    """
    n = F.greatest(F.coalesce(F.size("charts"), F.lit(0)), F.lit(0))
    # file names have no slash and no kind has one, so one text of a list tells what its names hold
    names = F.array_join(F.transform("charts", lambda c: F.lower(F.substring_index(c, "/", -1))), "/")
    kinds = _count([F.coalesce(F.col("_names").contains(kind), F.lit(False)) for kind in CHART_TYPES])
    typed = df.withColumn("_names", names).withColumn("_types", kinds).drop("_names")
    if files is None:
        counted = typed.withColumn("_existing", F.lit(0))
    else:
        paths = df.select("charts").distinct().select("charts", F.explode("charts").alias("path"))
        there = spread_join(paths, files.select("path").distinct(), ["path"], ["charts"])
        per_list = there.groupBy("charts").agg(F.count(F.lit(1)).alias("_existing"))
        counted = spread_join(typed, per_list, ["charts"], [key if key in df.columns else "charts"], "left")
    types = F.col("_types")
    existing = F.coalesce("_existing", F.lit(0)).cast("double")
    values = {
        "chart_count": F.when(n.between(3, 5), 1.0).otherwise(clamp(n / F.lit(3.0))),
        "files_exist": ratio(existing, n.cast("double")),
        "type_diversity": F.when(types > 0, clamp(types / F.lit(3.0))).otherwise(0.3),
    }
    return _scored(counted, "visualizer", CHART_WEIGHTS, values, n == 0).drop("_types", "_existing")


def _matches(text: Column, pattern: str, traces: tuple[str, ...]) -> Column:
    """Number of matches; texts without any of the literal traces are not searched."""
    found = F.regexp_count(text, F.lit(pattern))
    if not traces:
        return found
    return F.when(reduce(lambda a, b: a | b, [text.contains(t) for t in traces]), found).otherwise(0)


def score_reports(df: DataFrame, report: str = "report", charts: str | None = None) -> DataFrame:
    """Markdown reports, the whole text of each; ``charts`` names their chart-list column."""
    # measured once per text, in a projection of their own, then weighed
    text, lower = F.col("_text"), F.col("_lower")
    texts = df.withColumn("_text", F.coalesce(F.col(report), F.lit("")))
    texts = texts.withColumn("_lower", F.lower(text))
    measures = {
        "_length": F.length(text),
        "_sections": _count([text.contains(s) for s in REPORT_SECTIONS]),
        "_english": _count([lower.contains(s) for s in REPORT_SECTIONS_EN]),
        "_images": _matches(text, IMAGE_REFERENCE, ("![",)),
        **{
            f"_sign{i}": _matches(text, p, t)
            for i, (p, t) in enumerate(zip(REPORT_SIGNS, REPORT_SIGN_TRACES))
        },
    }
    measured = texts.withColumns(measures)
    length, sections, images = F.col("_length"), F.col("_sections"), F.col("_images")
    found = F.when(sections < 3, sections + F.col("_english")).otherwise(sections)
    references = _up_to(images, 3)
    if charts is not None:
        listed = F.coalesce(F.size(charts), F.lit(0))
        references = F.when(
            listed > 0, clamp(ratio(images.cast("double"), listed.cast("double")))
        ).otherwise(references)
    signs = [_up_to(F.col(f"_sign{i}"), 5) for i in range(len(REPORT_SIGNS))]
    richness = reduce(lambda a, b: a + b, signs, F.lit(0.0)) / F.lit(float(len(signs)))
    values = {
        "length_adequate": F.when(length >= 2000, 1.0)
        .when(length >= 500, length / F.lit(2000.0))
        .otherwise(length / F.lit(500.0) * F.lit(0.5)),
        "structure_complete": clamp(found / F.lit(float(len(REPORT_SECTIONS)))),
        "chart_references": references,
        "data_richness": clamp(richness),
    }
    void = (text == "") | text.startswith(REPORT_FAILED)
    scored = _scored(measured, "reporter", REPORT_WEIGHTS, values, void)
    return scored.drop("_text", "_lower", *measures)


def score_runs(
    scores: DataFrame,
    errors: DataFrame | None = None,
    traces: DataFrame | None = None,
    runs: DataFrame | None = None,
    run: str = "run_id",
) -> DataFrame:
    """Whole runs: 0.7 of the average agent score plus 0.3 of the execution quality.

    ``scores (run, overall_score)``, ``errors`` one row per error, ``traces (run,
    failed_spans, total_spans, total_agent_time_ms)``, ``runs`` to list runs without scores.
    Each input is reduced to one row per run before the runs are joined.
    """
    per_run = scores.groupBy(run).agg(
        F.count(F.lit(1)).alias("agent_count"), F.avg("overall_score").alias("_avg")
    )
    if runs is not None:
        per_run = runs.select(run).distinct().join(per_run, run, "left")
    if errors is not None:
        n_errors = errors.groupBy(run).agg(F.count(F.lit(1)).alias("_errors"))
        per_run = per_run.join(n_errors, run, "left")
    else:
        per_run = per_run.withColumn("_errors", F.lit(0))
    spans = ("failed_spans", "total_spans", "total_agent_time_ms")
    if traces is not None:
        per_run = per_run.join(traces.select(run, *spans), run, "left")
    else:
        for name, kind in zip(spans, ("bigint", "bigint", "double")):
            per_run = per_run.withColumn(name, F.lit(None).cast(kind))
    n_errors = F.coalesce("_errors", F.lit(0)).cast("double")
    agents = F.coalesce("agent_count", F.lit(0))
    quality = execution_quality(n_errors, F.col("failed_spans"), F.col("total_spans"))
    score = F.when(agents == 0, 0.0).otherwise(
        F.lit(RUN_WEIGHTS[0]) * F.col("_avg") + F.lit(RUN_WEIGHTS[1]) * quality
    )
    return per_run.withColumn("_score", score).select(
        run,
        F.round("_score", 3).alias("run_score"),
        agents.alias("agent_count"),
        F.round(F.coalesce("_avg", F.lit(0.0)), 3).alias("avg_agent_score"),
        F.when(agents == 0, 1.0)
        .otherwise(F.round(ratio(n_errors, agents.cast("double")), 3))
        .alias("error_rate"),
        F.coalesce("total_agent_time_ms", F.lit(0.0)).alias("total_duration_ms"),
        grade(F.col("_score")).alias("grade"),
    )


def recommendations(scores: DataFrame, run: str = "run_id") -> DataFrame:
    """``run, agent_name, dimension, recommendation`` from the ten advice rules.

    The rules are a fixed handful and apply row by row, so nothing is joined. A run none of
    whose scores gives rise to advice gets one line saying so.
    """
    weak = {
        dimension: (F.col("overall_score") < ADVICE_BELOW)
        & (F.col("agent_name") == agent)
        & (F.coalesce(F.col("dimensions")[dimension], F.lit(1.0)) < cut)
        for agent, dimension, cut in ADVICE_RULES
    }
    lines = [
        F.when(
            fires,
            F.struct(F.lit(dimension).alias("dimension"), F.lit(ADVICE[dimension]).alias("recommendation")),
        )
        for dimension, fires in weak.items()
    ]
    given = scores.select(run, "agent_name", F.inline(F.array(*lines))).where("dimension is not null")
    any_weak = F.coalesce(reduce(lambda a, b: a | b, weak.values()), F.lit(False))
    content = (
        scores.groupBy(run)
        .agg(F.bool_or(any_weak).alias("_advised"))
        .where("not _advised")
        .select(
            run,
            F.lit(None).cast("string").alias("agent_name"),
            F.lit(None).cast("string").alias("dimension"),
            F.lit(ADVICE_NONE).alias("recommendation"),
        )
    )
    return given.unionByName(content)


def score_table(scores: DataFrame) -> DataFrame:
    """Scores for reading: percentages and the dimensions as one text, in name order."""

    def percent(share: Column, digits: int) -> Column:
        # sums that miss a half by float noise are put back on it before rounding
        return F.round(F.round(share * 100, 6), digits)

    names = F.array_sort(F.map_keys("dimensions"))
    shown = F.transform(
        names,
        lambda k: F.concat(
            k, F.lit(": "), percent(F.col("dimensions")[k], 0).cast("int").cast("string"), F.lit("%")
        ),
    )
    kept = [c for c in scores.columns if c not in ("overall_score", "dimensions", "grade")]
    return scores.select(
        *kept,
        percent(F.col("overall_score"), 1).alias("score_pct"),
        "grade",
        F.array_join(shown, ", ").alias("dimension_scores"),
    )
