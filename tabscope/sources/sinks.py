"""Writing scores, spans and telemetry envelopes as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.sources.otlp import otlp_envelopes


def score_records(scores: DataFrame) -> DataFrame:
    """Scores as they are exported: rounded to three digits, one JSON text per row."""
    rounded = F.transform_values("dimensions", lambda k, v: F.round(v, 3))
    kept = [c for c in scores.columns if c not in ("overall_score", "dimensions")]
    shown = scores.select(
        *kept, F.round("overall_score", 3).alias("overall_score"), rounded.alias("dimensions")
    )
    return shown.select(F.to_json(F.struct(*shown.columns)).alias("value"))


def write_scores_json(scores: DataFrame, path: str) -> None:
    score_records(scores).write.mode("overwrite").text(path)


def write_evaluation_json(
    scores: DataFrame, run_scores: DataFrame, recommendations: DataFrame, path: str
) -> None:
    """A whole evaluation: ``scores``, ``runs`` and ``recommendations`` below ``path``."""
    write_scores_json(scores, f"{path}/scores")
    run_scores.write.mode("overwrite").json(f"{path}/runs")
    recommendations.write.mode("overwrite").json(f"{path}/recommendations")


def span_records(spans: DataFrame) -> DataFrame:
    """Spans as they are exported, with the trace id kept apart for partitioned writing."""
    fields = [
        F.round("duration_ms", 2).alias(c) if c == "duration_ms" else F.col(c)
        for c in spans.columns
        if c != "trace_id"
    ]
    return spans.select("trace_id", F.to_json(F.struct(*fields)).alias("value"))


def write_spans_json(spans: DataFrame, path: str) -> None:
    """Plain JSON lines; a trace is found by filtering, not by one folder per trace."""
    rounded = spans.withColumn("duration_ms", F.round("duration_ms", 2))
    rounded.write.mode("overwrite").json(path)


def write_summaries_json(summaries: DataFrame, path: str) -> None:
    summaries.write.mode("overwrite").json(path)


def write_otlp(spans: DataFrame, path: str, service: str = "tabscope") -> None:
    """One envelope per line."""
    otlp_envelopes(spans, service).select("payload").write.mode("overwrite").text(path)
