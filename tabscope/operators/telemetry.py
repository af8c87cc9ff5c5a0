"""Roll-ups over run metadata: spans, progress, token cost, errors and quality scores.

Spans carry ``trace_id, seq, node_name, start_time, end_time, duration_ms, status, error``
(times in epoch seconds; ``seq`` is the position of the span in its trace).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import choice, clamp, ratio, require
from tabscope.functions.order import lagged
from tabscope.functions.stats import spread_join

# --- fixed values -------------------------------------------------------------------------

# weight of each stage in the progress bar, in percent
STAGE_WEIGHTS = {
    "upload": 5,
    "scout": 15,
    "health_check": 2,
    "cleaner_plan": 15,
    "human_review": 2,
    "cleaner_execute": 10,
    "analyst": 20,
    "visualizer": 15,
    "reporter": 15,
    "done": 1,
}
# stages that leave a span, in running order
SPAN_STAGES = ("scout", "cleaner_plan", "cleaner_execute", "analyst", "visualizer", "reporter")
PROGRESS_CAP = 95
# nodes whose spans complete the stage of the same name
COUNTED_NODES = ("scout", "cleaner_plan", "human_review", "cleaner_execute", "analyst", "visualizer", "reporter")

# dollars per 1000 tokens: model -> (input, output)
PRICES = {
    "qwen-max": (0.002, 0.006),
    "qwen-plus": (0.0004, 0.0012),
    "qwen-turbo": (0.0002, 0.0006),
    "gpt-4o": (0.0025, 0.01),
    "gpt-4o-mini": (0.00015, 0.0006),
    "gpt-3.5-turbo": (0.0005, 0.0015),
}
DEFAULT_PRICE = (0.002, 0.006)

FATAL_AGENTS = ("scout",)
DEGRADABLE_AGENTS = ("cleaner_execute", "visualizer")
MAX_DEGRADED = 3

QUALITY_THRESHOLD = 0.6
MAX_ITERATIONS = 2

MIN_BAR_PCT = 0.5

# ------------------------------------------------------------------------------------------


_SUMMARY = (
    "total_spans",
    "successful_spans",
    "failed_spans",
    "total_agent_time_ms",
    "avg_span_duration_ms",
    "slowest_node",
    "fastest_node",
)


def traces(spans: DataFrame) -> DataFrame:
    """One row per trace: its summary, and start, end and length as far as its spans tell.

    Ties for the slowest and fastest node go to the earlier span. Everything is an aggregate
    that combines before the shuffle, so a trace of any length reaches the reducer as one
    row per task.
    """
    latest_first = F.struct("duration_ms", (-F.col("seq")).alias("r"), "node_name")
    earliest_first = F.struct("duration_ms", F.col("seq").alias("r"), "node_name")
    return spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("total_spans"),
        F.count_if(F.col("status") == "success").alias("successful_spans"),
        F.count_if(F.col("status") == "error").alias("failed_spans"),
        F.round(F.sum("duration_ms"), 2).alias("total_agent_time_ms"),
        F.round(F.avg("duration_ms"), 2).alias("avg_span_duration_ms"),
        F.max(latest_first)["node_name"].alias("slowest_node"),
        F.min(earliest_first)["node_name"].alias("fastest_node"),
        F.min("start_time").alias("trace_start"),
        F.max("end_time").alias("trace_end"),
    ).withColumn("total_duration_ms", (F.col("trace_end") - F.col("trace_start")) * 1000)


def trace_summary(spans: DataFrame) -> DataFrame:
    """Span counts, durations and the slowest and fastest node per trace."""
    return traces(spans).select("trace_id", *_SUMMARY)


def node_durations(spans: DataFrame) -> DataFrame:
    """Duration of each node; of a repeated node the last span counts."""
    return spans.groupBy("trace_id", "node_name").agg(
        F.round(F.max_by("duration_ms", "seq"), 2).alias("duration_ms")
    )


def trace_bounds(spans: DataFrame) -> DataFrame:
    """Start, end and length of each trace."""
    return traces(spans).select("trace_id", "trace_start", "trace_end", "total_duration_ms")


def timeline(spans: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Offset, left edge and width of every span's bar, in percent of its trace.

    ``bounds`` holds ``trace_id, trace_start, total_duration_ms`` and may hold ``total_spans``, by
    which a long trace is spread; without it spans are counted. Traces without length have no bars.
    """
    if bounds is None:
        bounds = traces(spans)
    size = "total_spans" if "total_spans" in bounds.columns else None
    known = ["trace_id", "trace_start", "total_duration_ms", *([size] if size else [])]
    total = F.col("total_duration_ms")
    offset = (F.col("start_time") - F.col("trace_start")) * 1000
    # traces without length are left out last, for a long one of them has to be spread as well
    met = spread_join(spans, bounds.select(*known), ["trace_id"], ["seq"], rows=size)
    return met.where("total_duration_ms > 0").select(
        "trace_id",
        "seq",
        "node_name",
        "status",
        offset.alias("offset_ms"),
        (F.try_divide(offset, total) * 100).alias("left_pct"),
        F.greatest(F.try_divide(F.col("duration_ms"), total) * 100, F.lit(MIN_BAR_PCT)).alias(
            "width_pct"
        ),
    )


def failed_spans(spans: DataFrame) -> DataFrame:
    return spans.where(F.col("status") == "error").select("trace_id", "seq", "node_name", "error")


def stage_progress(
    spans: DataFrame,
    weights: Mapping[str, int] = STAGE_WEIGHTS,
    order: Sequence[str] = SPAN_STAGES,
    by: Sequence[str] = ("trace_id",),
    counted: Sequence[str] | None = None,
) -> DataFrame:
    """``trace_id, progress, current_stage`` from the spans completed so far.

    counted: the nodes that complete a stage, by default COUNTED_NODES, or every node with a
    weight where other weights are given.

    Distinct completed stages are kept as one bit each, so a run's state is a single number
    that combines before the shuffle; the same aggregate runs on a stream in update mode.
    The stage after the last completed one is current; the final stage stays current, and a
    node outside the order is current itself.
    """
    if counted is None:
        counted = COUNTED_NODES if weights is STAGE_WEIGHTS else list(weights)
    stages = [s for s in weights if weights[s] and s in counted]
    if len(stages) > 62:
        raise ValueError("at most 62 stages")
    bit = F.lit(0).cast("bigint")
    for i, stage in enumerate(stages):
        bit = F.when(F.col("node_name") == stage, F.lit(1 << i).cast("bigint")).otherwise(bit)
    state = spans.groupBy(*by).agg(
        F.bit_or(bit).alias("_done"), F.max_by("node_name", "seq").alias("_last")
    )
    gained = F.lit(0)
    for i, stage in enumerate(stages):
        done = F.col("_done").bitwiseAND(F.lit(1 << i)) != 0
        gained = gained + F.when(done, weights[stage]).otherwise(0)
    current = F.col("_last")
    for this, following in zip(order, [*order[1:], order[-1]]):
        current = F.when(F.col("_last") == this, following).otherwise(current)
    names = [b if isinstance(b, str) else "window" for b in by]
    return state.select(
        *names, F.least(gained, F.lit(PROGRESS_CAP)).alias("progress"), current.alias("current_stage")
    )


# --- tokens -------------------------------------------------------------------------------


def usage_tokens(responses: DataFrame, response: str = "response") -> DataFrame:
    """Prompt and completion tokens out of each response's JSON; rows without usage go.

    Looked up in this order: a filled ``usage_metadata``, a filled ``token_usage`` or
    ``usage`` inside ``response_metadata``, then a bare ``usage_metadata`` or ``usage``.
    A bare ``usage_metadata`` that is present counts even if it is null: nothing is recorded then.
    Within it the input/output names win over prompt/completion unless zero or absent.
    """
    counts = "map<string,string>"
    shape = (
        f"usage_metadata {counts}, usage {counts}, "
        f"response_metadata struct<token_usage: {counts}, usage: {counts}>"
    )
    parsed = responses.withColumn("_r", F.from_json(F.col(response), shape))

    def filled(path: str) -> Column:
        return F.when(F.size(path) > 0, F.col(path))

    found = F.coalesce(
        filled("_r.usage_metadata"),
        filled("_r.response_metadata.token_usage"),
        filled("_r.response_metadata.usage"),
        F.col("_r.usage_metadata"),
        F.when(~F.array_contains(F.json_object_keys(F.col(response)), "usage_metadata"), F.col("_r.usage")),
    )

    def tokens(*names: str) -> Column:
        reads = [F.nullif(F.col("_u")[n].try_cast("bigint"), F.lit(0)) for n in names]
        return F.coalesce(*reads, F.lit(0).cast("bigint"))

    return (
        parsed.withColumn("_u", found)
        .where("_u is not null")
        .withColumn("prompt_tokens", tokens("input_tokens", "prompt_tokens"))
        .withColumn("completion_tokens", tokens("output_tokens", "completion_tokens"))
        .drop("_r", "_u")
    )


def with_cost(
    usage: DataFrame,
    prices: Mapping[str, tuple[float, float]] = PRICES,
    default: tuple[float, float] = DEFAULT_PRICE,
) -> DataFrame:
    """Adds ``cost_usd`` by model; unknown models pay the default price."""
    require(usage, "model", "prompt_tokens", "completion_tokens")
    rate_in, rate_out = F.lit(float(default[0])), F.lit(float(default[1]))
    for model, (price_in, price_out) in prices.items():
        same = F.col("model") == model
        rate_in = F.when(same, float(price_in)).otherwise(rate_in)
        rate_out = F.when(same, float(price_out)).otherwise(rate_out)
    return usage.withColumn(
        "cost_usd",
        F.col("prompt_tokens") / 1000 * rate_in + F.col("completion_tokens") / 1000 * rate_out,
    )


def token_usage(usage: DataFrame, prices: Mapping[str, tuple[float, float]] = PRICES) -> DataFrame:
    """Usage per agent plus a ``total`` row; the total is rolled up from the agents' rows."""
    costed = usage if "cost_usd" in usage.columns else with_cost(usage, prices)
    sums = ("prompt_tokens", "completion_tokens", "estimated_cost_usd", "call_count")
    per_agent = costed.groupBy("agent").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("cost_usd").alias("estimated_cost_usd"),
        F.count(F.lit(1)).alias("call_count"),
    )
    rolled = per_agent.rollup("agent").agg(
        F.grouping("agent").alias("_is_total"), *[F.sum(c).alias(c) for c in sums]
    )
    return rolled.select(
        F.when(F.col("_is_total") == 1, "total").otherwise(F.col("agent")).alias("agent"),
        "prompt_tokens",
        "completion_tokens",
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        F.round("estimated_cost_usd", 6).alias("estimated_cost_usd"),
        "call_count",
    )


# --- errors -------------------------------------------------------------------------------

_ERROR_LINE = r"(?s)^\[([^\]]*)\].?(.*)$"


def parse_errors(lines: DataFrame, line: str = "line") -> DataFrame:
    """Splits "[agent] message" lines; others are ignored."""
    return (
        lines.where(F.col(line).rlike(_ERROR_LINE))
        .withColumn("agent_name", F.regexp_extract(line, _ERROR_LINE, 1))
        .withColumn("message", F.regexp_extract(line, _ERROR_LINE, 2))
    )


def classify_errors(
    errors: DataFrame, rule: str = "record", severities: Mapping[str, str] | None = None
) -> DataFrame:
    """Adds ``error_type, severity, recoverable``.

    ``record``: fatal, degraded or warning by agent. ``graph``: fatal or degraded.
    ``severities`` (agent -> severity, everything else a warning) replaces both.
    """
    agent = F.col("agent_name")
    rule = choice(rule, ("record", "graph"), "rule")
    if severities is not None:
        severity = F.lit("warning")
        for name, level in severities.items():
            severity = F.when(agent == name, level).otherwise(severity)
    else:
        rest = F.lit("degraded")
        if rule == "record":
            rest = F.when(agent.isin(*DEGRADABLE_AGENTS), "degraded").otherwise("warning")
        severity = F.when(agent.isin(*FATAL_AGENTS), "fatal").otherwise(rest)
    kind = F.col("error_type") if "error_type" in errors.columns else F.lit("runtime_error")
    return (
        errors.withColumn("error_type", kind)
        .withColumn("severity", severity)
        .withColumn("recoverable", F.col("severity") != "fatal")
    )


def _with_clean_runs(
    per_run: DataFrame, runs: DataFrame | None, run: str, n_errors: str = "n_errors"
) -> DataFrame:
    """Adds the runs that reported no error at all."""
    if runs is None:
        return per_run
    joined = runs.select(run).distinct().join(per_run, run, "left")
    return joined.withColumn(n_errors, F.coalesce(n_errors, F.lit(0)))


def run_health(
    errors: DataFrame, runs: DataFrame | None = None, run: str = "run_id"
) -> DataFrame:
    """``run_id, health``: healthy without errors, fatal with a fatal one, else degraded."""
    per_run = errors.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.count_if(F.col("severity") == "fatal").alias("n_fatal"),
    )
    return _with_clean_runs(per_run, runs, run).select(
        run,
        F.when(F.col("n_errors") == 0, "healthy")
        .when(F.col("n_fatal") > 0, "fatal")
        .otherwise("degraded")
        .alias("health"),
    )


def continue_decision(
    errors: DataFrame, runs: DataFrame | None = None, run: str = "run_id", seq: str = "seq"
) -> DataFrame:
    """``run_id, should_continue, reason``.

    Stops on any fatal error, naming the first by ``seq``, or on three degraded ones.
    """
    fatal = F.col("severity") == "fatal"
    per_run = errors.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.count_if(F.col("severity") == "degraded").alias("n_degraded"),
        F.min(F.when(fatal, F.struct(seq, "agent_name", "error_type", "message"))).alias("first"),
    )
    is_fatal = F.col("first").isNotNull()
    too_many = F.col("n_degraded") >= MAX_DEGRADED
    # the wording of the reason is a fixed format
    reason = (
        F.when(F.col("n_errors") == 0, "No errors.")
        .when(
            is_fatal,
            F.format_string(
                "Fatal error in '%s' (%s): %s", "first.agent_name", "first.error_type", "first.message"
            ),
        )
        .when(
            too_many,
            F.format_string(
                "Too many degraded errors (%d). Pipeline output quality would be unacceptable.",
                "n_degraded",
            ),
        )
        .otherwise(F.format_string("Continuing with %d non-fatal error(s).", "n_errors"))
    )
    return _with_clean_runs(per_run, runs, run).select(
        run,
        (~(is_fatal | F.coalesce(too_many, F.lit(False)))).alias("should_continue"),
        reason.alias("reason"),
    )


# --- quality gate -------------------------------------------------------------------------


def quality_gate(
    scores: DataFrame,
    run: str = "run_id",
    iteration: str = "iteration",
    score: str = "score",
    threshold: float = QUALITY_THRESHOLD,
    max_iterations: int = MAX_ITERATIONS,
) -> DataFrame:
    """``run, iteration, score, previous, decision`` for every scored iteration from 0 on.

    Passes when the score reaches the threshold, when the iteration limit is reached, or when
    the score did not improve on the last iteration recorded before; otherwise the run cleans
    again. Of a repeated iteration the lower score comes first. A run may hold any share of the
    rows: the row before is found in ranges of the order, which split it.
    """
    now = scores.select(F.col(run), F.col(iteration), F.col(score))
    now = lagged(now, [run], [iteration, score], score, "previous")
    decided = (
        (F.col(score) >= threshold)
        | (F.col(iteration) >= max_iterations)
        | F.coalesce(F.col(score) <= F.col("previous"), F.lit(False))
    )
    return now.select(
        run,
        iteration,
        score,
        "previous",
        F.when(decided, "quality_ok").otherwise("needs_reclean").alias("decision"),
    )


def execution_quality(n_errors: Column, failed: Column, total: Column) -> Column:
    """How cleanly a run went, in [0, 1]: a fifth off per error, times the unfailed share."""
    share = F.greatest(F.coalesce(total, F.lit(1)), F.lit(1))
    kept = clamp(F.lit(1.0) - ratio(F.coalesce(failed, F.lit(0)).cast("double"), share.cast("double")))
    return clamp(F.lit(1.0) - n_errors * F.lit(0.2)) * kept
