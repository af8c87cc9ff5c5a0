"""Run telemetry, exports, scores and JSON in text."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import SPANS, query, rounded, spans, table
from tabscope.operators import extract, scoring, telemetry
from tabscope.session import shared_dir
from tabscope.sources import otlp, sinks
from tabscope.streaming import progress

# --- spans --------------------------------------------------------------------------------

SUMMARY = f"""{SPANS}, first_slow AS (SELECT trace_id, node_name,
      row_number() OVER (PARTITION BY trace_id ORDER BY duration_ms DESC, seq) AS r FROM spans),
    first_fast AS (SELECT trace_id, node_name,
      row_number() OVER (PARTITION BY trace_id ORDER BY duration_ms, seq) AS r FROM spans),
    summary AS (SELECT s.trace_id, count(*) AS total_spans,
      count(*) FILTER (status = 'success') AS successful_spans,
      count(*) FILTER (status = 'error') AS failed_spans,
      round(sum(duration_ms), 2) AS total_agent_time_ms,
      round(avg(duration_ms), 2) AS avg_span_duration_ms,
      any_value(a.node_name) AS slowest_node, any_value(b.node_name) AS fastest_node
    FROM spans s JOIN first_slow a ON a.trace_id = s.trace_id AND a.r = 1
    JOIN first_fast b ON b.trace_id = s.trace_id AND b.r = 1 GROUP BY s.trace_id)"""


@query("tel1_trace_summary", f"WITH {SUMMARY} SELECT * FROM summary")
def tel1(spark, sf_dir):
    return telemetry.trace_summary(spans(spark, sf_dir))


@query(
    "tel2_node_durations",
    f"""WITH {SPANS} SELECT trace_id, node_name, round(arg_max(duration_ms, seq), 2) AS duration_ms
    FROM spans GROUP BY trace_id, node_name""",
)
def tel2(spark, sf_dir):
    return telemetry.node_durations(spans(spark, sf_dir))


@query(
    "tel3_timeline",
    f"""WITH {SPANS}, b AS (SELECT trace_id, min(start_time) AS t0,
      (max(end_time) - min(start_time)) * 1000 AS total FROM spans GROUP BY trace_id)
    SELECT s.trace_id, seq, node_name, status, round((start_time - t0) * 1000, 3) AS offset_ms,
      round((start_time - t0) * 1000 / total * 100, 6) AS left_pct,
      round(greatest(duration_ms / total * 100, 0.5), 6) AS width_pct
    FROM spans s JOIN b ON b.trace_id = s.trace_id WHERE total > 0""",
)
def tel3(spark, sf_dir):
    bars = telemetry.timeline(spans(spark, sf_dir))
    return rounded(rounded(bars, 3, "offset_ms"), 6, "left_pct", "width_pct")


@query(
    "tel4_failed_spans",
    f"WITH {SPANS} SELECT trace_id, seq, node_name, error FROM spans WHERE status = 'error'",
)
def tel4(spark, sf_dir):
    return telemetry.failed_spans(spans(spark, sf_dir))


WEIGHTS = {"view": 30, "click": 25, "signup": 20, "purchase": 20, "error": 5}
ORDER = ("view", "click", "signup", "purchase")
# spans of one user and hour make one run, so that runs stand at different stages
RUNS = "concat(trace_id, '-', CAST(floor(start_time / 3600) AS BIGINT))"
PROGRESS_SQL = f"""WITH {SPANS}, r AS (SELECT {RUNS} AS trace_id, seq, node_name FROM spans),
    done AS (SELECT DISTINCT trace_id, node_name FROM r),
    gained AS (SELECT trace_id, least(sum(CASE node_name WHEN 'view' THEN 30 WHEN 'click' THEN 25
      WHEN 'signup' THEN 20 WHEN 'purchase' THEN 20 ELSE 5 END), 95)::INTEGER AS progress
      FROM done GROUP BY trace_id),
    last AS (SELECT trace_id, arg_max(node_name, seq) AS node_name FROM r GROUP BY trace_id)
    SELECT trace_id, progress, CASE node_name WHEN 'view' THEN 'click' WHEN 'click' THEN 'signup'
      WHEN 'signup' THEN 'purchase' WHEN 'purchase' THEN 'purchase' ELSE node_name END AS current_stage
    FROM gained JOIN last USING (trace_id)"""


def runs_by_hour(df):
    return df.withColumn("trace_id", F.expr(RUNS))


@query("tel5_stage_progress", PROGRESS_SQL)
def tel5(spark, sf_dir):
    return telemetry.stage_progress(runs_by_hour(spans(spark, sf_dir)), WEIGHTS, ORDER)


@query("tel5_stage_progress_stream", PROGRESS_SQL)
def tel5_stream(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    arriving = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    live = runs_by_hour(arriving.selectExpr(*SPAN_COLUMNS))
    folder = shared_dir(spark, "progress")
    stream = progress.write_progress(
        progress.stage_progress_stream(live, WEIGHTS, ORDER, keep_all=True), f"{folder}/out", f"{folder}/state"
    )
    stream.awaitTermination()
    return progress.latest_progress(spark.read.parquet(f"{folder}/out"))


# a user's spans are one run, over months, whose state a timer ends
@query("tel5_stage_progress_timed", PROGRESS_SQL.replace(RUNS, "trace_id"))
def tel5_timed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    arriving = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    live = arriving.selectExpr(*SPAN_COLUMNS, "ts")
    folder = shared_dir(spark, "progress")
    timed = progress.stage_progress_stream(live, WEIGHTS, ORDER, event_time="ts", quiet="30 days")
    progress.write_progress(timed, f"{folder}/out", f"{folder}/state").awaitTermination()
    return progress.latest_progress(spark.read.parquet(f"{folder}/out"))


# the default weights, over spans of nodes that count and of nodes that do not
DEFAULT_NODES = """CASE node_name WHEN 'view' THEN 'upload' WHEN 'click' THEN 'scout' WHEN 'signup' THEN 'human_review'
    WHEN 'purchase' THEN 'cleaner_execute' ELSE 'done' END"""


@query(
    "tel5_stage_progress_default",
    f"""WITH {SPANS}, r AS (SELECT {RUNS} AS trace_id, seq, {DEFAULT_NODES} AS node_name FROM spans),
    done AS (SELECT DISTINCT trace_id, node_name FROM r),
    gained AS (SELECT trace_id, least(sum(CASE node_name WHEN 'scout' THEN 15 WHEN 'human_review' THEN 2
      WHEN 'cleaner_execute' THEN 10 ELSE 0 END), 95)::INTEGER AS progress FROM done GROUP BY trace_id),
    last AS (SELECT trace_id, arg_max(node_name, seq) AS node_name FROM r GROUP BY trace_id)
    SELECT trace_id, progress, CASE node_name WHEN 'scout' THEN 'cleaner_plan' WHEN 'cleaner_execute'
      THEN 'analyst' ELSE node_name END AS current_stage FROM gained JOIN last USING (trace_id)""",
)
def tel5_default(spark, sf_dir):
    named = spans(spark, sf_dir).withColumn("node_name", F.expr(DEFAULT_NODES))
    return telemetry.stage_progress(runs_by_hour(named))


SPAN_COLUMNS = [
    "user_id AS trace_id",
    "event_id AS seq",
    "event_type AS node_name",
    "(datediff(date(ts), date'1970-01-01') * 86400D + hour(ts) * 3600) AS start_time",
]


# --- tokens -------------------------------------------------------------------------------

CALLS_COLUMNS = """conv_id, turn, role AS agent, length(text) AS prompt_tokens, turn AS completion_tokens,
    CASE turn WHEN 0 THEN 'qwen-max' WHEN 1 THEN 'qwen-plus' WHEN 2 THEN 'qwen-turbo' WHEN 3 THEN 'gpt-4o'
      WHEN 4 THEN 'gpt-4o-mini' WHEN 5 THEN 'gpt-3.5-turbo' ELSE 'some-other-model' END AS model"""
PRICED = f"""calls AS (SELECT {CALLS_COLUMNS} FROM conversations),
    prices(model, price_in, price_out) AS (VALUES ('qwen-max', 0.002::DOUBLE, 0.006::DOUBLE),
      ('qwen-plus', 0.0004, 0.0012), ('qwen-turbo', 0.0002, 0.0006), ('gpt-4o', 0.0025, 0.01),
      ('gpt-4o-mini', 0.00015, 0.0006), ('gpt-3.5-turbo', 0.0005, 0.0015)),
    priced AS (SELECT calls.*, prompt_tokens / 1000 * coalesce(price_in, 0.002::DOUBLE)
      + completion_tokens / 1000 * coalesce(price_out, 0.006::DOUBLE) AS cost_usd
      FROM calls LEFT JOIN prices USING (model))"""


def calls(spark, sf_dir):
    table(spark, sf_dir, "conversations").createOrReplaceTempView("calls_source")
    return spark.sql(f"SELECT {CALLS_COLUMNS} FROM calls_source")


@query(
    "tel6_token_usage",
    f"""WITH {PRICED} SELECT coalesce(agent, 'total') AS agent, sum(prompt_tokens)::BIGINT AS prompt_tokens,
      sum(completion_tokens)::BIGINT AS completion_tokens,
      sum(prompt_tokens + completion_tokens)::BIGINT AS total_tokens,
      round(sum(cost_usd), 6) AS estimated_cost_usd, count(*) AS call_count
    FROM priced GROUP BY ROLLUP (agent)""",
)
def tel6(spark, sf_dir):
    return telemetry.token_usage(calls(spark, sf_dir))


@query("tel7_cost", f"WITH {PRICED} SELECT conv_id, turn, model, round(cost_usd, 9) AS cost_usd FROM priced")
def tel7(spark, sf_dir):
    done = telemetry.with_cost(calls(spark, sf_dir))
    return rounded(done.select("conv_id", "turn", "model", "cost_usd"), 9, "cost_usd")


@query(
    "tel8_usage_fields",
    """SELECT conv_id, turn, length(text) AS prompt_tokens, turn AS completion_tokens
    FROM conversations WHERE role <> 'system'""",
)
def tel8(spark, sf_dir):
    answers = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """CASE role WHEN 'user' THEN concat('{"usage_metadata": {"input_tokens": ', length(text),
             ', "output_tokens": 0, "completion_tokens": ', turn, '}}')
           WHEN 'assistant' THEN concat('{"usage_metadata": {}, "response_metadata": {"token_usage": ',
             '{"prompt_tokens": ', length(text), ', "completion_tokens": ', turn, '}}}')
           ELSE '{"content": "no usage here"}' END AS response""",
    )
    return telemetry.usage_tokens(answers).drop("response")


# --- errors and gates ---------------------------------------------------------------------

LINES_COLUMNS = """concat(user_id, '-', CAST(ts AS DATE)) AS run_id, event_id AS seq,
    CASE WHEN event_type = 'view' THEN props ELSE concat('[', event_type, '] ', props) END AS line"""
SEVERITIES = {"error": "fatal", "purchase": "degraded", "signup": "degraded", "click": "degraded"}
ERRORS = f"""lines AS (SELECT {LINES_COLUMNS} FROM events),
    parsed AS (SELECT run_id, seq, regexp_extract(line, '^\\[([^\\]]*)\\]', 1) AS agent_name,
      substr(line, strpos(line, ']') + 2) AS message FROM lines WHERE starts_with(line, '[')),
    errors AS (SELECT *, CASE agent_name WHEN 'error' THEN 'fatal' ELSE 'degraded' END AS severity FROM parsed),
    runs AS (SELECT DISTINCT run_id FROM lines)"""


def error_lines(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("lines_source")
    return spark.sql(f"SELECT {LINES_COLUMNS} FROM lines_source")


def errors(spark, sf_dir):
    return telemetry.classify_errors(
        telemetry.parse_errors(error_lines(spark, sf_dir)), severities=SEVERITIES
    )


@query("tel9_parse_errors", f"WITH {ERRORS} SELECT run_id, seq, agent_name, message FROM parsed")
def tel9(spark, sf_dir):
    return telemetry.parse_errors(error_lines(spark, sf_dir)).drop("line")


# event types stand in for stages, so that the built-in rules have something to tell apart
STAGED = {"error": "scout", "purchase": "visualizer", "signup": "cleaner_execute"}


def _severity(rule: str) -> None:
    other = "warning" if rule == "record" else "degraded"

    @query(
        f"tel10_severity_{rule}",
        f"""WITH {ERRORS} SELECT run_id, seq, CASE WHEN agent_name = 'error' THEN 'fatal'
        WHEN agent_name IN ('purchase', 'signup') THEN 'degraded' ELSE '{other}' END AS severity,
        agent_name <> 'error' AS recoverable FROM parsed""",
    )
    def run(spark, sf_dir):
        parsed = telemetry.parse_errors(error_lines(spark, sf_dir))
        named = parsed.replace(STAGED, subset=["agent_name"])
        done = telemetry.classify_errors(named, rule=rule)
        return done.select("run_id", "seq", "severity", "recoverable")


_severity("record")
_severity("graph")


@query(
    "tel11_run_health",
    f"""WITH {ERRORS} SELECT run_id, CASE WHEN count(severity) = 0 THEN 'healthy'
      WHEN count(*) FILTER (severity = 'fatal') > 0 THEN 'fatal' ELSE 'degraded' END AS health
    FROM runs LEFT JOIN errors USING (run_id) GROUP BY run_id""",
)
def tel11(spark, sf_dir):
    return telemetry.run_health(errors(spark, sf_dir), error_lines(spark, sf_dir))


@query(
    "tel12_continue_decision",
    f"""WITH {ERRORS}, c AS (SELECT run_id, count(severity) AS n, count(*) FILTER (severity = 'degraded') AS d,
      arg_min(agent_name, seq) FILTER (severity = 'fatal') AS agent,
      arg_min(message, seq) FILTER (severity = 'fatal') AS message
      FROM runs LEFT JOIN errors USING (run_id) GROUP BY run_id)
    SELECT run_id, agent IS NULL AND d < 3 AS should_continue, CASE WHEN n = 0 THEN 'No errors.'
      WHEN agent IS NOT NULL THEN concat('Fatal error in ''', agent, ''' (runtime_error): ', message)
      WHEN d >= 3 THEN concat('Too many degraded errors (', d,
        '). Pipeline output quality would be unacceptable.')
      ELSE concat('Continuing with ', n, ' non-fatal error(s).') END AS reason FROM c""",
)
def tel12(spark, sf_dir):
    return telemetry.continue_decision(errors(spark, sf_dir), error_lines(spark, sf_dir))


@query(
    "tel13_quality_gate",
    """WITH s AS (SELECT conv_id, 2 * turn AS turn, least(length(text)::DOUBLE / 1000::DOUBLE, 1) AS score FROM conversations),
    p AS (SELECT *, lag(score) OVER (PARTITION BY conv_id ORDER BY turn, score) AS previous FROM s)
    SELECT conv_id, turn, score, previous, CASE WHEN score >= 0.6 OR turn >= 9 OR score <= previous
      THEN 'quality_ok' ELSE 'needs_reclean' END AS decision FROM p""",
)
def tel13(spark, sf_dir):
    scores = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "2 * turn AS turn", "least(length(text) / 1000D, 1D) AS score"  # iterations with gaps
    )
    return telemetry.quality_gate(scores, "conv_id", "turn", "score", max_iterations=9)


# --- exports ------------------------------------------------------------------------------


@query(
    "snk2_span_records",
    f"""WITH {SPANS} SELECT trace_id, seq, node_name, status, error, round(duration_ms, 2) AS duration_ms
    FROM spans""",
)
def snk2(spark, sf_dir):
    written = sinks.span_records(spans(spark, sf_dir))
    fields = "seq bigint, node_name string, status string, error string, duration_ms double"
    return written.select("trace_id", F.from_json("value", fields).alias("s")).select("trace_id", "s.*")


@query(
    "snk3_otlp_spans",
    f"""WITH {SPANS} SELECT trace_id::VARCHAR AS "traceId",
      substr(md5(concat(trace_id, ':', seq)), 1, 16) AS "spanId", concat('tabscope.', node_name) AS name,
      CAST(start_time * 1000000000::DOUBLE AS BIGINT) AS "startTimeUnixNano",
      CAST(end_time * 1000000000::DOUBLE AS BIGINT) AS "endTimeUnixNano",
      CASE WHEN status = 'success' THEN 'OK' ELSE 'ERROR' END AS code, coalesce(error, '') AS message,
      node_name AS agent, round(duration_ms, 2) AS duration FROM spans""",
)
def snk3_spans(spark, sf_dir):
    return otlp.to_otlp(spans(spark, sf_dir)).select(
        "traceId", "spanId", "name", "startTimeUnixNano", "endTimeUnixNano",
        "status.code", "status.message",
        F.variant_get(F.col("attributes")["agent.name"], "$", "string").alias("agent"),
        F.variant_get(F.col("attributes")["agent.duration_ms"], "$", "double").alias("duration"),
    )


# every trace numbers its own spans, with gaps and with pairs of spans under one number, and holds snapshots
SNAPSHOTS = """SELECT trace_id, (seq - seq % 2) * 3 AS seq, start_time, end_time, duration_ms,
    node_name, status, error, map('type', node_name, 'user', string(trace_id)) AS input_snapshot,
    map('ok', error IS NULL, 'even', if(trace_id % 3 = 0, CAST(NULL AS BOOLEAN), trace_id % 2 = 0)) AS output_snapshot,
    map('total', trace_id + 1, 'calls', 2L) AS token_usage FROM {spans}"""
ATTRIBUTES = """concat('agent.duration_ms=', CAST(round(duration_ms, 2) AS VARCHAR), ';agent.name=', node_name,
    ';agent.status=', status, ';input.type=', node_name, ';input.user=', trace_id, ';output.even=',
    CASE WHEN trace_id % 3 = 0 THEN 'None' WHEN trace_id % 2 = 0 THEN 'True' ELSE 'False' END,
    ';output.ok=', CASE WHEN error IS NULL THEN 'True' ELSE 'False' END, ';token.calls=2;token.total=', trace_id + 1)"""


@query(
    "snk3_otlp_envelopes",
    f"""WITH {SUMMARY},
    lines AS (SELECT *, (row_number() OVER (PARTITION BY trace_id ORDER BY seq) - 1) // 8 AS batch FROM spans),
    sizes AS (SELECT trace_id, batch, count(*) AS n_spans FROM lines GROUP BY 1, 2),
    whole AS (SELECT trace_id, md5(string_agg({ATTRIBUTES}, '|' ORDER BY {ATTRIBUTES})) AS attributes FROM spans GROUP BY 1),
    nodes AS (SELECT trace_id, count(DISTINCT node_name) AS n_nodes FROM spans GROUP BY 1)
    SELECT s.trace_id, s.batch::BIGINT AS batch, s.n_spans::INTEGER AS n_spans, attributes, total_spans, slowest_node,
      n_nodes, concat('run ', s.trace_id) AS name
    FROM sizes s JOIN whole USING (trace_id) JOIN nodes USING (trace_id) JOIN summary USING (trace_id)""",
)
def snk3_envelopes(spark, sf_dir):
    made = otlp.otlp_envelopes(
        spark.sql(SNAPSHOTS, spans=spans(spark, sf_dir)),
        batch=8,
        configs=spans(spark, sf_dir).select("trace_id").distinct().selectExpr(
            "trace_id", "named_struct('name', concat('run ', trace_id)) AS config"
        ),
    )
    span = "struct<attributes: map<string,string>>"
    shape = (
        f"resourceSpans array<struct<scopeSpans: array<struct<spans: array<{span}>>>>>, metadata struct<config: struct<name: "
        "string>, summary: struct<total_spans: bigint, slowest_node: string, node_durations: map<string,double>>>"
    )
    read = made.withColumn("p", F.from_json("payload", shape))
    pairs = F.array_sort(F.map_entries("a"))
    texts = F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    attributes = (
        read.select("trace_id", F.explode(F.col("p.resourceSpans")[0]["scopeSpans"][0]["spans"]["attributes"]).alias("a"))
        .groupBy("trace_id")
        .agg(F.md5(F.array_join(F.array_sort(F.collect_list(texts)), "|")).alias("attributes"))
    )
    nodes = read.groupBy("trace_id").agg(F.sum(F.size("p.metadata.summary.node_durations")).alias("n_nodes"))
    return read.join(attributes, "trace_id").join(nodes, "trace_id").select(
        "trace_id", "batch", "n_spans", "attributes", "p.metadata.summary.total_spans",
        "p.metadata.summary.slowest_node", "n_nodes", "p.metadata.config.name",
    )


# --- scores -------------------------------------------------------------------------------

GRADE = """CASE WHEN {s} >= 0.9::DOUBLE THEN 'A' WHEN {s} >= 0.8::DOUBLE THEN 'B'
    WHEN {s} >= 0.7::DOUBLE THEN 'C' WHEN {s} >= 0.6::DOUBLE THEN 'D' ELSE 'F' END"""


def weighted(weights: dict[str, float]) -> str:
    return " + ".join(f"{d} * {w}::DOUBLE" for d, w in weights.items())


def spread(scored, key: str, weights: dict[str, float]):
    """Score, grade and one column per dimension, for comparing."""
    dims = [F.round(F.col("dimensions")[d], 6).alias(d) for d in weights]
    return scored.select(key, F.round("overall_score", 6).alias("overall_score"), "grade", *dims)


def scored_sql(source: str, key: str, weights: dict[str, float]) -> str:
    dims = ", ".join(f"round({d}, 6) AS {d}" for d in weights)
    total = f"least(greatest({weighted(weights)}, 0), 1)"
    return f"""{source}, t AS (SELECT *, {total} AS overall FROM d)
    SELECT {key}, round(overall, 6) AS overall_score, {GRADE.format(s='overall')} AS grade, {dims} FROM t"""


@query(
    "sco1_profiles",
    scored_sql(
        """WITH p AS (SELECT p_partkey, p_size, p_type, p_retailprice,
          p_size <= 45 AS has_basic, p_type <> 'ECONOMY' AS has_details,
          CASE WHEN p_size > 10 THEN 1 ELSE 0 END + CASE WHEN p_size > 20 THEN 1 ELSE 0 END
            + CASE WHEN p_size > 30 THEN 1 ELSE 0 END + CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS n_stats,
          CASE WHEN p_retailprice > 1000 THEN 1 ELSE 0 END + CASE WHEN p_brand > 'Brand#2' THEN 1 ELSE 0 END AS n_issues,
          CASE WHEN p_size < 25 THEN 1 ELSE 0 END AS n_missing FROM part),
        d AS (SELECT p_partkey,
          least((has_basic::INT + has_details::INT + 4)::DOUBLE / 5, 1) AS field_coverage,
          CASE WHEN n_issues + n_missing > 0 THEN least((n_issues + n_missing)::DOUBLE / 3, 1)
            ELSE 0.5::DOUBLE END AS quality_issues_found,
          CASE WHEN n_stats > 0 THEN least(n_stats::DOUBLE / 3, 1) ELSE least(2::DOUBLE / 3, 1) END
            AS numeric_stats_present,
          0.1::DOUBLE AS categorical_summary FROM p)""",
        "p_partkey",
        scoring.PROFILE_WEIGHTS,
    ),
)
def sco1(spark, sf_dir):
    profiles = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size <= 45 THEN map('rows', p_size) END AS basic_info",
        "CASE WHEN p_type <> 'ECONOMY' THEN map('type', p_type) END AS column_details",
        """map_from_entries(array_compact(array(
             CASE WHEN p_size > 10 THEN struct('a', p_size) END, CASE WHEN p_size > 20 THEN struct('b', p_size) END,
             CASE WHEN p_size > 30 THEN struct('c', p_size) END, CASE WHEN p_size > 40 THEN struct('d', p_size) END)))
           AS numeric_summary""",
        """array_compact(array(CASE WHEN p_retailprice > 1000 THEN p_name END,
             CASE WHEN p_brand > 'Brand#2' THEN p_brand END)) AS quality_issues""",
        "map('x', 1D, 'y', 2D) AS descriptive_stats",
        "map('p_size', CASE WHEN p_size < 25 THEN 1 ELSE 0 END) AS missing_values",
    )
    return spread(scoring.score_profiles(profiles), "p_partkey", scoring.PROFILE_WEIGHTS)


@query(
    "sco2_plans",
    scored_sql(
        """WITH p AS (SELECT o_orderkey, (o_totalprice > 100000)::INT AS outliers,
            (o_orderstatus <> 'O')::INT AS fills, (o_orderpriority = '1-URGENT')::INT AS odd,
            o_orderstatus = 'P' AS unprofiled, (o_totalprice > 200000)::INT AS price_issue,
            (o_orderpriority = '5-LOW')::INT AS key_issue FROM orders),
          c AS (SELECT *, outliers + fills + odd AS n FROM p),
        d AS (SELECT o_orderkey, least(n::DOUBLE / 3, 1) AS has_strategy,
          CASE WHEN n = 0 THEN 0 ELSE (outliers + fills)::DOUBLE / n END AS actions_valid,
          CASE WHEN n = 0 THEN 0 ELSE (outliers + fills)::DOUBLE / n END AS params_complete,
          CASE WHEN unprofiled OR n = 0 THEN 0.5::DOUBLE WHEN price_issue + key_issue = 0 THEN 0.6::DOUBLE
            ELSE (price_issue * outliers)::DOUBLE / (price_issue + key_issue) END AS addresses_issues FROM c)""",
        "o_orderkey",
        scoring.PLAN_WEIGHTS,
    ),
)
def sco2(spark, sf_dir):
    plans = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """array_compact(array(
          CASE WHEN o_totalprice > 100000 THEN named_struct('column', 'o_totalprice', 'action', 'remove_outliers',
            'params', map('method', 'iqr'), 'reason', string(NULL)) END,
          CASE WHEN o_orderstatus <> 'O' THEN named_struct('column', 'o_orderstatus', 'action', 'fill_missing',
            'params', CAST(NULL AS map<string,string>), 'reason', o_orderpriority) END,
          CASE WHEN o_orderpriority = '1-URGENT' THEN named_struct('column', '', 'action', 'explode',
            'params', CAST(NULL AS map<string,string>), 'reason', 'rush') END)) AS strategy""",
        """CASE WHEN o_orderstatus <> 'P' THEN array_compact(array(
          CASE WHEN o_totalprice > 200000 THEN 'o_totalprice' END,
          CASE WHEN o_orderpriority = '5-LOW' THEN 'o_custkey' END)) END AS issue_columns""",
    )
    return spread(scoring.score_plans(plans), "o_orderkey", scoring.PLAN_WEIGHTS)


@query(
    "sco3_analyses",
    scored_sql(
        """WITH c AS (SELECT conv_id * 100 + turn AS id, text, role, length(text) AS len,
            CASE WHEN role = 'system' THEN 0 WHEN turn > 0 THEN 2 ELSE 1 END AS n,
            (0.3::DOUBLE + CASE WHEN length(text) > 10 THEN 0.4::DOUBLE ELSE 0 END) + 0.3::DOUBLE AS first_one,
            (0::DOUBLE + 0) + 0.3::DOUBLE AS second_one FROM conversations),
        d AS (SELECT id, CASE WHEN len > 20 THEN least(len::DOUBLE / 100, 1) WHEN len > 0 THEN 0.4::DOUBLE
            ELSE 0::DOUBLE END AS has_summary,
          CASE WHEN n > 0 THEN least(n::DOUBLE / 4, 1) ELSE 0.1::DOUBLE END AS findings_count,
          CASE n WHEN 0 THEN 0::DOUBLE WHEN 1 THEN first_one ELSE (first_one + second_one) / 2 END AS evidence_quality,
          (1 + CASE WHEN n > 0 THEN 1 ELSE 0 END + 1 + CASE WHEN role = 'user' THEN 1 ELSE 0 END)::DOUBLE / 4
            AS structure FROM c)""",
        "id",
        scoring.ANALYSIS_WEIGHTS,
    ),
)
def sco3(spark, sf_dir):
    analyses = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id * 100 + turn AS id",
        "text AS summary",
        """CASE WHEN role <> 'system' THEN array_compact(array(
          named_struct('finding', role, 'evidence', text, 'confidence', 'high'),
          CASE WHEN turn > 0 THEN named_struct('finding', '', 'evidence', role, 'confidence', 'low') END))
          END AS findings""",
        "map('turn', turn) AS statistics",
        "CASE WHEN role = 'user' THEN 'as asked' END AS data_quality_note",
    )
    return spread(scoring.score_analyses(analyses), "id", scoring.ANALYSIS_WEIGHTS)


@query(
    "sco4_charts",
    scored_sql(
        """WITH files AS (SELECT DISTINCT concat('out/bar_', o_custkey, '.png') AS path FROM orders
            WHERE o_orderpriority = '1-URGENT'),
          c AS (SELECT o_orderkey, f.path IS NOT NULL AS bar_there, 1 + (o_orderstatus <> 'F')::INT * 2 AS n,
            1 + (o_orderstatus <> 'F')::INT AS types FROM orders
            LEFT JOIN files f ON f.path = concat('out/bar_', o_custkey, '.png')),
        d AS (SELECT o_orderkey, CASE WHEN n BETWEEN 3 AND 5 THEN 1::DOUBLE ELSE n::DOUBLE / 3 END AS chart_count,
          bar_there::INT::DOUBLE / n AS files_exist, types::DOUBLE / 3 AS type_diversity FROM c)""",
        "o_orderkey",
        scoring.CHART_WEIGHTS,
    ),
)
def sco4(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lists = orders.selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderstatus = 'F' THEN array(concat('out/bar_', o_custkey, '.png'))
          ELSE array(concat('out/bar_', o_custkey, '.png'), concat('pie/Pie_', o_orderkey, '.png'),
            'out/trend.png') END AS charts""",
    )
    files = orders.where("o_orderpriority = '1-URGENT'").selectExpr("concat('out/bar_', o_custkey, '.png') AS path")
    return spread(scoring.score_charts(lists, files, "o_orderkey"), "o_orderkey", scoring.CHART_WEIGHTS)


def _hits(words: tuple[str, ...], text: str) -> str:
    return " + ".join(f"contains({text}, '{w}')::INT" for w in words)


def _matches(pattern: str) -> str:
    return f"len(regexp_extract_all(text, '{pattern}'))"


REPORT_SQL = (
    f"""WITH c AS (SELECT doc_id, length(text) AS len, {_hits(scoring.REPORT_SECTIONS, 'text')} AS zh,
      {_hits(scoring.REPORT_SECTIONS_EN, 'lower(text)')} AS en, {_matches(scoring.IMAGE_REFERENCE)} AS images,
      """
    + ", ".join(f"{_matches(p)} AS s{i}" for i, p in enumerate(scoring.REPORT_SIGNS))
    + """ FROM documents),
    d AS (SELECT doc_id, CASE WHEN len >= 2000 THEN 1::DOUBLE WHEN len >= 500 THEN len::DOUBLE / 2000
        ELSE len::DOUBLE / 500 * 0.5::DOUBLE END AS length_adequate,
      least((zh + CASE WHEN zh < 3 THEN en ELSE 0 END)::DOUBLE / 6, 1) AS structure_complete,
      least(images::DOUBLE / 3, 1) AS chart_references,
      (0::DOUBLE + least(s0::DOUBLE / 5, 1) + least(s1::DOUBLE / 5, 1) + least(s2::DOUBLE / 5, 1)
        + least(s3::DOUBLE / 5, 1)) / 4 AS data_richness FROM c)"""
)


def reports(spark, sf_dir):
    return scoring.score_reports(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query("sco5_reports", scored_sql(REPORT_SQL, "doc_id", scoring.REPORT_WEIGHTS))
def sco5(spark, sf_dir):
    return spread(reports(spark, sf_dir), "doc_id", scoring.REPORT_WEIGHTS)


def _exact(d: str) -> str:
    """Rounded on the digits that the double is written with, not on a product that may land on a half."""
    return f"round({d}::VARCHAR::DECIMAL(38, 20), 3)::DOUBLE"


@query(
    "snk1_score_records",
    f"""{REPORT_SQL}, t AS (SELECT *, {weighted(scoring.REPORT_WEIGHTS)} AS overall FROM d)
    SELECT doc_id, 'reporter' AS agent_name, {GRADE.format(s='overall')} AS grade,
      {', '.join(f"{_exact(c)} AS {n}" for c, n in [('overall', 'overall_score'), *[(d, d) for d in scoring.REPORT_WEIGHTS]])} FROM t""",
)
def snk1(spark, sf_dir):
    written = sinks.score_records(reports(spark, sf_dir).drop("text"))
    fields = "doc_id bigint, agent_name string, grade string, overall_score double, dimensions map<string,double>"
    read = written.select(F.from_json("value", fields).alias("s")).select("s.*")
    dimensions = [read.dimensions[d].alias(d) for d in scoring.REPORT_WEIGHTS]
    return read.select("doc_id", "agent_name", "grade", "overall_score", *dimensions)


@query(
    "sco6_run_scores",
    f"""WITH s AS (SELECT o_custkey AS run_id, count(*) AS n, avg(o_totalprice / 500000) AS a,
        count(*) FILTER (o_orderstatus = 'P') AS e, count(*) FILTER (o_orderpriority = '1-URGENT') AS f,
        round(sum(o_totalprice), 2) AS t FROM orders GROUP BY o_custkey),
      j AS (SELECT c_custkey AS run_id, coalesce(n, 0) AS n, a, coalesce(e, 0) AS e, coalesce(f, 0) AS f,
        coalesce(t, 0) AS t FROM customer LEFT JOIN s ON s.run_id = c_custkey),
      p AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE 0.7::DOUBLE * a + 0.3::DOUBLE
        * (greatest(1 - e * 0.2::DOUBLE, 0) * (1 - f / greatest(n, 1))) END AS score FROM j)
    SELECT run_id, round(score, 3) AS run_score, n AS agent_count, round(coalesce(a, 0), 3) AS avg_agent_score,
      CASE WHEN n = 0 THEN 1 ELSE round(e / n, 3) END AS error_rate, t AS total_duration_ms,
      {GRADE.format(s='score')} AS grade FROM p""",
)
def sco6(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "run_id")
    scores = orders.select("run_id", (F.col("o_totalprice") / 500000).alias("overall_score"))
    failed = orders.where("o_orderstatus = 'P'").select("run_id")
    traces = orders.groupBy("run_id").agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("failed_spans"),
        F.count(F.lit(1)).alias("total_spans"),
        F.round(F.sum("o_totalprice"), 2).alias("total_agent_time_ms"),
    )
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"))
    return scoring.score_runs(scores, failed, traces, runs)


@query(
    "sco7_grades",
    f"SELECT o_orderkey, {GRADE.format(s='(o_totalprice / 500000)')} AS grade FROM orders",
)
def sco7(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", scoring.grade(F.col("o_totalprice") / 500000).alias("grade"))


AGENTS = {
    "1-URGENT": ("scout", "field_coverage", "quality_issues_found"),
    "2-HIGH": ("cleaner", "has_strategy", "addresses_issues"),
    "3-MEDIUM": ("analyst", "findings_count", "evidence_quality"),
    "4-NOT SPECIFIED": ("visualizer", "chart_count", "files_exist"),
    "5-LOW": ("reporter", "structure_complete", "data_richness"),
}


def _case(place: int) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v[place]}'" for k, v in AGENTS.items())
    return f"CASE o_orderpriority {whens} END"


SCORED_AGENTS = f"""o_custkey AS run_id, {_case(0)} AS agent_name, {_case(1)} AS dim_a, {_case(2)} AS dim_b,
    o_totalprice / 500000 AS overall_score, CASE WHEN o_orderstatus = 'F' THEN 0.55 ELSE 0.7 END AS score_a,
    o_totalprice / 250000 AS score_b"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "sco8_recommendations",
    f"""WITH s AS (SELECT {SCORED_AGENTS} FROM orders),
      rules(agent, dimension, cut) AS (VALUES {', '.join(f"('{a}', '{d}', {c})" for a, d, c in scoring.ADVICE_RULES)}),
      long AS (SELECT run_id, agent_name, overall_score, dim_a AS dimension, score_a AS score FROM s
        UNION ALL SELECT run_id, agent_name, overall_score, dim_b, score_b FROM s),
      words(dimension, recommendation) AS (VALUES {', '.join(f"('{d}', {_quoted(t)})" for d, t in scoring.ADVICE.items())}),
      fired AS (SELECT run_id, agent_name, long.dimension, recommendation FROM long JOIN rules
        ON agent = agent_name AND rules.dimension = long.dimension AND score < cut
        JOIN words ON words.dimension = long.dimension WHERE overall_score < 0.8)
    SELECT * FROM fired UNION ALL SELECT DISTINCT run_id, NULL, NULL, {_quoted(scoring.ADVICE_NONE)} FROM s
    WHERE run_id NOT IN (SELECT run_id FROM fired)""",
)
def sco8(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("scored_source")
    scores = spark.sql(
        f"""SELECT run_id, agent_name, overall_score,
        map(dim_a, double(score_a), dim_b, double(score_b)) AS dimensions
        FROM (SELECT {SCORED_AGENTS} FROM scored_source)"""
    )
    return scoring.recommendations(scores)


def _percent(d: str) -> str:
    return f"'{d}: ', round(round({d} * 100, 6))::INT, '%'"


@query(
    "sco9_score_table",
    f"""{REPORT_SQL}, t AS (SELECT *, {weighted(scoring.REPORT_WEIGHTS)} AS overall FROM d)
    SELECT doc_id, 'reporter' AS agent_name, round(round(overall * 100, 6), 1) AS score_pct,
      {GRADE.format(s='overall')} AS grade,
      concat({", ', ', ".join(_percent(d) for d in sorted(scoring.REPORT_WEIGHTS))}) AS dimension_scores FROM t""",
)
def sco9(spark, sf_dir):
    return scoring.score_table(reports(spark, sf_dir).drop("text"))


# --- JSON in text -------------------------------------------------------------------------

ANSWERS = """event_id, event_type, user_id, ts, props, CASE event_type WHEN 'view' THEN concat('  ', props, ' ')
    WHEN 'click' THEN concat('Here you are:\n```json\n', props, '\n```\nAnything else {?}')
    WHEN 'purchase' THEN concat('The result is ', props, ' as asked.')
    WHEN 'signup' THEN concat('All of them: [', props, ', 1] and no more')
    ELSE 'nothing to report (42)' END AS answer"""


def answers(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("answers_source")
    return spark.sql(f"SELECT {ANSWERS} FROM answers_source")


def _extract(kind: str, list_form: str) -> None:
    @query(
        f"ext1_extract_{kind}",
        f"""SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN {list_form}
        ELSE props END AS json FROM events""",
    )
    def run(spark, sf_dir):
        found = extract.extract_json(answers(spark, sf_dir), "answer", expect_list=kind == "list")
        return found.select("event_id", "json")


# braces come first unless a list is expected
_extract("object", "props")
_extract("list", "concat('[', props, ', 1]')")

# what Python reads as JSON and most readers refuse, and what it refuses
LOOSE_JSON = """CASE event_type WHEN 'view' THEN '{"a": 1, "a": ' || event_id || '}'
    WHEN 'click' THEN '{"a": NaN, "n": {"x": 1, "x": ' || event_id || '}}'
    WHEN 'signup' THEN '[-Infinity, ' || event_id || ']' WHEN 'purchase' THEN '{"a": +INF}' ELSE '{"a": 01}' END"""


@query(
    "ext1_extract_loose",
    f"""SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'signup') THEN {LOOSE_JSON} END AS json FROM events""",
)
def ext1_loose(spark, sf_dir):
    texts = table(spark, sf_dir, "events").selectExpr("event_id", f"'so: ' || {LOOSE_JSON} || ' done' AS answer")
    return extract.extract_json(texts, "answer").select("event_id", "json")


NULLS = """CASE event_id % 4 WHEN 0 THEN '{"k": null, "note": null, "parts": null}'
    WHEN 1 THEN '{"k": 1, "note": "a", "k": ' || event_id || ', "note": "b"}'
    WHEN 2 THEN '{"note": 5, "parts": [{"x": 1, "x": 2}]}' ELSE '{"note": "null"}' END"""


def _nulls(strict: bool) -> None:
    k, note, parts = ("'0'", "'none'", "'[]'") if strict else ("NULL", "NULL", "NULL")

    @query(
        f"ext2_nulls_{'strict' if strict else 'lenient'}",
        f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN {k} WHEN 1 THEN event_id::VARCHAR ELSE '0' END AS k,
        CASE event_id % 4 WHEN 0 THEN {note} WHEN 1 THEN 'b' WHEN 2 THEN {"'none'" if strict else "'5'"} ELSE 'null' END AS note,
        CASE event_id % 4 WHEN 0 THEN {parts} WHEN 2 THEN '[{{"x":1,"x":2}}]' ELSE '[]' END AS parts,
        NULL::VARCHAR AS raw_value FROM events""",
    )
    def run(spark, sf_dir):
        rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{NULLS} AS json")
        return extract.apply_schema(rows, "json", FIELDS, strict).drop("json")


FIELDS = {"k": ("number", "0"), "note": ("string", '"none"'), "parts": ("array", "[]")}


def _fields(strict: bool) -> None:
    wrong_note = "'none'" if strict else "regexp_extract(props, '[0-9]+')"
    wrong_k = "'0'" if strict else "'\"many\"'"

    @query(
        f"ext2_schema_{'strict' if strict else 'lenient'}",
        f"""SELECT event_id, CASE event_type WHEN 'error' THEN '0' WHEN 'view' THEN {wrong_k}
          WHEN 'signup' THEN '0' ELSE regexp_extract(props, '[0-9]+') END AS k,
        CASE event_type WHEN 'click' THEN 'seen' WHEN 'purchase' THEN {wrong_note} ELSE 'none' END AS note,
        CASE event_type WHEN 'click' THEN '[1,2]' ELSE '[]' END AS parts,
        CASE event_type WHEN 'signup' THEN '[1, 2]' END AS raw_value FROM events""",
    )
    def run(spark, sf_dir):
        rows = table(spark, sf_dir, "events").selectExpr(
            "event_id",
            """CASE event_type WHEN 'view' THEN '{"k": "many"}'
              WHEN 'click' THEN concat(substring(props, 1, length(props) - 1), ', "note": "seen", "parts": [1, 2]}')
              WHEN 'purchase' THEN concat(substring(props, 1, length(props) - 1), ', "note": ',
                regexp_extract(props, '([0-9]+)', 1), '}')
              WHEN 'signup' THEN '[1, 2]' ELSE NULL END AS json""",
        )
        return extract.apply_schema(rows, "json", FIELDS, strict).drop("json")


_fields(False)
_fields(True)
_nulls(False)
_nulls(True)


@query(
    "ext3_typed_analysis",
    """SELECT conv_id, turn, role AS summary, CASE WHEN role = 'system' THEN 0 ELSE 2 END AS n_findings,
    CASE WHEN role <> 'system' THEN turn::VARCHAR END AS first_evidence, turn::VARCHAR AS turn_statistic
    FROM conversations""",
)
def ext3(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """concat('{"summary": "', role, '", "statistics": {"turn": ', turn, '}, "findings": ',
          CASE WHEN role = 'system' THEN '[]' ELSE concat('[{"finding": "a", "evidence": "', turn,
          '", "confidence": "high"}, {"finding": "b"}]') END, '}') AS json""",
    )
    return extract.parse_result(rows, "json", extract.ANALYSIS_TYPE).select(
        "conv_id",
        "turn",
        "summary",
        F.size("findings").alias("n_findings"),
        F.get("findings", F.lit(0))["evidence"].alias("first_evidence"),
        F.col("statistics")["turn"].alias("turn_statistic"),
    )


@query(
    "ext3_typed_profile",
    """SELECT event_id, event_type AS kind, user_id::VARCHAR AS owner, CASE WHEN event_type = 'view' THEN 0 ELSE 2 END AS n_issues,
      CASE WHEN event_type <> 'view' THEN concat('gap in ', user_id) END AS first_issue,
      CASE WHEN event_type <> 'error' THEN 'number' END AS value_type, event_id::VARCHAR AS top, event_type = 'error' AS no_numbers
    FROM events""",
)
def ext3_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """concat('{"basic_info": {"kind": "', event_type, '", "owner": ', user_id, '}, "quality_issues": ',
          CASE WHEN event_type = 'view' THEN '[]' ELSE concat('["gap in ', user_id, '", "late"]') END,
          CASE WHEN event_type = 'error' THEN '' ELSE ', "column_details": {"value": "number"}, "numeric_summary": {"n": 1}' END,
          ', "categorical_summary": {"top": "', event_id, '"}}') AS json""",
    )
    read = extract.parse_result(rows, "json", extract.PROFILE_TYPE)
    return read.select(
        "event_id",
        F.col("basic_info")["kind"].alias("kind"),
        F.col("basic_info")["owner"].alias("owner"),
        F.size("quality_issues").alias("n_issues"),
        F.get("quality_issues", F.lit(0)).alias("first_issue"),
        F.col("column_details")["value"].alias("value_type"),
        F.col("categorical_summary")["top"].alias("top"),
        F.col("numeric_summary").isNull().alias("no_numbers"),
    )


@query(
    "ext3_typed_plan",
    """SELECT o_orderkey, i AS step, CASE i WHEN 0 THEN 'o_totalprice' ELSE 'o_comment' END AS "column",
      CASE i WHEN 0 THEN 'remove_outliers' ELSE 'drop' END AS action,
      CASE i WHEN 0 THEN o_custkey::VARCHAR END AS threshold, CASE i WHEN 0 THEN o_orderpriority END AS reason,
      CASE WHEN o_orderstatus <> 'F' THEN concat('plan ', o_orderkey) END AS overall_notes
    FROM orders, range(2) steps(i) WHERE i = 0 OR o_orderstatus = 'O'""",
)
def ext3_plan(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """concat('{"strategy": [{"column": "o_totalprice", "action": "remove_outliers", "params": {"threshold": ', o_custkey,
          '}, "reason": "', o_orderpriority, '"}', if(o_orderstatus = 'O', ', {"column": "o_comment", "action": "drop"}', ''), ']',
          if(o_orderstatus = 'F', '', concat(', "overall_notes": "plan ', o_orderkey, '"')), '}') AS json""",
    )
    read = extract.parse_result(rows, "json", extract.PLAN_TYPE)
    steps = read.select("o_orderkey", "overall_notes", F.posexplode("strategy").alias("step", "s"))
    return steps.select(
        "o_orderkey", F.col("step").cast("bigint").alias("step"), "s.column", "s.action",
        F.col("s.params")["threshold"].alias("threshold"), "s.reason", "overall_notes",
    )


@query(
    "ext4_artefact_paths",
    """WITH called AS (SELECT user_id AS run_id, concat('out/', event_type, '.png') AS path,
        min(event_id) AS first_seq, 0 AS first_pos FROM events
        WHERE event_type IN ('purchase', 'signup') GROUP BY ALL),
      last AS (SELECT user_id AS run_id, max(event_id) AS first_seq, arg_max(event_type, event_id) AS kind
        FROM events GROUP BY user_id)
    SELECT * FROM called
    UNION ALL SELECT run_id, concat('out/', kind, '_', run_id, '.png'), first_seq, 0 FROM last
      WHERE run_id NOT IN (SELECT run_id FROM called)
    UNION ALL SELECT run_id, 'out/bar.png', first_seq, 1 FROM last
      WHERE run_id NOT IN (SELECT run_id FROM called)""",
)
def ext4(spark, sf_dir):
    messages = table(spark, sf_dir, "events").selectExpr(
        "user_id AS run_id",
        "event_id AS seq",
        r"concat('Chart saved to: out/', event_type, '_', user_id, '.png\nChart saved to:  out/bar.png ') AS text",
        r"""CASE WHEN event_type IN ('purchase', 'signup') THEN concat(
          '[{"function": {"name": "create_chart", "arguments": "{\\"output_path\\": \\"out/', event_type,
          '.png\\"}"}}]') END AS calls""",
    )
    return extract.artefact_paths(messages, tool_calls="calls")


@query(
    "ext5_image_refs",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '（未生成图表）' ELSE
      concat('![图表1: bar of ', o_custkey, '](out/bar_of_', o_custkey, '.png)', chr(10), chr(10),
        '![图表2: trend.v2](trend.v2.png)') END AS "references" FROM orders""",
)
def ext5(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderstatus <> 'F' THEN array(concat('out/bar_of_', o_custkey, '.png'), 'trend.v2.png') END AS charts",
    )
    return extract.image_refs(rows).drop("charts")
