import json

import pytest

from tabscope.functions import stats
from tabscope.operators import scoring, telemetry
from tabscope.sources import otlp, sinks
from tests.conftest import keyed, most_in_a_partition, written

SPAN = (
    "trace_id string, seq int, node_name string, start_time double, end_time double, "
    "duration_ms double, status string, error string, input_snapshot map<string,string>, "
    "output_snapshot map<string,string>, token_usage map<string,double>"
)


def span(trace, seq, node, duration, start=0.0, status="success", error=None, **maps):
    return (trace, seq, node, start, start + duration / 1000, float(duration), status, error,
            maps.get("i"), maps.get("o"), maps.get("t"))


@pytest.fixture(scope="module")
def spans(spark):
    rows = [
        span("t1", 0, "scout", 100),
        span("t1", 1, "analyst", 300, 0.1),
        span("t1", 2, "reporter", 200, 0.4),
        # a repeated node, and ties for slowest and fastest
        span("t2", 0, "a", 50, 10.0),
        span("t2", 1, "b", 50, 10.05),
        span("t2", 2, "a", 20, 10.1, "error", "boom"),
        span("t2", 3, "c", 20, 10.2),
        # no length at all
        span("t3", 0, "scout", 0, 5.0),
    ]
    return spark.createDataFrame(rows, SPAN)


def test_summary(spans):
    rows = {r["trace_id"]: r for r in telemetry.trace_summary(spans).collect()}
    t1, t2 = rows["t1"], rows["t2"]
    assert (t1["total_spans"], t1["total_agent_time_ms"], t1["avg_span_duration_ms"]) == (3, 600.0, 200.0)
    assert (t1["slowest_node"], t1["fastest_node"]) == ("analyst", "scout")
    assert (t2["successful_spans"], t2["failed_spans"]) == (3, 1)
    assert (t2["slowest_node"], t2["fastest_node"]) == ("a", "a")


def test_last_duration_of_a_node_counts(spans):
    rows = {(r["trace_id"], r["node_name"]): r["duration_ms"] for r in telemetry.node_durations(spans).collect()}
    assert rows[("t2", "a")] == 20.0 and rows[("t1", "analyst")] == 300.0


def test_timeline(spans):
    rows = {(r["trace_id"], r["seq"]): r for r in telemetry.timeline(spans).collect()}
    assert rows[("t1", 1)]["left_pct"] == pytest.approx(100 / 6)
    assert rows[("t1", 1)]["width_pct"] == pytest.approx(50)
    assert not any(k[0] == "t3" for k in rows)
    bounds = spans.sparkSession.createDataFrame([("t1", -1.0, 100000.0)], "trace_id string, trace_start double, total_duration_ms double")
    narrow = {r["seq"]: r for r in telemetry.timeline(spans, bounds).collect()}
    assert narrow[0]["width_pct"] == 0.5 and narrow[0]["offset_ms"] == pytest.approx(1000)


def test_failed(spans):
    assert [tuple(r) for r in telemetry.failed_spans(spans).collect()] == [("t2", 2, "a", "boom")]


def test_progress(spark):
    def progress(*nodes):
        rows = [span("r", i, n, 1) for i, n in enumerate(nodes)]
        r = telemetry.stage_progress(spark.createDataFrame(rows, SPAN)).first()
        return r["progress"], r["current_stage"]

    assert progress("scout") == (15, "cleaner_plan")
    assert progress("scout", "scout", "cleaner_plan") == (30, "cleaner_execute")
    assert progress("scout", "cleaner_plan", "cleaner_execute", "analyst", "visualizer", "reporter") == (90, "reporter")
    assert progress("quality_gate") == (0, "quality_gate")
    everything = [s for s in telemetry.STAGE_WEIGHTS]
    assert progress(*everything)[0] == 92
    assert progress("upload", "health_check", "done")[0] == 0


def test_tokens(spark):
    usage = spark.createDataFrame(
        [("scout", "qwen-max", 100, 50), ("scout", "qwen-max", 200, 100), ("analyst", "other", 1000, 1000)],
        "agent string, model string, prompt_tokens bigint, completion_tokens bigint")
    rows = {r["agent"]: r for r in telemetry.token_usage(usage).collect()}
    assert (rows["scout"]["total_tokens"], rows["scout"]["call_count"]) == (450, 2)
    assert rows["analyst"]["estimated_cost_usd"] == 0.008
    assert (rows["total"]["total_tokens"], rows["total"]["call_count"]) == (2450, 3)
    assert rows["total"]["estimated_cost_usd"] == pytest.approx(0.008 + 300 / 1000 * 0.002 + 150 / 1000 * 0.006)


def test_cost_by_model(spark):
    usage = spark.createDataFrame([(m, 1000, 1000) for m in ("gpt-4o", "qwen-max", "unheard-of")],
                                  "model string, prompt_tokens bigint, completion_tokens bigint")
    assert keyed(telemetry.with_cost(usage), "model", "cost_usd") == pytest.approx(
        {"gpt-4o": 0.0125, "qwen-max": 0.008, "unheard-of": 0.008})


@pytest.mark.parametrize(
    "response, tokens",
    [
        ({"usage_metadata": {"input_tokens": 100, "output_tokens": 50}}, (100, 50)),
        ({"usage_metadata": {"input_tokens": 0, "prompt_tokens": 7}}, (7, 0)),
        ({"usage_metadata": {}, "response_metadata": {"token_usage": {"prompt_tokens": 3, "completion_tokens": 4}}}, (3, 4)),
        ({"response_metadata": {"token_usage": {}, "usage": {"prompt_tokens": 5}}}, (5, 0)),
        ({"usage": {"prompt_tokens": 1, "completion_tokens": 2}}, (1, 2)),
        ({"usage_metadata": {}}, (0, 0)),
        ({"content": "x"}, None),
        ({"usage_metadata": None}, None),
    ],
)
def test_usage_lookup(spark, response, tokens):
    df = spark.createDataFrame([(json.dumps(response),)], "response string")
    got = [(r["prompt_tokens"], r["completion_tokens"]) for r in telemetry.usage_tokens(df).collect()]
    assert got == ([] if tokens is None else [tokens])


def errors_of(spark, lines, **how):
    rows = [(run, i, line) for i, (run, line) in enumerate(lines)]
    df = spark.createDataFrame(rows, "run_id string, seq int, line string")
    return telemetry.classify_errors(telemetry.parse_errors(df), **how)


def test_parse_errors(spark):
    df = errors_of(spark, [("r", "[scout] it\nbroke"), ("r", "no brackets"), ("r", "[open"), ("r", "[]x"), ("r", "[a]"), ("r", "[a]: b [c] d")])
    assert [(r["agent_name"], r["message"]) for r in df.orderBy("seq").collect()] == [
        ("scout", "it\nbroke"), ("", ""), ("a", ""), ("a", " b [c] d")]


def test_severity_rules(spark):
    lines = [("r", f"[{a}] x") for a in ("scout", "cleaner_execute", "visualizer", "analyst")]
    assert keyed(errors_of(spark, lines), "agent_name", "severity") == {
        "scout": "fatal", "cleaner_execute": "degraded", "visualizer": "degraded", "analyst": "warning"}
    assert keyed(errors_of(spark, lines, rule="graph"), "agent_name", "severity")["analyst"] == "degraded"
    assert keyed(errors_of(spark, lines), "agent_name", "recoverable")["scout"] is False
    with pytest.raises(ValueError):
        errors_of(spark, lines, rule="other")


def test_health_and_decision(spark):
    lines = [("stop", "[analyst] a"), ("stop", "[scout] no file"), ("stop", "[scout] again"),
             ("one", "[visualizer] x"), ("three", "[visualizer] x"), ("three", "[visualizer] y"),
             ("three", "[cleaner_execute] z"), ("warn", "[analyst] w")]
    df = errors_of(spark, lines)
    runs = spark.createDataFrame([(r,) for r in ("stop", "one", "three", "warn", "clean", "clean")], "run_id string")
    assert keyed(telemetry.run_health(df, runs), "run_id", "health") == {
        "stop": "fatal", "one": "degraded", "three": "degraded", "warn": "degraded", "clean": "healthy"}
    rows = {r["run_id"]: (r["should_continue"], r["reason"]) for r in telemetry.continue_decision(df, runs).collect()}
    assert rows == {
        "stop": (False, "Fatal error in 'scout' (runtime_error): no file"),
        "one": (True, "Continuing with 1 non-fatal error(s)."),
        "three": (False, "Too many degraded errors (3). Pipeline output quality would be unacceptable."),
        "warn": (True, "Continuing with 1 non-fatal error(s)."),
        "clean": (True, "No errors."),
    }


def test_quality_gate(spark):
    rows = [("good", 0, 0.6), ("better", 0, 0.3), ("better", 1, 0.4), ("better", 2, 0.5), ("stuck", 0, 0.4), ("stuck", 1, 0.4)]
    df = spark.createDataFrame(rows, "run_id string, iteration int, score double")
    got = {(r["run_id"], r["iteration"]): r["decision"] for r in telemetry.quality_gate(df).collect()}
    assert got == {("good", 0): "quality_ok", ("better", 0): "needs_reclean", ("better", 1): "needs_reclean",
                   ("better", 2): "quality_ok", ("stuck", 0): "needs_reclean", ("stuck", 1): "quality_ok"}


def test_otlp(spark):
    rows = [span("t", 0, "scout", 12.345, 1.5, i={"rows": "5"}, o={"ok": "yes"}, t={"total": 7.0}),
            span("t", 1, "analyst", 1, 2.0, "error", "boom"), span("t", 700, "late", 1, 3.0)]
    df = spark.createDataFrame(rows, SPAN)
    configs = spark.sql("SELECT 't' AS trace_id, named_struct('max_iterations', 2, 'review', true) AS config")
    made = otlp.otlp_envelopes(df, "svc", batch=2, configs=configs).orderBy("batch").collect()
    payloads = [json.loads(r["payload"]) for r in made]
    assert [p["metadata"]["config"] for p in payloads] == [{"max_iterations": 2, "review": True}] * 2
    assert [p["metadata"]["summary"]["node_durations"] for p in payloads] == [{"scout": 12.35, "analyst": 1.0}, {"late": 1.0}]
    assert len(payloads) == 2
    first = payloads[0]["resourceSpans"][0]
    assert first["resource"]["attributes"]["service.name"] == "svc"
    scout, analyst = first["scopeSpans"][0]["spans"]
    assert scout["name"] == "svc.scout" and scout["kind"] == "SERVER"
    assert scout["startTimeUnixNano"] == 1500000000
    assert scout["attributes"] == {"agent.name": "scout", "agent.status": "success", "agent.duration_ms": 12.35,
                                   "input.rows": "5", "output.ok": "yes", "token.total": 7}
    assert scout["status"] == {"code": "OK", "message": ""} and scout["events"] == []
    assert analyst["status"] == {"code": "ERROR", "message": "boom"}
    assert len({scout["spanId"], analyst["spanId"]}) == 2 and len(scout["spanId"]) == 16
    for p in payloads:
        assert p["metadata"]["summary"]["total_spans"] == 3 and p["metadata"]["pipeline_start"] == 1.5


def test_sinks(spark, spans, tmp_path):
    sinks.write_spans_json(spans, str(tmp_path / "spans"))
    assert spark.read.json(str(tmp_path / "spans")).where("trace_id = 't1'").count() == 3
    sinks.write_summaries_json(telemetry.trace_summary(spans), str(tmp_path / "sum"))
    assert spark.read.json(str(tmp_path / "sum")).count() == 3
    sinks.write_otlp(spans, str(tmp_path / "otlp"))
    assert spark.read.text(str(tmp_path / "otlp")).count() == 3
    scores = spark.sql("SELECT 'x' AS id, 0.12345D AS overall_score, 'F' AS grade, map('a', 0.98765D) AS dimensions")
    sinks.write_scores_json(scores, str(tmp_path / "scores"))
    line = json.loads(spark.read.text(str(tmp_path / "scores")).first()[0])
    assert line == {"id": "x", "overall_score": 0.123, "grade": "F", "dimensions": {"a": 0.988}}
    agents = scores.selectExpr("id AS run_id", "'scout' AS agent_name", "overall_score", "grade", "dimensions")
    sinks.write_evaluation_json(
        agents, scoring.score_runs(agents), scoring.recommendations(agents), str(tmp_path / "all"))
    for part in ("scores", "runs", "recommendations"):
        assert spark.read.json(str(tmp_path / "all" / part)).count() == 1


def test_envelopes_are_full(spark):
    """Whatever seq is: gaps, repeats, one for all spans, null."""
    rows = [span("gaps", 1000 * k, "a", 1) for k in range(11)] + [span("same", 5, f"n{k}", k) for k in range(10)]
    rows += [span("none", None, "a", 1), span("one", 0, "a", 1)]
    made = otlp.otlp_envelopes(spark.createDataFrame(rows, SPAN), batch=4).collect()
    sizes = {}
    for r in sorted(made, key=lambda r: r["batch"]):
        sizes.setdefault(r["trace_id"], []).append(r["n_spans"])
    assert sizes == {"gaps": [4, 4, 3], "same": [4, 4, 2], "none": [1], "one": [1]}
    nodes = [json.loads(r["payload"])["metadata"]["summary"]["node_durations"] for r in made if r["trace_id"] == "same"]
    assert {k: v for part in nodes for k, v in part.items()} == {f"n{k}": float(k) for k in range(10)}
    assert all(json.loads(r["payload"])["metadata"]["config"] == {} for r in made)


def test_snapshots_become_texts(spark):
    df = spark.sql("""SELECT 't' AS trace_id, 0 AS seq, 'a' AS node_name, 0D AS start_time, 1D AS end_time, 1D AS duration_ms,
        'success' AS status, string(null) AS error, map('n', parse_json('5'), 't', parse_json('true'), 'z', parse_json('null'),
        'l', parse_json('[1,2]'), 's', parse_json('"x"'), 'v', cast(null as variant)) AS input_snapshot,
        map('f', 0.5D, 'g', cast(null as double)) AS output_snapshot, map('total', 7L) AS token_usage""")
    payload = json.loads(otlp.otlp_envelopes(df).first()["payload"])
    attributes = payload["resourceSpans"][0]["scopeSpans"][0]["spans"][0]["attributes"]
    assert {k: v for k, v in attributes.items() if not k.startswith("agent.")} == {
        "input.n": "5", "input.t": "True", "input.z": "None", "input.l": "[1,2]", "input.s": "x", "input.v": "None",
        "output.f": "0.5", "output.g": "None", "token.total": 7}


def test_usage_that_is_null(spark):
    texts = ['{"usage_metadata": null, "usage": {"input_tokens": 5}}', '{"usage": {"input_tokens": 5}}', '{"usage_metadata": {}, "usage": {"input_tokens": 5}}']
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, response string")
    assert {r["k"]: r["prompt_tokens"] for r in telemetry.usage_tokens(df).collect()} == {1: 5, 2: 0}


def test_a_long_trace_without_length_is_spread(spark, sixteen, monkeypatch, tmp_path):
    spans = spark.range(0, 16_000, 1, 4).selectExpr(
        "IF(id < 15000, 0, id) AS trace_id", "id AS seq", "'n' AS node_name", "1D AS start_time",
        "IF(id < 15000, 1D, 2D) AS end_time", "IF(id < 15000, 0D, 1000D) AS duration_ms", "'success' AS status")
    dealt = []

    def joined(*args, **rest):
        dealt.append(stats.spread_join(*args, **rest))
        return dealt[-1]

    monkeypatch.setattr(telemetry, "spread_join", joined)
    assert telemetry.timeline(written(spans, tmp_path / "spans")).count() == 1000
    assert most_in_a_partition(dealt[0].where("trace_id = 0"), "total_duration_ms") < 2000
