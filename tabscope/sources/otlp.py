"""Spans in the shape of the OpenTelemetry JSON format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.order import numbered
from tabscope.functions.stats import spread_join
from tabscope.operators.telemetry import traces

# Spans per envelope. One trace may hold any share of the table, so it is sent as several
# envelopes with the same trace id, as OpenTelemetry batch exporters do.
BATCH_SPANS = 512


def _as_variants(entries: Column) -> Column:
    """A map with variant values, so that numbers stay numbers; a null map is empty."""
    return F.coalesce(
        F.transform_values(entries, lambda k, v: v.cast("variant")),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")),
    )


def _as_word(value: Column, dtype: T.DataType) -> Column:
    """A value as text: null is None, truth values are True and False, anything nested is JSON."""
    if isinstance(dtype, T.StringType):
        text = value
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(value.cast("string"))
    elif isinstance(dtype, T.VariantType):
        kind = F.schema_of_variant(value)
        text = F.when(kind == "VOID", F.lit("None")).when(kind == "BOOLEAN", F.initcap(value.cast("string")))
        text = text.when(kind.rlike("^(ARRAY|OBJECT)"), F.to_json(value)).otherwise(value.try_cast("string"))
    elif isinstance(dtype, (T.MapType, T.StructType, T.ArrayType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("None"))


def _renamed(prefix: str, entries: Column) -> Column:
    return F.transform_keys(entries, lambda k, v: F.concat(F.lit(prefix), k.cast("string")))


def _texts(prefix: str, spans: DataFrame, source: str) -> Column:
    """A snapshot under prefixed names, every value as text."""
    dtype = spans.schema[source].dataType.valueType
    return _as_variants(F.transform_values(_renamed(prefix, F.col(source)), lambda k, v: _as_word(v, dtype)))


def _nanos(seconds: Column) -> Column:
    return (seconds * F.lit(1e9)).cast("bigint")


def to_otlp(spans: DataFrame, service: str = "tabscope", keep: Sequence[str] = ()) -> DataFrame:
    """One OpenTelemetry span per row, attributes flattened under agent/input/output/token.

    Snapshots are maps; their values become texts. Token counts keep their type.
    """
    trace, seq = F.col("trace_id").cast("string"), F.col("seq").cast("string")
    own = F.create_map(
        F.lit("agent.name"),
        F.col("node_name").cast("variant"),
        F.lit("agent.status"),
        F.col("status").cast("variant"),
        F.lit("agent.duration_ms"),
        F.round("duration_ms", 2).cast("variant"),
    )
    parts = [own]
    for prefix, source in (("input.", "input_snapshot"), ("output.", "output_snapshot")):
        if source in spans.columns:
            parts.append(_texts(prefix, spans, source))
    if "token_usage" in spans.columns:
        parts.append(_as_variants(_renamed("token.", F.col("token_usage"))))
    return spans.select(
        "trace_id",
        "seq",
        trace.alias("traceId"),
        F.substring(F.md5(F.concat_ws(":", trace, seq)), 1, 16).alias("spanId"),
        F.lit("").alias("parentSpanId"),
        F.concat(F.lit(service + "."), F.col("node_name")).alias("name"),
        F.lit("SERVER").alias("kind"),
        _nanos(F.col("start_time")).alias("startTimeUnixNano"),
        _nanos(F.col("end_time")).alias("endTimeUnixNano"),
        F.map_concat(*parts).alias("attributes"),
        F.struct(
            F.when(F.col("status") == "success", "OK").otherwise("ERROR").alias("code"),
            F.coalesce("error", F.lit("")).alias("message"),
        ).alias("status"),
        F.array().cast("array<string>").alias("events"),
        *keep,
    )


def otlp_envelopes(
    spans: DataFrame,
    service: str = "tabscope",
    version: str = "0.1.0",
    batch: int = BATCH_SPANS,
    configs: DataFrame | None = None,
) -> DataFrame:
    """``trace_id, batch, n_spans, payload``: resource-span envelopes of bounded size.

    Spans are numbered in their trace, by ``seq``, over ranges of the whole order: every envelope of a
    trace but its last holds exactly ``batch`` spans, whatever gaps or repeats ``seq`` has, and no task
    numbers a whole trace. ``configs`` holds ``trace_id, config`` of any type, one row per trace;
    a trace without one has an empty object. The summary is that of the trace; its node durations, by the last
    span of each node, stand in the envelope of that span, so that an envelope stays bounded.
    """
    fields = [
        "traceId", "spanId", "parentSpanId", "name", "kind",
        "startTimeUnixNano", "endTimeUnixNano", "attributes", "status", "events",
    ]
    placed = numbered(spans, ["trace_id"], ["seq"], "__number")
    made = to_otlp(placed, service, keep=("__number", "node_name", "duration_ms"))
    made = made.withColumn("batch", F.floor(F.col("__number") / batch))
    gathered = made.groupBy("trace_id", "batch").agg(
        F.sort_array(F.collect_list(F.struct("__number", F.to_json(F.struct(*fields)).alias("json")))).alias("_s")
    )
    last = made.groupBy("trace_id", "node_name").agg(
        F.max(F.struct("__number", "batch", F.round("duration_ms", 2).alias("duration"))).alias("l")
    )
    nodes = last.groupBy("trace_id", F.col("l.batch").alias("batch")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("node_name", "l.duration")))).alias("node_durations")
    )
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    gathered = gathered.join(nodes, ["trace_id", "batch"], "left").withColumn(
        "_nodes", F.to_json(F.coalesce("node_durations", none))
    )
    summary = [
        "total_spans", "successful_spans", "failed_spans", "total_agent_time_ms",
        "avg_span_duration_ms", "slowest_node", "fastest_node",
    ]
    about = traces(spans)
    config = F.lit("{}")
    if configs is not None:
        about = about.join(configs.select("trace_id", "config"), "trace_id", "left")
        own = F.col("config")
        text = own if isinstance(configs.schema["config"].dataType, T.StringType) else F.to_json(own)
        config = F.coalesce(text, F.lit("{}"))
    times = F.to_json(
        F.struct(
            F.col("trace_start").alias("pipeline_start"),
            F.col("trace_end").alias("pipeline_end"),
            F.round("total_duration_ms", 2).alias("total_duration_ms"),
        )
    )
    # two objects left open at their end, for the configuration and the node durations
    about = about.select(
        "trace_id",
        F.concat(F.rtrim(times, F.lit("}")), F.lit(',"config":'), config).alias("_times"),
        F.rtrim(F.to_json(F.struct(*summary)), F.lit("}")).alias("_summary"),
    )
    resource = F.to_json(
        F.create_map(
            F.lit("service.name"), F.lit(service),
            F.lit("service.version"), F.lit(version),
            F.lit("pipeline.trace_id"), F.col("trace_id").cast("string"),
        )
    )
    scope = F.to_json(F.struct(F.lit(f"{service}.tracer").alias("name"), F.lit(version).alias("version")))
    listed = F.array_join(F.transform("_s", lambda s: s["json"]), ",")
    payload = F.concat(
        F.lit('{"resourceSpans":[{"resource":{"attributes":'), resource,
        F.lit('},"scopeSpans":[{"scope":'), scope,
        F.lit(',"spans":['), listed,
        F.lit(']}]}],"metadata":'), F.col("_times"),
        F.lit(',"summary":'), F.col("_summary"),
        F.lit(',"node_durations":'), F.col("_nodes"), F.lit("}}}"),
    )
    return spread_join(gathered, about, ["trace_id"], ["batch"]).select(
        "trace_id", "batch", F.size("_s").alias("n_spans"), payload.alias("payload")
    )
