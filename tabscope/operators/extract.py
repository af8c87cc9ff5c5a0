"""JSON out of free text, schema filling, artefact paths and image references."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values
_FENCED = r"(?s)```(?:json)?\s*\n?(.*?)\n?\s*```"
_SAVED = r"Chart saved to:\s*([^\n]+)"
_CHART_TOOL = "create_chart"
_REFERENCE = "![图表%d: %s](%s)"
_NO_CHARTS = "（未生成图表）"

# field -> (JSON kind, default as JSON text)
PROFILE_SPEC = {
    "basic_info": ("object", "{}"),
    "column_details": ("object", "{}"),
    "numeric_summary": ("object", "{}"),
    "quality_issues": ("array", "[]"),
    "categorical_summary": ("object", "{}"),
}
PLAN_SPEC = {"strategy": ("array", "[]"), "overall_notes": ("string", '""')}
ANALYSIS_SPEC = {
    "summary": ("string", '""'),
    "findings": ("array", "[]"),
    "statistics": ("object", "{}"),
    "data_quality_note": ("string", '""'),
}

# the same three results as typed columns, for from_json
PROFILE_TYPE = (
    "basic_info map<string,string>, column_details map<string,string>, "
    "numeric_summary map<string,string>, quality_issues array<string>, "
    "categorical_summary map<string,string>"
)
PLAN_TYPE = (
    "strategy array<struct<column: string, action: string, params: map<string,string>, "
    "reason: string>>, overall_notes string"
)
ANALYSIS_TYPE = (
    "summary string, findings array<struct<finding: string, evidence: string, "
    "confidence: string>>, statistics map<string,string>, data_quality_note string"
)
# ---


_BLANK = " \t\r\n\f\v"
_END = "tabscope:end-of-text"
_STRINGS = r'"(?:[^"\\]|\\.)*+"'
_READER = {"allowSingleQuotes": "false"}


def _container(text: Column) -> Column:
    """The trimmed text if it is one whole JSON object or array, else NULL.

    Texts that cannot be one are told by their first and last character, without parsing.
    The parsers stop after the first value, so the text is parsed as an array's first element
    with a mark behind it: something after the value moves the mark or spoils the array. What the
    variant type has no room for, objects that repeat a key and the numbers NaN and Infinity, is read as text.
    """
    bare = F.trim(text, F.lit(_BLANK))
    framed = F.concat(F.lit("["), bare, F.lit(f',"{_END}"]'))
    whole = F.try_variant_get(F.try_parse_json(framed), "$[1]", "string") == _END
    loose = F.get(F.from_json(framed, "array<string>", _READER), F.lit(1)) == _END
    odd = F.regexp_replace(bare, _STRINGS, '""').rlike(r"INF|\+I")  # spellings that only the second reader knows
    return F.when(bare.rlike(r"(?s)^[\[{].*[\]}]$") & (F.coalesce(whole, F.lit(False)) | (loose & ~odd)), bare)


def _between(text: Column, opening: str, closing: str) -> Column:
    """From the first opening bracket to the last closing one."""
    start = F.instr(text, opening)
    end = F.length(text) - F.instr(F.reverse(text), closing) + 1
    found = (start > 0) & (F.instr(text, closing) > 0) & (end > start)
    return F.when(found, F.substring(text, start, end - start + 1))


def json_in(text: Column, expect_list: bool = False) -> Column:
    """The first JSON object or array in a text: the whole text, each fenced block in turn,
    the outermost braces (brackets first when a list is expected), then the other kind."""
    fenced = F.filter(
        F.transform(F.regexp_extract_all(text, F.lit(_FENCED), F.lit(1)), _container),
        lambda c: c.isNotNull(),
    )
    braces, brackets = _between(text, "{", "}"), _between(text, "[", "]")
    order = (brackets, braces) if expect_list else (braces, brackets)
    return F.coalesce(
        _container(text),
        F.when(text.contains("```"), F.get(fenced, F.lit(0))),
        *[_container(c) for c in order],
    )


def extract_json(
    df: DataFrame,
    text_col: str,
    expect_list: bool = False,
    default: str | None = None,
    out: str = "json",
) -> DataFrame:
    """Adds the JSON text found, ``default`` where there is none (NULL unless given)."""
    found = json_in(F.coalesce(F.col(text_col), F.lit("")), expect_list)
    return df.withColumn(out, F.coalesce(found, F.lit(default)))


_KINDS = {"object": "^OBJECT", "array": "^ARRAY", "string": "^STRING", "number": "^(BIGINT|DECIMAL|DOUBLE)", "boolean": "^BOOLEAN"}


def apply_schema(
    df: DataFrame, json_col: str, spec: Mapping[str, tuple[str, str]], strict: bool = False
) -> DataFrame:
    """One column per field of ``spec``, as JSON text and plain text for strings.

    Missing fields take their default, and with ``strict`` so do fields of another kind, JSON's null among them;
    without it a null is NULL. Of a repeated key the last counts; NaN and Infinity are numbers. A
    list has no fields: it is handed on whole in ``raw_value``. The JSON column stays.
    """
    names = {name: f"`{name.replace('`', '``')}`" for name in spec}
    parsed = (
        df.withColumn("_v", F.try_parse_json(F.col(json_col)))
        .withColumn("_c", _container(F.coalesce(F.col(json_col), F.lit(""))))
        .withColumn("_f", F.from_json("_c", ", ".join(f"{n} variant" for n in names.values()), _READER))
        .withColumn("_t", F.from_json("_c", ", ".join(f"{n} string" for n in names.values()), _READER))
    )
    is_object = F.coalesce(F.col("_c").startswith("{"), F.lit(False))
    fields = []
    for name, (kind, default) in spec.items():
        value = F.when(is_object, F.col("_f").getField(name))
        # a value with repeated keys inside is no variant, but still a text
        rest = F.when(is_object & value.isNull(), F.col("_t").getField(name))
        usable = value.isNotNull() | rest.isNotNull()
        if strict:
            nested = rest.rlike({"object": r"^\{", "array": r"^\["}.get(kind, "(?!)"))
            usable = F.coalesce(F.schema_of_variant(value).rlike(_KINDS[kind]), nested)
        text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)) if kind == "string" else F.to_json(value)
        text = F.when(F.schema_of_variant(value) != "VOID", text).when(value.isNull(), rest)
        fallback = F.lit(default)
        if kind == "string":
            fallback = F.try_variant_get(F.parse_json(F.lit(default)), "$", "string")
        fields.append(F.when(F.coalesce(usable, F.lit(False)), text).otherwise(fallback).alias(name))
    raw = F.when(~is_object & (F.col("_v").isNotNull() | F.col("_c").isNotNull()), F.col(json_col))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], *fields, raw.alias("raw_value"))


def artefact_paths(
    messages: DataFrame, run: str = "run_id", seq: str = "seq", text: str = "text", tool_calls: str | None = None
) -> DataFrame:
    """``run, path, first_seq, first_pos``: distinct chart paths in order of appearance.

    Paths come from the arguments of chart tool calls (``tool_calls``: JSON array of
    ``{function: {name, arguments}}``); runs without any are read from the text of their last
    message. Paths are reduced by (run, path) before anything else, so no run is gathered.
    """
    last = messages.groupBy(run).agg(F.max_by(text, seq).alias("_text"), F.max(seq).alias("_seq"))
    matches = F.transform(F.regexp_extract_all("_text", F.lit(_SAVED), F.lit(1)), lambda p: F.trim(p, F.lit(_BLANK)))
    said = (
        last.select(run, F.col("_seq").alias("seq"), F.posexplode(matches).alias("pos", "path"))
        .where("path <> ''")
    )
    if tool_calls is not None:
        calls = F.from_json(tool_calls, "array<struct<function: struct<name: string, arguments: string>>>")
        called = (
            messages.select(run, F.col(seq).alias("seq"), F.posexplode(calls).alias("pos", "call"))
            .where(F.col("call.function.name") == _CHART_TOOL)
            .select(run, "seq", "pos", F.get_json_object("call.function.arguments", "$.output_path").alias("path"))
            .where("path <> ''")
        )
        said = said.join(called.select(run).distinct(), run, "left_anti").unionByName(called)
    return (
        said.groupBy(run, "path")
        .agg(F.min(F.struct("seq", "pos")).alias("_at"))
        .select(run, "path", F.col("_at.seq").alias("first_seq"), F.col("_at.pos").alias("first_pos"))
    )


def image_refs(df: DataFrame, charts: str = "charts", out: str = "references") -> DataFrame:
    """Markdown image references for a list of chart paths, titled by file name."""

    def reference(path: Column, i: Column) -> Column:
        name = F.substring_index(path, "/", -1)
        title = F.replace(F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1"), F.lit("_"), F.lit(" "))
        return F.format_string(_REFERENCE, i + 1, title, path)

    listed = F.array_join(F.transform(charts, reference), "\n\n")
    empty = F.coalesce(F.size(charts), F.lit(0)) <= 0
    return df.withColumn(out, F.when(empty, _NO_CHARTS).otherwise(listed))


def parse_result(df: DataFrame, json_col: str, ddl: str) -> DataFrame:
    """Adds the typed fields of a result (``PROFILE_TYPE``, ``PLAN_TYPE``, ``ANALYSIS_TYPE``)."""
    parsed = df.withColumn("_r", F.from_json(F.col(json_col), ddl))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], "_r.*")
