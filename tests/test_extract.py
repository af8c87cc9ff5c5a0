import json

import pytest

from tabscope.operators import extract
from tests.conftest import column

FENCE = "```"

CASES = [
    ('{"a": 1}', False, {"a": 1}),
    ('  [1, 2]\n', False, [1, 2]),
    (f'text {FENCE}json\n{{"a": 2}}\n{FENCE} tail', False, {"a": 2}),
    (f'{FENCE}\n{{"a": 3}}\n{FENCE}', False, {"a": 3}),
    (f'{FENCE}json\nnot json\n{FENCE} and {FENCE}\n{{"a": 4}}\n{FENCE}', False, {"a": 4}),
    (f'{FENCE}json\nbroken {{\n{FENCE}', False, None),
    ('result: {"a": {"b": [1]}} done', False, {"a": {"b": [1]}}),
    ('list: [{"a": 1}] done', True, [{"a": 1}]),
    ('list: [{"a": 1}] done', False, {"a": 1}),
    ('both [1, 2] and {"a": 1}', False, {"a": 1}),
    ('both [1, 2] and {"a": 1}', True, [1, 2]),
    ('only [1, 2]', False, [1, 2]),
    ("no json here", False, None),
    ("", False, None),
    (None, False, None),
    ("42", False, None),
    ('"text"', False, None),
    ("} {", False, None),
    ('{"a": 1} trailing }', False, None),
    ('{"中文": "值"}', False, {"中文": "值"}),
]


@pytest.mark.parametrize("as_list", [False, True])
def test_extract(spark, as_list):
    cases = [c for c in CASES if c[1] == as_list]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "id int, text string")
    for r in extract.extract_json(df, "text", expect_list=as_list).collect():
        want = cases[r["id"]][2]
        got = None if r["json"] is None else json.loads(r["json"])
        assert got == want, cases[r["id"]]


def test_default(spark):
    df = spark.createDataFrame([("nothing",), ('{"a": 1}',)], "text string")
    assert column(extract.extract_json(df, "text", default="{}"), "json") == ["{}", '{"a": 1}']


def test_schema(spark):
    spec = extract.ANALYSIS_SPEC
    df = spark.createDataFrame(
        [('{"summary": 123, "findings": [{"finding": "x"}]}',), ("[1, 2]",), (None,), ('{"summary": "ok", "statistics": null}',)],
        "json string")
    loose = extract.apply_schema(df, "json", spec).collect()
    strict = extract.apply_schema(df, "json", spec, strict=True).collect()
    assert loose[0]["summary"] == "123" and strict[0]["summary"] == ""
    assert json.loads(strict[0]["findings"]) == [{"finding": "x"}]
    assert (strict[0]["statistics"], strict[0]["data_quality_note"]) == ("{}", "")
    assert loose[1]["raw_value"] == "[1, 2]" and loose[1]["findings"] == "[]"
    assert loose[2]["raw_value"] is None and loose[2]["summary"] == ""
    assert strict[3]["summary"] == "ok" and strict[3]["statistics"] == "{}"


def test_typed_results(spark):
    df = spark.createDataFrame([('{"strategy": [{"column": "a", "action": "fill_missing", "params": {"strategy": "mean"}}], "overall_notes": "n"}',)], "json string")
    row = extract.parse_result(df, "json", extract.PLAN_TYPE).first()
    assert row["strategy"][0]["params"] == {"strategy": "mean"} and row["overall_notes"] == "n"
    for name, ddl in (("basic_info", extract.PROFILE_TYPE), ("findings", extract.ANALYSIS_TYPE)):
        assert name in extract.parse_result(df, "json", ddl).columns


def test_paths(spark):
    call = json.dumps([{"function": {"name": "create_chart", "arguments": json.dumps({"output_path": "o/a.png"})}},
                       {"function": {"name": "other", "arguments": json.dumps({"output_path": "o/no.png"})}},
                       {"function": {"name": "create_chart", "arguments": "not json"}}])
    rows = [("r1", 0, "Chart saved to: o/ignored.png", call), ("r1", 1, "Chart saved to: o/z.png", call),
            ("r2", 0, "Chart saved to: o/early.png", None),
            ("r2", 1, "Chart saved to: o/b.png \nand Chart saved to:  o/c.png\nChart saved to: o/b.png", None),
            ("r3", 0, "nothing", None)]
    df = spark.createDataFrame(rows, "run_id string, seq int, text string, calls string")
    got = extract.artefact_paths(df, tool_calls="calls").orderBy("run_id", "first_seq", "first_pos").collect()
    assert [(r["run_id"], r["path"]) for r in got] == [("r1", "o/a.png"), ("r2", "o/b.png"), ("r2", "o/c.png")]


def test_image_references(spark):
    df = spark.createDataFrame([(["out/bar_of_sales.png", "x.tar.gz"],), ([],), (None,)], "charts array<string>")
    assert column(extract.image_refs(df), "references") == [
        "![图表1: bar of sales](out/bar_of_sales.png)\n\n![图表2: x.tar](x.tar.gz)", "（未生成图表）", "（未生成图表）"]


def test_what_variants_cannot_hold(spark):
    rows = ['{"a":1,"a":2}', '{"a": NaN}', '[1, -Infinity]', '{"a":{"b":1,"b":{"c":"}"}}}', '{"a":+INF}', "{'a':1}", '{"a":1,}', '{"a":"INF +I"}', '{"a":NaN} x']
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t string")
    found = {r["k"]: r["json"] for r in extract.extract_json(df, "t").collect()}
    assert found == {0: rows[0], 1: rows[1], 2: rows[2], 3: rows[3], 4: None, 5: None, 6: None, 7: rows[7], 8: '{"a":NaN}'}


def test_nulls_and_repeated_keys_in_schemas(spark):
    rows = ['{"a":null,"s":null}', '{"a":1,"a":2,"s":"x","s":"y"}', "{}", '{"s":"null"}', None, "[1]", '{"a":NaN}']
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t string")
    spec = {"a": ("number", "0"), "s": ("string", '"none"')}
    read = lambda strict: {r["k"]: (r["a"], r["s"]) for r in extract.apply_schema(df, "t", spec, strict).collect()}
    loose, strict = read(False), read(True)
    assert loose[0] == (None, None) and strict[0] == ("0", "none")
    assert loose[1] == strict[1] == ("2", "y")
    assert loose[2] == ("0", "none") and loose[3] == strict[3] == ("0", "null")
    assert loose[4] == loose[5] == ("0", "none")
    assert "NaN" in loose[6][0] and "NaN" in strict[6][0]
