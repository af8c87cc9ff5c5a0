"""Sources, inspection, profiling, cleaning, analysis and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    GAPPED_EVENTS,
    GAPPED_LINEITEM,
    gapped_events,
    gapped_lineitem,
    query,
    rounded,
    table,
)
from tabscope.operators import analyze, clean, inspect, profile
from tabscope.plans.cleaning import run_plan
from tabscope.plans.versions import VersionedTable
from tabscope.sources import csvfile


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- sources ------------------------------------------------------------------------------


@query(
    "flagship_clean_mean",
    """WITH s AS (SELECT quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 FROM events)
    SELECT event_type, round(avg(value), 6) AS "mean(value)" FROM events, s
    WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY event_type""",
)
def flagship(spark, sf_dir):
    kept = clean.remove_outliers(table(spark, sf_dir, "events"), "value", "iqr")
    return rounded(analyze.group_statistics(kept, "event_type", "value", "mean"), 6, "mean(value)")


@query(
    "src1_typed_text_columns",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id::DOUBLE END AS user_id,
    event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
    event_type = 'click' AS is_click, props FROM events""",
)
def src1(spark, sf_dir):
    text = table(spark, sf_dir, "events").selectExpr(
        "string(event_id) AS event_id",
        "CASE WHEN event_type = 'view' THEN 'NULL' ELSE string(user_id) END AS user_id",
        "event_type",
        "CASE WHEN event_type = 'error' THEN 'N/A' ELSE string(value) END AS value",
        "CASE WHEN event_type = 'click' THEN 'True' ELSE 'False' END AS is_click",
        "props",
    )
    return csvfile.typed(text)


# real lines: quotes and commas in fields, a line break inside quotes, NA texts, and short lines
CSV_LINE = r"""concat(event_id, ',', CASE WHEN event_type = 'view' THEN 'NULL' ELSE string(user_id) END, ',"',
    replace(event_type, 'c', 'say ""c"", '), if(event_id % 5 = 0, '\n', ' '), 'end",',
    CASE WHEN event_type = 'error' THEN 'N/A' ELSE string(value) END, ',', if(event_type = 'click', 'True', 'False'),
    CASE WHEN event_id % 7 = 0 THEN '' ELSE concat(',', if(event_id % 2 = 0, '""', '"n/a"')) END)"""


@query(
    "src1_csv_lines",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id::DOUBLE END AS user_id,
    concat(replace(event_type, 'c', 'say "c", '), CASE WHEN event_id % 5 = 0 THEN chr(10) ELSE ' ' END, 'end') AS note,
    CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type = 'click' AS is_click,
    NULL::DOUBLE AS nothing FROM events""",
)
def src1_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "events").selectExpr(f"{CSV_LINE} AS line")
    return csvfile.parse_lines(lines, ["event_id", "user_id", "note", "value", "is_click", "nothing"], "line")


@query(
    "src2_load_info",
    """SELECT count(*) AS row_count, 5 AS column_count, 'doc_id,text,lang,source,n_chars' AS columns,
    round(sum(strlen(doc_id::VARCHAR) + strlen(text) + strlen(lang) + strlen(source)
      + strlen(n_chars::VARCHAR)) / 1024, 2) AS size_kb FROM documents""",
)
def src2(spark, sf_dir):
    return inspect.load_info(table(spark, sf_dir, "documents"))


@query("src2_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 3")
def src2_head(spark, sf_dir):
    return inspect.head(table(spark, sf_dir, "customer"), 3, "c_custkey")


@query(
    "src3_views",
    """WITH top AS (SELECT v, count(*) c, row_number() OVER (ORDER BY count(*) DESC, v) r
      FROM (SELECT c_mktsegment AS v FROM customer) GROUP BY v)
    SELECT 'schema' AS view, 'c_custkey' AS name, count(DISTINCT c_custkey)::DOUBLE AS value FROM customer
    UNION ALL SELECT 'schema', 'c_name', count(DISTINCT c_name) FROM customer
    UNION ALL SELECT 'schema', 'c_nationkey', count(DISTINCT c_nationkey) FROM customer
    UNION ALL SELECT 'schema', 'c_acctbal', count(DISTINCT c_acctbal) FROM customer
    UNION ALL SELECT 'schema', 'c_mktsegment', count(DISTINCT c_mktsegment) FROM customer
    UNION ALL SELECT 'profile', 'c_acctbal median', round(quantile_cont(c_acctbal, 0.5), 4) FROM customer
    UNION ALL SELECT 'info', 'row_count', count(*) FROM customer
    UNION ALL SELECT 'top', v, c FROM top WHERE r <= 5
    UNION ALL SELECT 'missing', 'columns', 5""",
)
def src3(spark, sf_dir):
    csvfile.register_views(table(spark, sf_dir, "customer"), "customer_csv", "c_custkey")
    return spark.sql(
        """SELECT 'schema' AS view, column AS name, double(unique_count) AS value FROM customer_csv_schema
        UNION ALL SELECT 'profile', 'c_acctbal median', round(value, 4) FROM customer_csv_profile
          WHERE column = 'c_acctbal' AND statistic = '50%'
        UNION ALL SELECT 'info', 'row_count', row_count FROM customer_csv_info
        UNION ALL SELECT 'top', value, count FROM customer_csv_top WHERE column = 'c_mktsegment'
        UNION ALL SELECT 'missing', 'columns', count(*) FROM customer_csv_missing WHERE null_count = 0"""
    )


# --- inspection and profiling -------------------------------------------------------------

ORDERS_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "ins1_schema_info",
    union_all(
        [
            f"""SELECT '{c}' AS "column", '{t}' AS dtype, round(count({c}) / count(*), 4) AS non_null_rate,
            count(DISTINCT {c}) AS unique_count FROM orders"""
            for c, t in ORDERS_TYPES.items()
        ]
    ),
)
def ins1(spark, sf_dir):
    return inspect.schema_info(table(spark, sf_dir, "orders"))


LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
LINEITEM_NUMBERS = [c for c, t in LINEITEM_TYPES.items() if t in ("bigint", "int", "double")]


@query(
    "ins2_frame_info",
    f"WITH {GAPPED_LINEITEM} "
    + union_all(
        [
            f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
            count(*) - count({c}) AS missing, count(DISTINCT {c}) AS "unique",
            count(*) AS table_rows, 11 AS table_columns FROM gapped"""
            for c, t in LINEITEM_TYPES.items()
        ]
    ),
)
def ins2(spark, sf_dir):
    return inspect.frame_info(gapped_lineitem(spark, sf_dir))


@query(
    "ins3_sample_rows",
    "SELECT * FROM orders ORDER BY md5(concat('42:', o_orderkey)), o_orderkey LIMIT 5",
)
def ins3(spark, sf_dir):
    return inspect.sample_rows(table(spark, sf_dir, "orders"), "o_orderkey", 5)


def describe_sql(source: str, columns: list[str], digits: int) -> str:
    forms = {
        "count": "count({c})::DOUBLE",
        "mean": "avg({c})",
        "std": "stddev_samp({c})",
        "min": "min({c})::DOUBLE",
        "25%": "quantile_cont({c}::DOUBLE, 0.25)",
        "50%": "quantile_cont({c}::DOUBLE, 0.5)",
        "75%": "quantile_cont({c}::DOUBLE, 0.75)",
        "max": "max({c})::DOUBLE",
    }
    return union_all(
        [
            f"""SELECT '{c}' AS "column", '{s}' AS statistic, round({f.format(c=c)}, {digits}) AS value
            FROM {source}"""
            for c in columns
            for s, f in forms.items()
        ]
    )


@query(
    "pro1_describe_long", f"WITH {GAPPED_LINEITEM} " + describe_sql("gapped", LINEITEM_NUMBERS, 4)
)
def pro1(spark, sf_dir):
    return rounded(profile.describe_long(gapped_lineitem(spark, sf_dir)), 4, "value")


@query(
    "pro2_missing_summary",
    f"WITH {GAPPED_LINEITEM} "
    + union_all(
        [
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
            round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct FROM gapped"""
            for c in LINEITEM_TYPES
        ]
    ),
)
def pro2(spark, sf_dir):
    return profile.missing_summary(gapped_lineitem(spark, sf_dir))


@query(
    "pro3_top_values",
    union_all(
        [
            f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS value, count(*) AS "count",
            (row_number() OVER (ORDER BY count(*) DESC, {c}))::INTEGER AS "rank" FROM part GROUP BY {c})
            WHERE "rank" <= 5"""
            for c in ("p_name", "p_brand", "p_type")
        ]
    ),
)
def pro3(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"))


@query(
    "pro4_describe_wide",
    "WITH long AS ("
    + describe_sql("orders", ["o_orderkey", "o_custkey", "o_totalprice"], 4)
    + """) SELECT statistic, max(value) FILTER ("column" = 'o_orderkey') AS o_orderkey,
    max(value) FILTER ("column" = 'o_custkey') AS o_custkey,
    max(value) FILTER ("column" = 'o_totalprice') AS o_totalprice FROM long GROUP BY statistic""",
)
def pro4(spark, sf_dir):
    wide = profile.describe_wide(table(spark, sf_dir, "orders"))
    return rounded(wide, 4, "o_orderkey", "o_custkey", "o_totalprice")


def quick_sql(c: str, t: str) -> str:
    number = t in ("bigint", "int", "double")
    moments = (
        f"round(avg({c}), 4), round(stddev_samp({c}), 4), min({c})::DOUBLE, max({c})::DOUBLE"
        if number
        else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE"
    )
    return f"""SELECT '{c}' , '{t}', count(*) - count({c}),
    round((count(*) - count({c})) / count(*) * 100, 2), count(DISTINCT {c}), {moments} FROM gapped"""


@query(
    "pro5_quick_profile",
    f"WITH {GAPPED_LINEITEM}, p(\"column\", dtype, null_count, null_pct, unique_count, mean, std, min, max) AS ("
    + union_all([quick_sql(c, t) for c, t in LINEITEM_TYPES.items()])
    + ") SELECT * FROM p",
)
def pro5(spark, sf_dir):
    return profile.quick_profile(gapped_lineitem(spark, sf_dir))


@query(
    "pro6_value_distribution",
    """SELECT p_brand AS value, count(*) AS "count",
    round(count(*) / (SELECT count(*) FROM part) * 100, 2) AS pct,
    (SELECT count(DISTINCT p_brand) FROM part) AS total_unique
    FROM part GROUP BY p_brand ORDER BY 2 DESC, 1 LIMIT 10""",
)
def pro6(spark, sf_dir):
    return profile.value_distribution(table(spark, sf_dir, "part"), "p_brand", 10)


@query(
    "pro7_quality_issues",
    f"""WITH {GAPPED_EVENTS}, s AS (
      SELECT quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 FROM gapped)
    SELECT 'value' AS "column", 'missing_values' AS issue, count(*) - count(value) AS n,
      round((count(*) - count(value)) / count(*) * 100, 2) AS pct FROM gapped
    UNION ALL
    SELECT 'value', 'iqr_outliers', count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)),
      round(count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) / count(*) * 100, 2)
      FROM gapped, s""",
)
def pro7(spark, sf_dir):
    return profile.quality_issues(gapped_events(spark, sf_dir))


# --- cleaning -----------------------------------------------------------------------------

LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def filled(spark, sf_dir, strategy: str):
    done = clean.fill_missing(gapped_lineitem(spark, sf_dir), "l_discount", strategy)
    return done.select(*LINE.split(", "), F.round("l_discount", 6).alias("l_discount"))


def filled_sql(filler: str) -> str:
    return f"""WITH {GAPPED_LINEITEM}
    SELECT {LINE}, round(coalesce(l_discount, ({filler})), 6) AS l_discount FROM gapped"""


@query("cln1_fill_mean", filled_sql("SELECT avg(l_discount) FROM gapped"))
def cln1(spark, sf_dir):
    return filled(spark, sf_dir, "mean")


@query("cln2_fill_median", filled_sql("SELECT quantile_cont(l_discount, 0.5) FROM gapped"))
def cln2(spark, sf_dir):
    return filled(spark, sf_dir, "median")


@query(
    "cln3_fill_mode",
    filled_sql(
        """SELECT l_discount FROM gapped WHERE l_discount IS NOT NULL GROUP BY l_discount
        ORDER BY count(*) DESC, l_discount LIMIT 1"""
    ),
)
def cln3(spark, sf_dir):
    return filled(spark, sf_dir, "mode")


@query("cln4_fill_zero", filled_sql("0"))
def cln4(spark, sf_dir):
    return filled(spark, sf_dir, "zero")


@query(
    "cln5_drop_missing",
    f"WITH {GAPPED_LINEITEM} SELECT {LINE}, round(l_discount, 6) AS l_discount FROM gapped "
    "WHERE l_discount IS NOT NULL",
)
def cln5(spark, sf_dir):
    return filled(spark, sf_dir, "drop")


@query(
    "cln6_outliers_iqr",
    f"""WITH {GAPPED_EVENTS}, s AS (
      SELECT quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 FROM gapped)
    SELECT gapped.* FROM gapped, s
    WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def cln6(spark, sf_dir):
    return clean.remove_outliers(gapped_events(spark, sf_dir), "value", "iqr")


@query(
    "cln7_outliers_zscore",
    f"""WITH {GAPPED_EVENTS}, s AS (SELECT avg(value) m, stddev_samp(value) d FROM gapped)
    SELECT gapped.* FROM gapped, s WHERE abs((value - m) / d) <= 3""",
)
def cln7(spark, sf_dir):
    return clean.remove_outliers(gapped_events(spark, sf_dir), "value", "zscore")


@query(
    "cln8_scale_minmax",
    f"""WITH s AS (SELECT min(l_extendedprice) lo, max(l_extendedprice) hi FROM lineitem)
    SELECT {LINE}, round((l_extendedprice - lo) / (hi - lo), 6) AS l_extendedprice FROM lineitem, s""",
)
def cln8(spark, sf_dir):
    done = clean.normalize_column(table(spark, sf_dir, "lineitem"), "l_extendedprice", "minmax")
    return done.select(*LINE.split(", "), F.round("l_extendedprice", 6).alias("l_extendedprice"))


@query(
    "cln9_scale_standard",
    f"""WITH s AS (SELECT avg(l_extendedprice) m, stddev_samp(l_extendedprice) d FROM lineitem)
    SELECT {LINE}, round((l_extendedprice - m) / d, 6) AS l_extendedprice FROM lineitem, s""",
)
def cln9(spark, sf_dir):
    done = clean.normalize_column(table(spark, sf_dir, "lineitem"), "l_extendedprice", "standard")
    return done.select(*LINE.split(", "), F.round("l_extendedprice", 6).alias("l_extendedprice"))


PLAN = [
    {"column": "value", "action": "fill_missing", "params": {"strategy": "median"}},
    {"column": "value", "action": "remove_outliers", "params": {"method": "iqr", "threshold": 1.5}},
    {"column": "value", "action": "winsorize", "params": {}},
    {"column": "no_such_column", "action": "fill_missing", "params": {}},
    {"column": "user_id,event_type,value", "action": "drop_duplicates",
     "params": {"columns": "user_id,event_type,value"}},
    {"column": "value", "action": "normalize_column", "params": {"method": "minmax"}},
]
PLAN_SQL = f"""WITH {GAPPED_EVENTS},
  a AS (SELECT * REPLACE (coalesce(value, (SELECT quantile_cont(value, 0.5) FROM gapped)) AS value) FROM gapped),
  s AS (SELECT quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 FROM a),
  b AS (SELECT a.* FROM a, s WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)),
  c AS (SELECT DISTINCT user_id, event_type, value FROM b)"""


@query(
    "cln10_plan_result",
    PLAN_SQL
    + """ SELECT user_id, event_type, round((value - (SELECT min(value) FROM c)) /
      ((SELECT max(value) FROM c) - (SELECT min(value) FROM c)), 6) AS value FROM c""",
)
def cln10_result(spark, sf_dir):
    done = run_plan(gapped_events(spark, sf_dir), PLAN).df
    return done.select("user_id", "event_type", F.round("value", 6).alias("value"))


@query(
    "cln10_plan_log",
    PLAN_SQL
    + """, n AS (SELECT (SELECT count(*) FROM a) na, (SELECT count(*) FROM b) nb, (SELECT count(*) FROM c) nc)
    SELECT 1 AS step, 'fill_missing' AS action, 'applied' AS status, na AS rows_in, na AS rows_out FROM n
    UNION ALL SELECT 2, 'remove_outliers', 'applied', na, nb FROM n
    UNION ALL SELECT 3, 'winsorize', 'skipped', nb, nb FROM n
    UNION ALL SELECT 4, 'fill_missing', 'failed', nb, nb FROM n
    UNION ALL SELECT 5, 'drop_duplicates', 'applied', nb, nc FROM n
    UNION ALL SELECT 6, 'normalize_column', 'applied', nc, nc FROM n""",
)
def cln10_log(spark, sf_dir):
    log = run_plan(gapped_events(spark, sf_dir), PLAN).log
    status = F.substring_index("status", ":", 1).alias("status")
    return log.select("step", "action", status, "rows_in", "rows_out")


@query(
    "cln11_drop_duplicates",
    """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
      l_shipdate) AS place FROM lineitem) WHERE place = 1""",
)
def cln11(spark, sf_dir):
    return clean.drop_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "cln12_convert_type",
    """SELECT event_id, try_cast(CASE WHEN event_type = 'error' THEN 'bad' ELSE
    regexp_extract(props, '[0-9]+') END AS INTEGER) AS props FROM events""",
)
def cln12(spark, sf_dir):
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "bad")
        .otherwise(F.regexp_extract("props", "([0-9]+)", 1))
        .alias("props"),
    )
    return clean.convert_type(text, "props", "int")


# --- analysis -----------------------------------------------------------------------------


def _group(number: int, func: str, sql_func: str) -> None:
    @query(
        f"agg{number}_group_{func}",
        f"""SELECT o_orderpriority, round({sql_func}(o_totalprice), 4) AS "{func}(o_totalprice)"
        FROM orders GROUP BY o_orderpriority""",
    )
    def run(spark, sf_dir):
        done = analyze.group_statistics(
            table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", func
        )
        return rounded(done, 4, f"{func}(o_totalprice)")


for _n, (_f, _s) in enumerate(
    {"mean": "avg", "sum": "sum", "count": "count", "min": "min", "max": "max"}.items(), start=1
):
    _group(_n, _f, _s)


@query(
    "agg6_correlation",
    """SELECT round(corr(l_quantity, l_extendedprice), 6) AS coefficient, count(*) AS n,
    CASE WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.7 THEN 'strong'
         WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
    CASE WHEN corr(l_quantity, l_extendedprice) >= 0 THEN 'positive' ELSE 'negative' END AS direction
    FROM lineitem""",
)
def agg6(spark, sf_dir):
    done = analyze.correlation(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(done, 6, "coefficient")


# --- versions -----------------------------------------------------------------------------


def versioned(spark, sf_dir) -> VersionedTable:
    return (
        VersionedTable(gapped_events(spark, sf_dir), "raw")
        .change("drop missing", lambda d: clean.fill_change(d, "value", "drop"))
        .change("no change", lambda d: None)
        .change("outliers", lambda d: clean.outlier_change(d, "value", "zscore"))
    )


VERSION_SQL = f"""WITH {GAPPED_EVENTS},
  v2 AS (SELECT * FROM gapped WHERE value IS NOT NULL),
  s AS (SELECT avg(value) m, stddev_samp(value) d FROM v2),
  v4 AS (SELECT v2.* FROM v2, s WHERE abs((value - m) / d) <= 3),
  h AS (SELECT 1 AS version, 'raw' AS label, (SELECT count(*) FROM gapped) AS n_rows
    UNION ALL SELECT 2, 'drop missing', (SELECT count(*) FROM v2)
    UNION ALL SELECT 3, 'no change', (SELECT count(*) FROM v2)
    UNION ALL SELECT 4, 'outliers', (SELECT count(*) FROM v4))"""


@query("ver1_load", f"WITH {GAPPED_EVENTS} SELECT event_id, value FROM gapped")
def ver1(spark, sf_dir):
    return versioned(spark, sf_dir).load(gapped_events(spark, sf_dir)).df.select("event_id", "value")


@query("ver2_apply", VERSION_SQL + " SELECT event_id, value FROM v4")
def ver2(spark, sf_dir):
    return versioned(spark, sf_dir).df.select("event_id", "value")


@query("ver3_rollback", VERSION_SQL + " SELECT event_id, value FROM v2")
def ver3(spark, sf_dir):
    return versioned(spark, sf_dir).rollback(2).df.select("event_id", "value")


@query("ver4_history", VERSION_SQL + " SELECT version, label, n_rows, 6 AS n_cols FROM h")
def ver4(spark, sf_dir):
    return versioned(spark, sf_dir).history().drop("created_at")


@query(
    "ver5_diffs",
    VERSION_SQL
    + " SELECT version, label, coalesce(n_rows - lag(n_rows) OVER (ORDER BY version), 0) AS rows_delta FROM h",
)
def ver5(spark, sf_dir):
    return versioned(spark, sf_dir).diffs()
