"""Ad-hoc SQL and chart datasets."""

from __future__ import annotations

from registry.base import GAPPED_EVENTS, GAPPED_LINEITEM, gapped_events, gapped_lineitem, query, rounded, table
from tabscope.operators import charts
from tabscope.operators.adhoc import safe_query, safe_query_count
from tabscope.operators.profile import describe_wide


def adhoc(name: str, sql: str, *tables: str) -> None:
    """A query that reads the same in both engines, run whole through the gate."""

    @query(name, sql)
    def run(spark, sf_dir):
        return safe_query(spark, {t: table(spark, sf_dir, t) for t in tables}, sql, limit=None)


# --- ad-hoc queries -----------------------------------------------------------------------

BIG_ORDERS = "SELECT o_orderkey, o_totalprice FROM df WHERE o_totalprice > 100000 ORDER BY o_totalprice DESC, o_orderkey"


@query("qry1_gate", "SELECT event_type, count(*) AS n, min(value) AS lowest FROM events GROUP BY event_type")
def qry1(spark, sf_dir):
    sql = "SELECT event_type, count(*) AS n, min(value) AS lowest FROM df GROUP BY event_type"
    return safe_query(spark, table(spark, sf_dir, "events"), sql)


@query("qry2_capped_result", BIG_ORDERS.replace("df", "orders") + " LIMIT 100")
def qry2(spark, sf_dir):
    return safe_query(spark, table(spark, sf_dir, "orders"), BIG_ORDERS)


@query(
    "qry2_row_count",
    "SELECT count(*) AS row_count, count(*) > 100 AS truncated FROM orders WHERE o_totalprice > 100000",
)
def qry2_count(spark, sf_dir):
    return safe_query_count(spark, table(spark, sf_dir, "orders"), BIG_ORDERS)


adhoc("qry3_filter", "SELECT * FROM part WHERE p_size > 25 AND p_retailprice < 950", "part")
adhoc(
    "qry4_group_sum",
    "SELECT c_mktsegment, round(sum(c_acctbal), 4) AS balance FROM customer GROUP BY c_mktsegment",
    "customer",
)
adhoc(
    "qry5_top_k",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "orders",
)


@query(
    "qry6_describe",
    """SELECT statistic, round(c, 4) AS c_acctbal FROM (
      SELECT unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS statistic,
      unnest([count(c_acctbal), avg(c_acctbal), stddev_samp(c_acctbal), min(c_acctbal),
        quantile_cont(c_acctbal, 0.25), quantile_cont(c_acctbal, 0.5), quantile_cont(c_acctbal, 0.75),
        max(c_acctbal)]) AS c FROM customer)""",
)
def qry6(spark, sf_dir):
    return rounded(describe_wide(table(spark, sf_dir, "customer"), ["c_acctbal"]), 4, "c_acctbal")


adhoc(
    "qry7_join",
    """SELECT c.c_mktsegment, count(o.o_orderkey) AS n_orders, round(sum(o.o_totalprice), 2) AS total
    FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""",
    "customer",
    "orders",
)
adhoc(
    "qry8_semi",
    """SELECT c_custkey, c_name FROM customer c
    WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""",
    "customer",
    "orders",
)
adhoc(
    "qry8_anti",
    """SELECT c_custkey, c_name FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""",
    "customer",
    "orders",
)
adhoc("qry9_distinct", "SELECT DISTINCT p_brand, p_type FROM part", "part")
adhoc(
    "qry10_union",
    """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""",
    "customer",
    "supplier",
)
adhoc(
    "qry11_ranking",
    """SELECT * FROM (SELECT c_mktsegment, o_orderkey, o_totalprice,
      CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC) AS INTEGER) AS place
      FROM orders JOIN customer ON o_custkey = c_custkey) t WHERE place <= 3""",
    "orders",
    "customer",
)
# windows run over the daily totals of a user, which a hot user cannot inflate
adhoc(
    "qry12_analytic",
    """WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS total
      FROM events GROUP BY user_id, CAST(ts AS DATE))
    SELECT user_id, CAST(day AS STRING) AS day, round(total, 4) AS total,
      round(total - lag(total) OVER (PARTITION BY user_id ORDER BY day), 4) AS change,
      round(sum(total) OVER (PARTITION BY user_id ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running,
      round(avg(total) OVER (PARTITION BY user_id ORDER BY day
        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling
    FROM daily""",
    "events",
)


@query(
    "qry13_pivot",
    """SELECT l_returnflag, sum(l_quantity) FILTER (l_linestatus = 'F') AS F,
    sum(l_quantity) FILTER (l_linestatus = 'O') AS O FROM lineitem GROUP BY l_returnflag""",
)
def qry13(spark, sf_dir):
    sql = """SELECT * FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM df)
    PIVOT (sum(l_quantity) FOR l_linestatus IN ('F' AS F, 'O' AS O))"""
    return safe_query(spark, table(spark, sf_dir, "lineitem"), sql, limit=None)


adhoc(
    "qry14_text_and_dates",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, upper(substring(o_orderpriority, 3)) AS priority,
    count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM orders
    GROUP BY year(o_orderdate), month(o_orderdate), upper(substring(o_orderpriority, 3))""",
    "orders",
)

# --- charts -------------------------------------------------------------------------------


@query(
    "cht1_bar",
    """SELECT p_brand AS label, max(p_retailprice) AS top, min(p_retailprice) AS bottom,
    count(p_retailprice) AS n FROM part GROUP BY p_brand""",
)
def cht1(spark, sf_dir):
    return charts.bar(table(spark, sf_dir, "part"), "p_brand", "p_retailprice")


@query(
    "cht2_bar_grouped",
    """SELECT o_orderpriority AS x, o_orderstatus AS "group", round(avg(o_totalprice), 4) AS mean
    FROM orders GROUP BY ALL""",
)
def cht2(spark, sf_dir):
    done = charts.bar(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", "o_orderstatus")
    return rounded(done, 4, "mean")


@query(
    "cht2_bar_wide",
    """SELECT o_orderpriority, round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS F,
    round(avg(o_totalprice) FILTER (o_orderstatus = 'O'), 4) AS O,
    round(avg(o_totalprice) FILTER (o_orderstatus = 'P'), 4) AS P FROM orders GROUP BY 1""",
)
def cht2_wide(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    done = charts.bar_wide(orders, "o_orderpriority", "o_totalprice", "o_orderstatus", ["F", "O", "P"])
    return rounded(done, 4, "F", "O", "P")


@query("cht3_line", "SELECT o_orderdate AS x, o_totalprice AS y FROM orders")
def cht3(spark, sf_dir):
    return charts.line(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


@query("cht4_line_grouped", """SELECT ts AS x, value AS y, event_type AS "group" FROM events""")
def cht4(spark, sf_dir):
    return charts.line(table(spark, sf_dir, "events"), "ts", "value", "event_type")


@query(
    "cht5_scatter",
    f"WITH {GAPPED_LINEITEM} SELECT l_quantity AS x, l_discount AS y FROM gapped WHERE l_discount IS NOT NULL",
)
def cht5(spark, sf_dir):
    return charts.scatter(gapped_lineitem(spark, sf_dir), "l_quantity", "l_discount")


@query(
    "cht6_scatter_grouped",
    f"""WITH {GAPPED_EVENTS} SELECT user_id AS x, value AS y, event_type AS "group" FROM gapped
    WHERE value IS NOT NULL""",
)
def cht6(spark, sf_dir):
    return charts.scatter(gapped_events(spark, sf_dir), "user_id", "value", "event_type")


def hist_sql(partition: str) -> str:
    keys = '"group", ' if partition else ""
    join = 'USING ("group", bin)' if partition else "USING (bin)"
    return f"""WITH v AS (SELECT event_type AS "group", value AS v FROM events),
    r AS (SELECT {keys} min(v) AS lo, max(v) AS hi FROM v {'GROUP BY "group"' if partition else ''}),
    g AS (SELECT {'v."group",' if partition else ''} v, lo, hi,
      least(floor((v - lo) / (hi - lo) * 20), 19) AS i FROM v {'JOIN r USING ("group")' if partition else ', r'}),
    f AS (SELECT {keys} CAST(1 + CASE WHEN v < lo + i * ((hi - lo) / 20) THEN i - 1
      WHEN i < 19 AND v >= lo + (i + 1) * ((hi - lo) / 20) THEN i + 1 ELSE i END AS INTEGER) AS bin FROM g),
    c AS (SELECT {keys} bin, count(*) AS n FROM f GROUP BY ALL),
    frame AS (SELECT {keys} lo, hi, b::INTEGER AS bin FROM r, range(1, 21) t(b))
    SELECT {keys} bin, round(frame.lo + (bin - 1) * ((hi - lo) / 20), 6) AS lo,
      round(frame.lo + bin * ((hi - lo) / 20), 6) AS hi, coalesce(n, 0) AS "count"
    FROM frame LEFT JOIN c {join}"""


@query("cht7_hist", hist_sql(""))
def cht7(spark, sf_dir):
    return rounded(charts.hist(table(spark, sf_dir, "events"), "value"), 6, "lo", "hi")


@query("cht8_hist_grouped", hist_sql("group"))
def cht8(spark, sf_dir):
    return rounded(charts.hist(table(spark, sf_dir, "events"), "value", "event_type"), 6, "lo", "hi")


@query(
    "cht9_pie",
    """WITH t AS (SELECT p_brand AS label, count(*) AS value FROM part GROUP BY p_brand
      ORDER BY 2 DESC, 1 LIMIT 10)
    SELECT label, value, round(value / (SELECT sum(value) FROM t) * 100, 4) AS share FROM t""",
)
def cht9(spark, sf_dir):
    return charts.pie(table(spark, sf_dir, "part"), "p_brand")


@query(
    "cht10_pie_grouped",
    """WITH t AS (SELECT c_mktsegment AS label, sum(c_acctbal) AS value FROM customer GROUP BY 1)
    SELECT label, round(value, 4) AS value, round(value / (SELECT sum(value) FROM t) * 100, 4) AS share FROM t""",
)
def cht10(spark, sf_dir):
    done = charts.pie(table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "c_mktsegment")
    return rounded(done, 4, "value")


def box_sql(group: bool) -> str:
    label = "event_type" if group else "'value'"
    return f"""WITH {GAPPED_EVENTS}, v AS (SELECT {label} AS label, value AS v FROM gapped WHERE value IS NOT NULL),
    q AS (SELECT label, quantile_cont(v, 0.25) q1, quantile_cont(v, 0.5) m, quantile_cont(v, 0.75) q3
      FROM v GROUP BY label),
    f AS (SELECT v.label, v, q1, m, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
      FROM v JOIN q ON q.label = v.label)"""


def box_rows_sql(group: bool) -> str:
    return box_sql(group) + """ SELECT label, count(*) AS n, round(any_value(q1), 6) AS q1,
    round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
    round(least(min(v) FILTER (v >= lower), any_value(q1)), 6) AS whisker_lo,
    round(greatest(max(v) FILTER (v <= upper), any_value(q3)), 6) AS whisker_hi,
    count(*) FILTER (v < lower OR v > upper) AS n_fliers FROM f GROUP BY label"""


BOX_NUMBERS = ("q1", "median", "q3", "whisker_lo", "whisker_hi")


@query("cht11_box", box_rows_sql(False))
def cht11(spark, sf_dir):
    return rounded(charts.box(gapped_events(spark, sf_dir), "value"), 6, *BOX_NUMBERS)


@query("cht12_box_grouped", box_rows_sql(True))
def cht12(spark, sf_dir):
    return rounded(charts.box(gapped_events(spark, sf_dir), "value", "event_type"), 6, *BOX_NUMBERS)


@query("cht12_box_fliers", box_sql(True) + " SELECT label, v AS value FROM f WHERE v < lower OR v > upper")
def cht12_fliers(spark, sf_dir):
    return charts.box_fliers(gapped_events(spark, sf_dir), "value", "event_type")
