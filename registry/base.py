"""Collects the registered queries and the tables they derive their inputs from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- lineitem with discounts unknown for returned lines -----------------------------------


def gapped_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(
        "l_discount", F.expr("CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END")
    )


GAPPED_LINEITEM = """gapped AS (
  SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS l_discount)
  FROM lineitem)"""


def gapped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "value", F.expr("CASE WHEN event_type = 'signup' THEN NULL ELSE value END")
    )


GAPPED_EVENTS = """gapped AS (
  SELECT * REPLACE (CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS value)
  FROM events)"""

# --- spans: every event is a span of its user's trace -------------------------------------

# microseconds since 1970 of a timestamp without time zone, whatever the session's zone
_MICROS = (
    "(datediff(date(ts), date'1970-01-01') * 86400000000L + hour(ts) * 3600000000L "
    "+ minute(ts) * 60000000L + bigint(extract(second from ts) * 1000000))"
)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS trace_id",
        "event_id AS seq",
        "event_type AS node_name",
        f"double({_MICROS}) / 1000000D AS start_time",
        f"double({_MICROS}) / 1000000D + value * 1.0471975512D / 1000D AS end_time",
        "value * 1.0471975512D AS duration_ms",
        "CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status",
        "CASE WHEN event_type = 'error' THEN props END AS error",
    )


SPANS = """spans AS (
  SELECT user_id AS trace_id, event_id AS seq, event_type AS node_name,
         epoch_us(ts)::DOUBLE / 1000000::DOUBLE AS start_time,
         epoch_us(ts)::DOUBLE / 1000000::DOUBLE + value * 1.0471975512::DOUBLE / 1000::DOUBLE AS end_time,
         value * 1.0471975512::DOUBLE AS duration_ms,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         CASE WHEN event_type = 'error' THEN props END AS error
  FROM events)"""


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(f"`{n}`"), digits) for n in names})
