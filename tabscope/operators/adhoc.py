"""Read-only, size-capped SQL over named tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_CAP = 100

# functions that leave SQL for any method of the virtual machine
_REFLECTIVE = {"reflect", "java_method", "try_reflect"}


def _parts(node, scope: frozenset[str], fold: Callable[[str], str]):
    """A parsed query's nodes with the WITH names that each of them sees: plans, expressions, and what
    is nested in them.

    A WITH list's names are seen by the plan below it and by its own later entries, by an entry itself
    only if the list is recursive, and nowhere else.
    """
    waiting = [(node, scope)]
    while waiting:
        this, seen = waiting.pop()
        if not isinstance(this, JavaObject):
            continue
        kind = this.getClass().getName()
        if kind.startswith(("scala.collection.", "scala.Some")):
            waiting += [(each, seen) for each in _sequence(this)]
        elif kind.startswith(("scala.Tuple", "org.apache.spark.sql.catalyst.")):
            name = kind.rpartition(".")[2]
            yield name, this, seen
            if name == "UnresolvedWith":
                for entry in _sequence(this.cteRelations()):
                    own = seen | {fold(entry.productElement(0))}
                    waiting.append((entry.productElement(1), own if this.allowRecursion() else seen))
                    seen = own
                waiting.append((this.child(), seen))
                continue
            try:
                waiting += [(this.productElement(i), seen) for i in range(this.productArity())]
            except Py4JError:  # no case class, so nothing is nested in it
                pass


def _sequence(items) -> list:
    each, found = items.iterator(), []
    while each.hasNext():
        found.append(each.next())
    return found


def _check(spark: SparkSession, sql: str, allowed: set[str]) -> None:
    """Refuses all that a parsed query could reach but the given tables, before it is analysed."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if sensitive else str.lower
    given = frozenset(fold(name) for name in allowed)
    for kind, node, seen in _parts(plan, given, fold):
        if kind == "UnresolvedRelation":
            parts = _sequence(node.multipartIdentifier())
            if len(parts) != 1 or fold(parts[0]) not in seen:
                raise ValueError(f"query rejected: {'.'.join(parts)} is not a given table")
        elif kind == "UnresolvedFunction" and _sequence(node.nameParts())[-1].lower() in _REFLECTIVE:
            raise ValueError("query rejected: reflection")
        elif kind in ("ScriptTransformation", "PlanWithUnresolvedIdentifier", "ExpressionWithUnresolvedIdentifier"):
            raise ValueError(f"query rejected: {kind}")


def checked_query(
    spark: SparkSession, tables: DataFrame | Mapping[str, DataFrame], sql: str
) -> DataFrame:
    """The whole result of one read-only query; a single table is named ``df``.

    The query must parse inside a subquery, which refuses every statement that is not a
    query, and chained ones. What it names is decided on the parsed plan: a relation must be one of the
    given tables or a WITH name that is seen where it stands, and scripts, reflection and computed names are
    refused however they are spelled. Table functions that make rows out of their arguments, such as
    ``range``, may be called, and so may functions that the caller has registered in the session.
    Views of the caller's that have the same names are put back.
    """
    named = {"df": tables} if isinstance(tables, DataFrame) else dict(tables)
    whole = f"SELECT * FROM (\n{sql}\n)"
    earlier: dict[str, DataFrame] = {}
    try:
        _check(spark, whole, set(named))
        earlier = {n: spark.table(n) for n in named if _is_view(spark, n)}
        for name, table in named.items():
            table.createOrReplaceTempView(name)
        return spark.sql(whole)
    except (ParseException, AnalysisException) as exc:
        raise ValueError(f"query rejected: {exc}") from exc
    finally:
        for name in named:
            if name in earlier:
                earlier[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    return any(t.isTemporary and t.name == name.lower() for t in spark.catalog.listTables(pattern=name))


def safe_query(
    spark: SparkSession,
    tables: DataFrame | Mapping[str, DataFrame],
    sql: str,
    limit: int | None = RESULT_CAP,
) -> DataFrame:
    """The first ``limit`` rows (100 unless changed, all of them for None)."""
    result = checked_query(spark, tables, sql)
    return result if limit is None else result.limit(limit)


def safe_query_count(
    spark: SparkSession,
    tables: DataFrame | Mapping[str, DataFrame],
    sql: str,
    limit: int = RESULT_CAP,
) -> DataFrame:
    """``row_count, truncated`` of the whole result."""
    counted = checked_query(spark, tables, sql).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("row_count", (F.col("row_count") > limit).alias("truncated"))
