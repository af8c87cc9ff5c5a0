import pytest

from tabscope.operators import adhoc
from tabscope.operators.adhoc import safe_query, safe_query_count

REFUSED = [
    "SELECT 1; SELECT 2",
    "DROP TABLE df",
    "CREATE TABLE x AS SELECT * FROM df",
    "INSERT INTO df VALUES (1)",
    "SET spark.sql.ansi.enabled=false",
    "CACHE TABLE df",
    "import os",
    "SELECT reflect('java.lang.System', 'exit', 0) FROM df",
    "SELECT java_method ('java.util.UUID', 'randomUUID') FROM df",
    "SELECT try_reflect('java.util.UUID', 'randomUUID') FROM df",
    "SELECT TRANSFORM(name) USING 'cat' AS (n) FROM df",
    "SELECT TRANSFORM(name) USING/**/'cat' AS (n) FROM df",
    "SELECT * FROM csv.`/etc/passwd`",
    "SELECT * FROM text.`/etc/passwd`",
    "SELECT `reflect`('java.lang.Math', 'abs', -1) FROM df",
    "SELECT reflect/**/('java.lang.System', 'getProperty', 'user.name') FROM df",
    "SELECT IDENTIFIER('ref' || 'lect')('java.lang.Math', 'abs', -1) FROM df",
    "SELECT * FROM IDENTIFIER('secret_' || 'other')",
    "SELECT * FROM secret_other",
    "SELECT * FROM df WHERE EXISTS (SELECT 1 FROM secret_other)",
    "WITH a AS (SELECT * FROM secret_other) SELECT * FROM a",
    "SELECT * FROM global_temp.anything",
    "SELECT nope FROM df",
    "SELEC * FROM df",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(spark, people, sql):
    spark.range(1).createOrReplaceTempView("secret_other")
    with pytest.raises(ValueError):
        safe_query(spark, people, sql)


def test_documented_shapes(spark, people):
    assert safe_query(spark, people, "SELECT * FROM df WHERE salary > 65000").count() == 3
    sums = safe_query(spark, people, "SELECT city, sum(salary) AS s FROM df GROUP BY city").collect()
    assert {r["city"]: r["s"] for r in sums}["Beijing"] == 120000
    top = safe_query(spark, people, "SELECT name, salary FROM df ORDER BY salary DESC LIMIT 2 -- rich")
    assert [r["name"] for r in top.collect()] == ["David", "Eve"]


def test_cap(spark):
    many = spark.range(250)
    assert safe_query(spark, many, "SELECT * FROM df").count() == 100
    assert safe_query(spark, many, "SELECT * FROM df", limit=None).count() == 250
    assert safe_query_count(spark, many, "SELECT * FROM df").first().asDict() == {"row_count": 250, "truncated": True}
    assert safe_query_count(spark, many, "SELECT * FROM df WHERE id < 5").first().asDict() == {"row_count": 5, "truncated": False}


def test_harmless_text(spark, people):
    assert safe_query(spark, people, "SELECT 'a;b' AS x, 'paid using card' AS y, 'reflect(' AS z FROM df").count() == 5
    assert safe_query(spark, people, "WITH old AS (SELECT * FROM df WHERE age > 30) SELECT count(*) AS n FROM old").first()["n"] == 2


def test_views_are_restored(spark, people):
    spark.range(3).createOrReplaceTempView("df")
    assert safe_query(spark, people, "SELECT * FROM df").count() == 5
    with pytest.raises(ValueError):
        safe_query(spark, people, "SELECT nope FROM df")
    assert spark.table("df").count() == 3
    spark.catalog.dropTempView("df")
    safe_query(spark, people, "SELECT * FROM df")
    assert not spark.catalog.tableExists("df")


def test_several_tables(spark, people):
    cities = spark.createDataFrame([("Beijing", "north")], "city string, region string")
    for sql in ("SELECT p.name FROM p LEFT SEMI JOIN c ON p.city = c.city",
                "SELECT name, region FROM p JOIN c USING (city)"):
        assert safe_query(spark, {"p": people, "c": cities}, sql).count() == 2


OUTSIDE = [
    "SELECT * FROM (WITH other AS (SELECT 1 AS a) SELECT * FROM other) x, other",
    "SELECT * FROM other, (WITH other AS (SELECT 1 AS a) SELECT * FROM other) x",
    "WITH a AS (SELECT * FROM other), other AS (SELECT 1 AS x) SELECT * FROM a",
    "WITH other AS (SELECT * FROM other) SELECT * FROM other",
    "SELECT (WITH other AS (SELECT 1 AS a) SELECT max(a) FROM other) AS m FROM other",
    "SELECT * FROM df WHERE EXISTS (WITH other AS (SELECT 1) SELECT * FROM other) AND 1 IN (SELECT secret FROM other)",
    "WITH a AS (WITH other AS (SELECT 1 AS secret) SELECT * FROM other) SELECT * FROM a UNION ALL SELECT * FROM other",
    "SELECT * FROM df UNION ALL (WITH `OTHER` AS (SELECT 1) SELECT * FROM Other) UNION ALL SELECT * FROM OTHER",
    "SELECT * FROM df LATERAL JOIN (SELECT * FROM other)",
]
INSIDE = [
    "WITH a AS (SELECT 1 AS x), b AS (SELECT * FROM a) SELECT * FROM b, A",
    "WITH a AS (SELECT 1 AS x) SELECT * FROM (WITH b AS (SELECT * FROM a) SELECT * FROM b, a) q",
    "WITH other AS (SELECT 5 AS x) SELECT * FROM other WHERE x IN (SELECT x FROM other)",
    "WITH df AS (SELECT 1 AS x) SELECT * FROM df",
    "WITH other AS (SELECT * FROM df), d AS (WITH other AS (SELECT * FROM other) SELECT * FROM other) SELECT * FROM d, other",
    "SELECT * FROM range(3)",
]


@pytest.mark.parametrize("sql", OUTSIDE)
def test_with_names_hold_only_where_they_are_seen(spark, sql):
    spark.sql("SELECT 42 AS secret").createOrReplaceTempView("other")
    try:
        with pytest.raises(ValueError, match="rejected"):
            adhoc.checked_query(spark, spark.range(2), sql)
    finally:
        spark.catalog.dropTempView("other")


@pytest.mark.parametrize("sql", INSIDE)
def test_nested_and_shadowed_names(spark, sql):
    spark.sql("SELECT 42 AS secret").createOrReplaceTempView("other")
    try:
        rows = adhoc.checked_query(spark, spark.range(2), sql).collect()
        assert rows and all(42 not in r for r in rows)
    finally:
        spark.catalog.dropTempView("other")


def test_recursive_names(spark):
    sql = "WITH RECURSIVE t AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM t WHERE n < 4) SELECT * FROM t"
    assert sorted(r[0] for r in adhoc.checked_query(spark, spark.range(1), sql).collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="rejected"):
        adhoc.checked_query(spark, spark.range(1), f"SELECT * FROM ({sql}) UNION ALL SELECT * FROM t")
