"""What the guard lets through, and what it does with it."""

import pytest

from basketry.operators.guard import QueryDenied, guarded_query, open_guard
from basketry.schema import COUNTRY, FACT


@pytest.fixture(scope="module")
def guard(spark):
    def register(session):
        session.range(500).selectExpr(
            "id AS invoice_no", "concat('C', id % 5) AS country", "id AS total_line_price"
        ).createOrReplaceTempView(FACT)
        session.range(5).selectExpr(
            "concat('C', id) AS country", "id * 10 AS net_revenue"
        ).createOrReplaceTempView(COUNTRY)
        session.range(3).createOrReplaceTempView("secret")
        session.sql("CREATE TEMPORARY FUNCTION peek() RETURNS BIGINT RETURN (SELECT max(id) FROM secret)")
        session.udf.register("py_peek", lambda x: x, "bigint")

    return open_guard(spark, register)


ACCEPTED = [
    f"SELECT country FROM {COUNTRY}",
    f"SELECT country FROM {COUNTRY};",
    f"SELECT DISTINCT country FROM {FACT.upper()} ORDER BY country DESC LIMIT 3 OFFSET 1",
    f"(SELECT country FROM {COUNTRY})",
    f"SELECT country, sum(total_line_price) AS s FROM {FACT} GROUP BY country HAVING s > 1",
    f"SELECT f.invoice_no FROM {FACT} f JOIN {COUNTRY} c ON f.country = c.country",
    f"SELECT invoice_no FROM {FACT} LEFT JOIN {COUNTRY} USING (country)",
    f"SELECT f.invoice_no FROM {FACT} f FULL JOIN {COUNTRY} c ON f.country = c.country",
    f"SELECT country FROM (SELECT country FROM {FACT} UNION SELECT country FROM {COUNTRY}) u",
    f"SELECT country FROM {FACT} WHERE country IN (SELECT country FROM {COUNTRY})",
    f"WITH top AS (SELECT country FROM {COUNTRY}) SELECT country FROM top",
    f"WITH a AS (SELECT country FROM {COUNTRY}), b AS (SELECT * FROM a) SELECT country FROM b",
    f"SELECT invoice_no, rank() OVER w AS r FROM {FACT} WINDOW w AS (ORDER BY invoice_no)",
    f"SELECT CASE WHEN country = 'DROP TABLE x' THEN 1 ELSE 0 END AS flag FROM {COUNTRY}",
    "SELECT 1 AS one",
]

DENIED = [
    ("G1", f"SELECT 1 FROM {FACT}; DROP TABLE {FACT}"),
    ("G1", "SELEC 1"),
    ("G1", ""),
    ("G2", f"DROP TABLE {FACT}"),
    ("G2", f"INSERT INTO {FACT} VALUES (1)"),
    ("G2", f"CREATE TABLE t AS SELECT 1 AS a FROM {FACT}"),
    ("G2", f"DELETE FROM {FACT}"),
    ("G2", "SET spark.sql.ansi.enabled=false"),
    ("G2", "SHOW TABLES"),
    ("G2", f"SELECT country FROM {FACT} UNION SELECT country FROM {COUNTRY}"),
    ("G2", f"SELECT country FROM {FACT} UNION ALL SELECT country FROM {COUNTRY} LIMIT 3"),
    ("G2", f"SELECT country FROM {FACT} INTERSECT SELECT country FROM {COUNTRY}"),
    ("G2", f"SELECT country FROM {FACT} EXCEPT SELECT country FROM {COUNTRY}"),
    ("G2", f"VALUES (1)"),
    ("G2", f"TABLE {FACT}"),
    ("G2", f"SELECT TRANSFORM(country) USING 'cat' FROM {FACT}"),
    ("G2", f"SELECT /*+ BROADCAST({FACT}) */ country FROM {FACT}"),
    ("G2", f"SELECT country FROM {FACT} TABLESAMPLE (10 PERCENT)"),
    ("G2", f"SELECT reflect('java.lang.System', 'getProperty', country) AS p FROM {FACT}"),
    ("G2", f"SELECT country FROM {FACT} WHERE java_method('a', 'b') = 'x'"),
    ("G2", f"SELECT peek() AS p FROM {FACT}"),
    ("G2", f"SELECT default.peek() AS p FROM {FACT}"),
    ("G2", f"SELECT py_peek(invoice_no) AS p FROM {FACT}"),
    ("G2", f"SELECT country FROM {FACT} WHERE peek() > 1"),
    ("G2", f"SELECT country FROM {FACT} ORDER BY peek()"),
    ("G2", f"SELECT sum(peek()) OVER (PARTITION BY country) AS p FROM {FACT}"),
    ("G2", f"SELECT f.country FROM {FACT} f JOIN {COUNTRY} c ON f.country = c.country AND peek() = 1"),
    ("G3", f"WITH RECURSIVE r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r) SELECT n FROM r"),
    ("G4", "SELECT id FROM secret"),
    ("G4", f"SELECT country FROM other.{FACT}"),
    ("G4", f"SELECT country FROM {FACT} WHERE invoice_no IN (SELECT id FROM secret)"),
    ("G4", f"SELECT (SELECT max(id) FROM secret) AS m FROM {FACT}"),
    ("G4", f"SELECT country FROM {FACT} WHERE EXISTS (SELECT 1 FROM secret)"),
    ("G4", "WITH secret AS (SELECT * FROM secret) SELECT id FROM secret"),
    (
        "G4",
        f"SELECT s.id FROM secret s JOIN (WITH secret AS (SELECT country FROM {FACT}) "
        "SELECT country FROM secret) t ON s.id = t.country",
    ),
    ("G4", "SELECT id FROM range(10)"),
    ("G4", "SELECT a FROM parquet.`/tmp/x`"),
    ("G5", f"SELECT 1 AS a FROM {FACT} a JOIN {FACT} b ON a.invoice_no < b.invoice_no"),
    ("G5", f"SELECT 1 AS a FROM {FACT} a JOIN {FACT} b ON a.country = 'x'"),
    ("G5", f"SELECT 1 AS a FROM {FACT} a JOIN {FACT} b ON a.country = a.country"),
    ("G5", f"SELECT 1 AS a FROM {FACT} a JOIN {FACT} b ON a.country = b.country OR a.invoice_no = 1"),
    ("G5", f"SELECT 1 AS a FROM {FACT} CROSS JOIN {COUNTRY}"),
    ("G5", f"SELECT 1 AS a FROM {FACT}, {COUNTRY}"),
    ("G5", f"SELECT 1 AS a FROM {FACT} NATURAL JOIN {COUNTRY}"),
    ("G5", f"SELECT 1 AS a FROM {FACT} JOIN {COUNTRY}"),
    ("G5", f"SELECT 1 AS a FROM (SELECT 1 AS b FROM {FACT}, {COUNTRY}) t"),
]


@pytest.mark.parametrize("sql", ACCEPTED)
def test_accepted(guard, sql):
    assert 0 < len(guard.query(sql).collect()) <= 100


@pytest.mark.parametrize("rule, sql", DENIED)
def test_denied(guard, rule, sql):
    with pytest.raises(QueryDenied) as denied:
        guard.query(sql)
    assert denied.value.rule == rule
    assert guard.query_or_error(sql).startswith(f"Error: {rule}")


def test_nothing_denied_was_run(guard):
    assert guard.query(f"SELECT count(*) AS n FROM {FACT}").first()["n"] == 500


@pytest.mark.parametrize("limit, rows", [("", 100), ("LIMIT 7", 7), ("LIMIT 150", 100), ("LIMIT 100", 100)])
def test_row_cap(guard, limit, rows):
    assert guard.query(f"SELECT invoice_no FROM {FACT} {limit}").count() == rows


def test_the_cap_keeps_the_top_rows(guard):
    top = guard.query(f"SELECT invoice_no FROM {FACT} ORDER BY invoice_no DESC LIMIT 150").collect()
    assert [r[0] for r in top] == list(range(499, 399, -1))


def test_a_condition_that_joins_nothing_is_refused(guard):
    with pytest.raises(QueryDenied, match="G5"):
        guard.query(f"SELECT 1 AS a FROM {FACT} JOIN {COUNTRY} ON 1 = 1")


def test_unknown_columns_come_back_as_text(guard):
    assert guard.query_or_error(f"SELECT nope FROM {FACT}").startswith("Error: ")


def test_the_catalogue_shows_the_allowed_tables_only(guard):
    assert {tuple(r) for r in guard.catalogue().collect()} == {
        (FACT, "invoice_no", "bigint"),
        (FACT, "country", "string"),
        (FACT, "total_line_price", "bigint"),
        (COUNTRY, "country", "string"),
        (COUNTRY, "net_revenue", "bigint"),
    }


def test_the_callers_session_keeps_its_settings(spark, guard):
    assert spark.conf.get("spark.sql.crossJoin.enabled") == "true"
    assert spark.range(2).crossJoin(spark.range(2)).count() == 4


def test_tables_of_the_current_database_need_no_registration(spark):
    spark.sql("CREATE DATABASE guarded_lake")
    spark.catalog.setCurrentDatabase("guarded_lake")
    try:
        spark.range(3).selectExpr("id AS country").write.saveAsTable(COUNTRY)
        spark.sql(f"CREATE VIEW {FACT} AS SELECT country AS invoice_no FROM {COUNTRY}")
        assert guarded_query(spark, f"SELECT country FROM {COUNTRY}", max_rows=2).count() == 2
        assert guarded_query(spark, f"SELECT invoice_no FROM {FACT}").count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_errors_of_a_run_come_as_text(guard):
    assert guard.query_or_error(f"SELECT 1 / 0 AS x FROM {FACT}").startswith("Error: ")
    assert guard.query_or_error("DROP TABLE secret").startswith("Error: G2")
    assert guard.query_or_error(f"SELECT country FROM {COUNTRY}").count() == 5


@pytest.mark.parametrize(
    "sql",
    [
        f"SELECT net_revenue FROM {FACT} JOIN {COUNTRY} c ON total_line_price = net_revenue - net_revenue + total_line_price AND {FACT}.country = c.country",
        f"SELECT net_revenue FROM {FACT} JOIN (SELECT country AS place, net_revenue FROM {COUNTRY}) ON country = place",
        f"SELECT net_revenue FROM {FACT} JOIN (SELECT country AS place, net_revenue FROM {COUNTRY}) ON place = upper(country) OR false",
        f"WITH p AS (SELECT country AS place, net_revenue FROM {COUNTRY}) SELECT net_revenue FROM {FACT} JOIN p ON place <=> country",
        f"SELECT 1 AS a FROM {FACT} WHERE country IN (SELECT place FROM {COUNTRY} c JOIN (SELECT country AS place FROM {FACT}) ON place = c.country)",
    ],
)
def test_joins_may_name_columns_alone(guard, sql):
    if sql.endswith("false"):
        with pytest.raises(QueryDenied, match="G5"):
            guard.query(sql)
    else:
        assert guard.query(sql).count() > 0


@pytest.mark.parametrize(
    "sql",
    [
        # The last table is joined by nothing.
        f"SELECT 1 AS a FROM {FACT} a JOIN {COUNTRY} b ON a.country = b.country JOIN {COUNTRY} c ON a.country = b.country",
        f"SELECT 1 AS a FROM {FACT} a JOIN {COUNTRY} b ON invoice_no = total_line_price",
        f"SELECT 1 AS a FROM {FACT} a JOIN {COUNTRY} b ON a.country = concat(a.country, b.country)",
        f"SELECT 1 AS a FROM {FACT} WHERE EXISTS (SELECT 1 FROM {FACT} b JOIN {COUNTRY} c ON b.country > c.country)",
    ],
)
def test_equalities_within_one_side_join_nothing(guard, sql):
    with pytest.raises(QueryDenied, match="G5"):
        guard.query(sql)


def test_views_may_join_as_they_like(spark):
    def register(session):
        session.range(3).createOrReplaceTempView("few")
        session.sql("SELECT a.id AS invoice_no FROM few a JOIN few b ON a.id < b.id").createOrReplaceTempView(FACT)

    assert open_guard(spark, register).query(f"SELECT invoice_no FROM {FACT}").count() == 3


def test_theta_joins_may_be_permitted(spark):
    def register(session):
        session.range(4).selectExpr("id AS invoice_no").createOrReplaceTempView(FACT)

    sql = f"SELECT a.invoice_no FROM {FACT} a JOIN {FACT} b ON a.invoice_no < b.invoice_no"
    assert open_guard(spark, register, theta_joins=True).query(sql).count() == 6
