"""The boundary, tested by trying to get around it."""

from __future__ import annotations

from pyspark.sql import functions as F

from answercheck.plans.governed import REFUSED, AccessDenied, GovernedSession, refusal
from answercheck.plans.governed_queries import fingerprint

from .conftest import fixture_views

EVASIONS = [
    "SELECT email FROM shop_customers",
    "SELECT c.email AS contact FROM shop_customers AS c",
    "SELECT (SELECT email FROM shop_customers WHERE id = 1)",
    "SELECT email FROM shop_customers WHERE 1 = 0",
    "SELECT /* comment */ email FROM  shop_customers",
    "SELECT UPPER(email) FROM shop_customers",
    "SELECT COUNT(email) FROM shop_customers",
    "select EMAIL from SHOP_CUSTOMERS",
    # Spark-specific routes
    "WITH x AS (SELECT * FROM shop_customers) SELECT id FROM x",
    "SELECT id FROM shop_customers c WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.id = length(c.email))",
    "SELECT id FROM shop_customers WHERE id IN (SELECT length(email) FROM shop_customers)",
    "SELECT id FROM shop_customers ORDER BY email",
    "SELECT country, max(email) OVER (PARTITION BY country) FROM shop_customers",
    "SELECT struct(c.*) FROM shop_customers c",
    "SELECT a.id FROM shop_customers a JOIN shop_customers b USING (id) WHERE b.email > ''",
]
WRITES = [
    "DELETE FROM shop_orders",
    "UPDATE shop_orders SET total_cents = 0",
    "DROP TABLE shop_refunds",
    "INSERT INTO shop_customers VALUES (99, 'x', 'y', 'z@x.c', DATE '2025-01-01')",
    "CREATE TABLE sneaky (id INT)",
    "ALTER TABLE shop_orders ADD COLUMN x INT",
    "WITH a AS (SELECT 1 AS x) INSERT INTO shop_orders SELECT * FROM a",
    "EXECUTE IMMEDIATE 'CREATE TEMPORARY VIEW v AS SELECT 1'",
    "SELECT TRANSFORM(id) USING 'cat' FROM shop_customers",
]
ALLOWED = [
    "SELECT name, country FROM shop_customers",
    "SELECT COUNT(*) FROM shop_orders",
    "SELECT COUNT(*) FROM shop_customers",
    "SELECT id AS email FROM shop_customers",
    "SELECT * FROM range(3)",
    "VALUES (1, 2)",
    "WITH t AS (SELECT country FROM shop_customers) SELECT country, COUNT(*) FROM t GROUP BY country",
]


def test_reads_without_the_protected_column_run(analyst):
    for sql in ALLOWED:
        out = analyst.run(sql)
        assert out.ok, (sql, out.error)
        out.df.collect()


def test_the_protected_column_is_refused_in_any_spelling(analyst):
    for sql in EVASIONS:
        out = analyst.run(sql)
        assert not out.ok and out.denied, f"not denied: {sql}"
        assert REFUSED in out.error


def test_statements_that_are_not_queries_are_refused(analyst):
    for sql in WRITES:
        out = analyst.run(sql)
        assert not out.ok and out.denied, f"write allowed: {sql}"
        assert REFUSED in out.error


def test_ungoverned_sources_are_refused(analyst):
    for sql in ["SELECT * FROM parquet.`/root/testdata/sf0.001/customer.parquet`",
                "SELECT reflect('java.lang.String', 'valueOf', 1)",
                "SELECT input_file_name() FROM shop_orders"]:
        assert not analyst.run(sql).ok, sql


def test_refused_writes_leave_counts_sums_and_fingerprints(spark, analyst):
    """Checked through a handle that existed before the attempts."""
    assert analyst.run("SELECT * FROM shop_customers").denied
    before = sorted(tuple(r) for r in fingerprint(analyst.session, "shop_orders").collect())
    for sql in WRITES:
        analyst.run(sql)
    assert analyst.session.sql("SELECT COUNT(*) FROM shop_orders").first()[0] == 9
    assert analyst.session.sql("SELECT COUNT(*) FROM shop_refunds").first()[0] == 2
    assert analyst.session.sql(
        "SELECT SUM(total_cents) FROM shop_orders WHERE status='completed'").first()[0] == 297994
    assert sorted(tuple(r) for r in fingerprint(analyst.session, "shop_orders").collect()) == before


def test_denial_can_be_switched_off(spark):
    g = GovernedSession(spark, views=fixture_views, deny_columns=False)
    assert g.run("SELECT email FROM shop_customers").ok
    assert g.run("DELETE FROM shop_orders").denied


def test_refusals_are_typed(analyst):
    try:
        analyst.sql("SELECT email FROM shop_customers")
    except AccessDenied as e:
        assert e.condition == "COLUMN_DENIED"
    else:
        raise AssertionError("not denied")


def test_logged_refusals_are_told_from_errors(spark, analyst):
    refused = analyst.run("SELECT email FROM shop_customers").error
    broken = analyst.run("SELECT totl_cents FROM shop_orders").error
    df = spark.createDataFrame([(refused,), (broken,), (None,)], "m string")
    assert [r[0] for r in df.select(refusal(F.col("m"))).collect()] == [True, False, None]


def test_whole_relations_hand_on_the_protected_column(analyst):
    for sql in ["TABLE shop_customers", "TABLE shop_customers LIMIT 2", "FROM shop_customers",
                "TABLE shop_customers UNION ALL TABLE shop_customers", "TABLE shop_customers EXCEPT TABLE shop_customers",
                "TABLE shop_customers INTERSECT TABLE shop_customers", "WITH x AS (TABLE shop_customers) TABLE x",
                "WITH x AS (TABLE shop_customers), y AS (TABLE x) SELECT id FROM y",
                "SELECT * FROM shop_orders WHERE EXISTS (TABLE shop_customers)",
                "FROM shop_customers |> WHERE id = 1", "SELECT DISTINCT * FROM (TABLE shop_customers)"]:
        out = analyst.run(sql)
        assert out.denied and out.condition == "COLUMN_DENIED", (sql, out.error)


def test_whole_relations_without_it_and_pipes_are_reads(analyst):
    for sql in ["TABLE shop_refunds", "FROM shop_orders", "SELECT id FROM (TABLE shop_customers)",
                "FROM shop_customers |> SELECT id, country |> LIMIT 2", "FROM shop_orders |> WHERE total_cents > 5 |> LIMIT 1",
                "TABLE shop_orders UNION ALL TABLE shop_orders"]:
        out = analyst.run(sql)
        assert out.ok, (sql, out.error)
        out.df.collect()


def test_functions_are_allowed_by_group(analyst):
    for sql in ["SELECT current_user()", "SELECT java_method('java.util.UUID', 'randomUUID')", "SELECT session_user()",
                "SELECT parse_url('http://a/b', 'HOST')", "SELECT id FROM shop_orders WHERE input_file_name() > ''"]:
        assert analyst.run(sql).condition == "FUNCTION_REFUSED", sql
    assert analyst.run("SELECT upper(status), count_if(id > 1), md5(status) FROM shop_orders GROUP BY status").ok


def test_row_filters_limit_what_a_tenant_sees(spark):
    g = GovernedSession(spark, views=fixture_views, row_filters={"shop_orders": "customer_id = 4"})
    assert g.sql("SELECT COUNT(*) FROM shop_orders").first()[0] == 2
    assert g.run("SELECT email FROM shop_customers").denied


def test_a_same_named_view_elsewhere_is_not_governed(spark, analyst):
    spark.createDataFrame([(1, "x@y.z")], "id long, email string").createOrReplaceGlobalTempView("shop_customers")
    out = analyst.run("SELECT id FROM global_temp.shop_customers")
    assert not out.ok and out.denied
    assert analyst.run("SELECT id FROM shop_customers").ok


def test_identifier_relations_are_refused_before_spark_runs_them(analyst):
    """IDENTIFIER(...) defers building the statement to analysis, and spark.sql runs
    commands eagerly, so the parse gate cannot tell a read from a write: every form
    is refused there, reads included (plain names work)."""
    for sql in ["INSERT INTO IDENTIFIER('shop_orders') SELECT * FROM shop_orders",
                "DROP TABLE IDENTIFIER('shop_orders')",
                "SELECT * FROM IDENTIFIER('sql_keywords')()",
                "SELECT name FROM IDENTIFIER('shop_customers')"]:
        out = analyst.run(sql)
        assert out.denied, sql
    assert analyst.run("SELECT name FROM shop_customers").ok
    assert analyst.session.sql("SELECT COUNT(*) FROM shop_orders").first()[0] == 9


def test_more_spark_routes_to_the_column_are_denied(analyst):
    for sql in ["SELECT id, e FROM shop_customers LATERAL VIEW explode(array(email)) t AS e",
                "SELECT * FROM shop_customers TABLESAMPLE (50 PERCENT)",
                "SELECT hash(*) FROM shop_customers",
                "SELECT to_json(struct(*)) FROM shop_customers",
                "SELECT count(DISTINCT *) FROM shop_customers",
                "SELECT id FROM shop_customers, LATERAL (SELECT email AS e)",
                "SELECT * FROM shop_customers PIVOT (max(email) FOR country IN ('Nigeria'))",
                "SELECT * FROM shop_customers UNPIVOT (v FOR k IN (name, email))",
                "FROM shop_customers |> SELECT email",
                "SELECT id FROM shop_customers GROUP BY id, email"]:
        assert analyst.run(sql).denied, sql
    assert analyst.run("SELECT * EXCEPT (email) FROM shop_customers").ok


def test_more_routes_past_the_views_fail(spark, analyst):
    spark.sql("SELECT 1 AS x").createOrReplaceGlobalTempView("audit_gt")
    for sql in ["SELECT * FROM global_temp.audit_gt",
                "SELECT _metadata.file_path FROM shop_orders",
                "SELECT * FROM json.`/root/testdata/sf0.001/customer.parquet`",
                "SELECT * FROM sql_keywords()",
                "SELECT java_method('java.lang.System', 'getenv', 'HOME')"]:
        assert not analyst.run(sql).ok, sql
