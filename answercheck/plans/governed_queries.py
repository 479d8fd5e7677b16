"""Registered keys for the permission boundary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import query
from ..sources.tables import SHOP_VIEWS_SQL, shop_cte, sql_session, table
from .execute import run_sql
from .governed import REFUSED, GovernedSession, Membership, refusal

# Spellings that read the protected column (all must be refused), and
# permitted reads (all must run).
EVASIONS = (
    "SELECT email FROM shop_customers",
    "SELECT c.email AS contact FROM shop_customers AS c",
    "SELECT (SELECT email FROM shop_customers WHERE id = 1)",
    "SELECT email FROM shop_customers WHERE 1 = 0",
    "SELECT /* comment */ email FROM  shop_customers",
    "SELECT UPPER(email) FROM shop_customers",
    "SELECT COUNT(email) FROM shop_customers",
    "select EMAIL from SHOP_CUSTOMERS",
    "SELECT * FROM shop_customers",
    "WITH x AS (SELECT * FROM shop_customers) SELECT id FROM x",
    "SELECT id FROM shop_customers WHERE email LIKE 'Customer%'",
    "SELECT id FROM shop_customers c WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.id = length(c.email))",
    "SELECT country, max(email) FROM shop_customers GROUP BY country",
    "SELECT id FROM shop_customers ORDER BY email LIMIT 3",
    "SELECT reflect('java.lang.String', 'valueOf', 1)",
    "SELECT current_user()",
    "TABLE shop_customers",
    "TABLE shop_customers LIMIT 2",
    "FROM shop_customers",
    "TABLE shop_customers UNION ALL TABLE shop_customers",
    "TABLE shop_customers INTERSECT TABLE shop_customers",
    "WITH x AS (TABLE shop_customers) TABLE x",
    "FROM shop_customers |> WHERE id < 5",
    "SELECT /*+ BROADCAST(c) */ c.email, o.id FROM shop_orders o JOIN shop_customers c ON c.id = o.customer_id",
    "SELECT country, email, COUNT(*) FROM shop_customers GROUP BY CUBE(country, email)",
    "SELECT country, MAX(email) FROM shop_customers GROUP BY ROLLUP(country)",
    "SELECT COUNT(*) FROM shop_customers GROUP BY GROUPING SETS ((upper(email)), ())",
    "SELECT country, COUNT(*) FROM shop_customers GROUP BY CUBE(country) HAVING MIN(email) > 'C'",
    "SELECT country, COUNT(*) FROM (SELECT * FROM shop_customers) x GROUP BY CUBE(country)",
    "SELECT id, k, spark_grouping_id FROM (TABLE shop_customers) UNPIVOT (spark_grouping_id FOR k IN (email, country))",
    "WITH RECURSIVE r AS (SELECT id, email FROM shop_customers WHERE id = 1 UNION ALL "
    "SELECT id + 1, email FROM r WHERE id < 3) SELECT id FROM r",
    "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r JOIN shop_customers c ON c.id = r.n "
    "WHERE n < 3 AND c.email <> '') SELECT n FROM r",
)
# Sources the governed session does not know at all (they fail as
# missing, like a table the role has no usage on).
HIDDEN = (
    "SELECT c_name FROM customer",
    "SELECT * FROM parquet.`/tmp/x.parquet`",
)
ALLOWED = (
    "SELECT segment, country FROM shop_customers",
    "SELECT COUNT(*) FROM shop_orders",
    "SELECT COUNT(*) FROM shop_customers",
    "SELECT id AS email FROM shop_customers",
    "SELECT c.country, SUM(o.total_cents) FROM shop_orders o JOIN shop_customers c ON c.id = o.customer_id "
    "GROUP BY c.country",
    "TABLE shop_refunds",
    "FROM shop_orders |> WHERE status = 'pending' |> SELECT id",
    "SELECT id FROM (TABLE shop_customers)",
    "SELECT /*+ BROADCAST(c) */ c.country, o.id FROM shop_orders o JOIN shop_customers c ON c.id = o.customer_id",
    "SELECT /*+ REPARTITION(3) */ country FROM shop_customers",
    "SELECT country, COUNT(*) FROM shop_customers GROUP BY CUBE(country)",
    "SELECT country, segment, COUNT(*) FROM shop_customers GROUP BY ROLLUP(country, segment)",
    "SELECT country, segment, MAX(id) FROM shop_customers GROUP BY GROUPING SETS ((country), (segment), ()) "
    "HAVING COUNT(*) > 1",
    "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 5) "
    "SELECT o.id FROM r JOIN shop_orders o ON o.id = r.n",
    "WITH RECURSIVE r AS (SELECT CAST(MIN(id) AS BIGINT) AS n FROM shop_customers UNION ALL "
    "SELECT n + 1 FROM r WHERE n < 7) SELECT n FROM r",
)
# Writes that must be refused.
WRITES = (
    "DELETE FROM shop_orders",
    "UPDATE shop_orders SET total_cents = 0",
    "DROP TABLE shop_refunds",
    "INSERT INTO shop_customers VALUES (99, 'x', 'y', 'z@x.c')",
    "CREATE TABLE sneaky (id INT)",
    "ALTER TABLE shop_orders ADD COLUMN x INT",
    "WITH a AS (SELECT 1 AS x) INSERT INTO shop_orders SELECT * FROM a",
    "EXECUTE IMMEDIATE 'CREATE TEMPORARY VIEW v AS SELECT 1'",
    "SELECT TRANSFORM(id) USING 'cat' FROM shop_customers",
    "CACHE TABLE shop_orders",
    "SET spark.sql.runSQLOnFiles = true",
)
# One statement of each kind, tried under both roles.
ATTEMPTS = (
    ("count", "SELECT COUNT(*) FROM shop_orders WHERE status = 'completed'"),
    ("open columns", "SELECT segment, country FROM shop_customers LIMIT 2"),
    ("protected column", "SELECT email FROM shop_customers"),
    ("protected column, renamed and joined",
     "SELECT c.email AS contact FROM shop_customers AS c JOIN shop_orders o ON o.customer_id = c.id "
     "WHERE o.status = 'completed'"),
    ("protected column, as a scalar", "SELECT (SELECT email FROM shop_customers WHERE id = 1)"),
    ("delete", "DELETE FROM shop_orders"),
    ("update", "UPDATE shop_orders SET total_cents = 0 WHERE 1 = 1"),
    ("drop", "DROP TABLE shop_refunds"),
)


def fingerprint(session, name: str) -> DataFrame:
    """Row count and exact sums of hashes and of every integral column, as
    DECIMAL(38,0): a BIGINT sum of hashes would overflow under ANSI."""
    df = session.table(name)
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                  F.sum(h).alias("hash_sum"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _fingerprints(session) -> list[tuple]:
    frames = [fingerprint(session, n) for n in SHOP_VIEWS_SQL]
    return sorted(tuple(r) for r in reduce(DataFrame.unionByName, frames).collect())


def _writes_oracle() -> str:
    kinds = {w: "WRITE_REFUSED" for w in WRITES}
    rows = ", ".join(f"({_text(w)}, '{c}')" for w, c in kinds.items())
    return f"""SELECT statement, TRUE AS refused, condition, TRUE AS data_unchanged
    FROM (VALUES {rows}) t(statement, condition)"""


@query("write_refusals", oracle=_writes_oracle())
def write_refusals(spark, sf_dir):
    """L1 + L8: every write is refused before it runs, and the tables read the same
    afterwards through a handle that existed before the attempts."""
    owner = sql_session(spark, sf_dir)
    gov = GovernedSession(spark, sf_dir)
    before = _fingerprints(owner)
    rows = []
    for text in WRITES:
        out = gov.run(text)
        rows.append((text, out.denied, out.condition))
    unchanged = _fingerprints(owner) == before
    return spark.createDataFrame([(t, d, c, unchanged) for t, d, c in rows],
                                 "statement string, refused boolean, condition string, data_unchanged boolean")


# What each refused spelling is refused for, where it is not the column.
_OTHER_REFUSALS = {t: "FUNCTION_REFUSED" for t in EVASIONS if "reflect" in t or "current_user" in t}


def _denials_oracle() -> str:
    """Expected outcome per statement; permitted statements are counted by running them."""
    rows = [f"SELECT {_text(t)} AS statement, 'denied' AS expected, 'denied' AS outcome, "
            f"'{_OTHER_REFUSALS.get(t, 'COLUMN_DENIED')}' AS condition, CAST(NULL AS BIGINT) AS result_rows"
            for t in EVASIONS]
    rows += [f"SELECT {_text(t)}, 'not found', 'not found', 'TABLE_OR_VIEW_NOT_FOUND', NULL" for t in HIDDEN]
    counted = {t: t for t in ALLOWED} | {
        "FROM shop_orders |> WHERE status = 'pending' |> SELECT id": "SELECT id FROM shop_orders WHERE status = 'pending'",
        "TABLE shop_refunds": "SELECT * FROM shop_refunds",
        "SELECT id FROM (TABLE shop_customers)": "SELECT id FROM shop_customers"}
    rows += [f"SELECT {_text(t)}, 'allowed', 'allowed', NULL, (SELECT COUNT(*) FROM ({counted[t]}) q)" for t in ALLOWED]
    return shop_cte() + "\nUNION ALL ".join(rows)


@query("column_denials", oracle=_denials_oracle())
def column_denials(spark, sf_dir):
    """L2 + L3: every spelling of the protected column is refused; permitted reads
    run to the end (their row counts read the whole tables)."""
    gov = GovernedSession(spark, sf_dir)
    rows = []
    cases = ([(t, "denied") for t in EVASIONS] + [(t, "not found") for t in HIDDEN]
             + [(t, "allowed") for t in ALLOWED])
    for text, expect in cases:
        out = gov.run(text)
        n = out.df.count() if out.ok else None
        got = "allowed" if out.ok else "denied" if out.denied else "not found" \
            if out.condition == "TABLE_OR_VIEW_NOT_FOUND" else "failed"
        rows.append((text, expect, got, out.condition, n))
    return spark.createDataFrame(rows, "statement string, expected string, outcome string, "
                                       "condition string, result_rows long")


# A policy over two columns of two views, and statements with what it refuses.
POLICY = (("shop_customers", "email"), ("shop_refunds", "amount_cents"))
POLICY_CASES = (
    ("SELECT id, country FROM shop_customers", ()),
    ("SELECT order_id, refunded_at FROM shop_refunds", ()),
    ("SELECT email FROM shop_customers", POLICY[:1]),
    ("SELECT SUM(amount_cents) FROM shop_refunds", POLICY[1:]),
    ("SELECT * FROM shop_refunds", POLICY[1:]),
    ("SELECT o.id FROM shop_orders o JOIN shop_refunds r ON r.order_id = o.id WHERE r.amount_cents > o.total_cents", POLICY[1:]),
    ("SELECT c.email, r.amount_cents FROM shop_customers c JOIN shop_orders o ON o.customer_id = c.id "
     "JOIN shop_refunds r ON r.order_id = o.id", POLICY),
    ("SELECT r.order_id FROM shop_refunds r WHERE EXISTS (SELECT 1 FROM shop_customers c WHERE c.id = r.order_id)", ()),
    ("SELECT order_id AS amount_cents FROM shop_refunds", ()),
)


def _column_policy_oracle() -> str:
    rows = []
    for text, hit in POLICY_CASES:
        names = ", ".join(f"{t}.{c}" for t, c in sorted(hit))
        rows.append(f"SELECT {_text(text)} AS statement, {_text(names)} AS refused_columns, " + (
            "CAST(NULL AS BIGINT) AS result_rows" if hit else f"(SELECT COUNT(*) FROM ({text}) q) AS result_rows"))
    return shop_cte() + "\nUNION ALL ".join(rows)


@query("column_policy", oracle=_column_policy_oracle())
def column_policy(spark, sf_dir):
    """T4: a policy that denies two columns of two views: each statement is refused for the
    columns it touches, all of them named, or runs over the whole tables."""
    gov = GovernedSession(spark, sf_dir, denied=POLICY)
    rows = []
    for text, _ in POLICY_CASES:
        out = gov.run(text)
        named = out.error.split("column ", 1)[1] if out.denied and out.condition == "COLUMN_DENIED" else ""
        rows.append((text, named if out.ok or out.denied else out.error, out.df.count() if out.ok else None))
    return spark.createDataFrame(rows, "statement string, refused_columns string, result_rows long")


# The views in the order in which a tenant's rows follow from one another, and the
# measure of each that the key below sums up.
TENANT_VIEWS = (("shop_customers", "id"), ("shop_orders", "total_cents"), ("shop_order_items", "qty"),
                ("shop_refunds", "amount_cents"))


def tenant_filters(sf_dir: str, tenant: str) -> dict[str, Membership]:
    """Row filters of one tenant, a region: customers of its nations by the tenant table
    (nation joined to region), their orders, and those orders' items and refunds."""
    def nations(session):
        n, r = table(session, sf_dir, "nation"), table(session, sf_dir, "region")
        return n.join(r, n["n_regionkey"] == r["r_regionkey"]).where(F.col("r_name") == tenant).select("n_name")
    return {"shop_customers": Membership("country", nations, "n_name"),
            "shop_orders": Membership("customer_id", "shop_customers", "id"),
            "shop_order_items": Membership("order_id", "shop_orders", "id"),
            "shop_refunds": Membership("order_id", "shop_orders", "id")}


def _tenants_oracle() -> str:
    owner = ("SELECT c.id, r.r_name AS tenant FROM shop_customers c JOIN nation n ON n.n_name = c.country "
             "JOIN region r ON r.r_regionkey = n.n_regionkey")
    owned = f"SELECT o.id, o.total_cents, c.tenant FROM shop_orders o JOIN ({owner}) c ON c.id = o.customer_id"
    bodies = {"shop_customers": f"SELECT tenant, id AS x FROM ({owner}) c",
              "shop_orders": f"SELECT tenant, total_cents AS x FROM ({owned}) o",
              "shop_order_items": f"SELECT o.tenant, i.qty AS x FROM shop_order_items i JOIN ({owned}) o ON o.id = i.order_id",
              "shop_refunds": f"SELECT o.tenant, f.amount_cents AS x FROM shop_refunds f JOIN ({owned}) o ON o.id = f.order_id"}
    return shop_cte() + " UNION ALL ".join(
        f"SELECT r.r_name AS tenant, '{v}' AS view_name, COUNT(x) AS visible_rows, CAST(COALESCE(SUM(x), 0) AS BIGINT) AS amount "
        f"FROM region r LEFT JOIN ({b}) b ON b.tenant = r.r_name GROUP BY r.r_name" for v, b in bodies.items())


@query("tenant_rows", oracle=_tenants_oracle())
def tenant_rows(spark, sf_dir):
    """T5: what each tenant sees of each view through a governed session of its own, one row
    per tenant and view."""
    frames = []
    # Five regions, as the schema fixes.
    for r in table(spark, sf_dir, "region").select("r_name").distinct().collect():
        gov = GovernedSession(spark, sf_dir, row_filters=tenant_filters(sf_dir, r.r_name))
        for view, amount in TENANT_VIEWS:
            seen = gov.sql(f"SELECT COUNT({amount}) AS visible_rows, CAST(COALESCE(SUM({amount}), 0) AS BIGINT) AS amount FROM {view}")
            frames.append(seen.select(F.lit(r.r_name).alias("tenant"), F.lit(view).alias("view_name"), "visible_rows", "amount"))
    return reduce(DataFrame.unionByName, frames)


def _matrix_oracle() -> str:
    def row(label, text):
        reads = text.startswith("SELECT")
        # An allowed read is one that returns its rows: count them.
        one = "(SELECT email FROM shop_customers WHERE id = 1)" in text
        owner = (f"CASE WHEN (SELECT COUNT(*) FROM ({text}) q) >= {0 if one else 1} THEN 'allowed' ELSE 'failed' END"
                 if reads else "'failed'")
        return f"SELECT '{label}' AS attempt, {owner} AS owner, " \
               f"{_text('BLOCKED' if not reads or 'email' in text else 'allowed')} AS analyst"
    return shop_cte() + "\nUNION ALL ".join(row(a, t) for a, t in ATTEMPTS)


@query("access_matrix", oracle=_matrix_oracle())
def access_matrix(spark, sf_dir):
    """Each attempt under the owner and the analyst role. The owner's session is
    unrestricted, but Spark itself cannot write into views over parquet, so the
    owner's writes fail where the reference's succeed."""
    owner = sql_session(spark, sf_dir)
    gov = GovernedSession(spark, sf_dir)
    rows = []
    for label, text in ATTEMPTS:
        o = run_sql(owner, text)
        if o.ok:
            try:
                o.df.count()
            except Exception as exc:  # noqa: BLE001
                o.error = str(exc)
        a = gov.run(text)
        rows.append((label, "allowed" if o.ok else "failed", "allowed" if a.ok else ("BLOCKED" if a.denied else "failed")))
    return spark.createDataFrame(rows, "attempt string, owner string, analyst string")


@query("governed_query", oracle=shop_cte() + """
    SELECT country, COUNT(*) AS customers, COUNT(DISTINCT segment) AS segments FROM shop_customers GROUP BY country""")
def governed_query(spark, sf_dir):
    """L4: a permitted aggregate through the governed session."""
    gov = GovernedSession(spark, sf_dir)
    return gov.sql("SELECT country, COUNT(*) AS customers, COUNT(DISTINCT segment) AS segments "
                   "FROM shop_customers GROUP BY country")


@query("refusal_classifier", oracle=f"""
    SELECT conv_id, turn, turn % 3 = 0 AS is_refusal FROM conversations""")
def refusal_classifier(spark, sf_dir):
    """L5 for logged text: which messages say that a governed session refused? Every third
    turn is logged as a refusal of that turn, the others as they stand."""
    c = table(spark, sf_dir, "conversations")
    said = F.when(F.col("turn") % 3 == 0, F.concat(F.lit(f"AccessDenied: {REFUSED}: "), F.col("text"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", refusal(said).alias("is_refusal"))


def _policy_oracle() -> str:
    columns = {"shop_customers": ("id", "segment", "country", "email"),
               "shop_orders": ("id", "customer_id", "status", "ordered_at", "shipped_at", "total_cents"),
               "shop_order_items": ("id", "order_id", "product", "qty", "unit_cents"),
               "shop_refunds": ("order_id", "amount_cents", "refunded_at")}
    rows = ["SELECT '*' AS table_name, '*' AS column_name, 'read_only' AS rule, CAST(NULL AS BIGINT) AS readable_values"]
    rows += [f"SELECT '{t}', '{c}', 'allow', COUNT({c}) FROM {t}" if (t, c) != ("shop_customers", "email")
             else f"SELECT '{t}', '{c}', 'deny', NULL" for t, cs in columns.items() for c in cs]
    return shop_cte() + "\nUNION ALL ".join(rows)


@query("policy_listing", oracle=_policy_oracle())
def policy_listing(spark, sf_dir):
    """The boundary as a table: every governed column with its rule, and how many
    values of it the analyst can actually read (counted through the governed session,
    one aggregate per view; NULL where the rule denies the column)."""
    gov = GovernedSession(spark, sf_dir)
    frames = []
    for view in sorted(gov.views):
        cols = gov.session.table(view).columns
        allowed = [c for c in cols if (view, c.lower()) not in gov.denied]
        counts = gov.sql(f"SELECT {', '.join(f'COUNT({c}) AS {c}' for c in allowed)} FROM {view}")
        frames.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(view).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit("deny" if c not in allowed else "allow").alias("rule"),
                     (F.col(c) if c in allowed else F.lit(None).cast("long")).alias("readable_values"))
            for c in cols])).alias("x")).select("x.*"))
    listing = reduce(DataFrame.unionByName, frames)
    whole = spark.createDataFrame([("*", "*", "read_only", None)],
                                  "table_name string, column_name string, rule string, readable_values long")
    return whole.unionByName(listing)


@query("table_fingerprint", oracle=shop_cte() + """
    SELECT 'shop_customers' AS table_name, COUNT(*) AS row_count, SUM(CAST(id AS DECIMAL(38, 0))) AS key_sum,
           CAST(NULL AS DECIMAL(38, 0)) AS amount_sum FROM shop_customers
    UNION ALL SELECT 'shop_orders', COUNT(*), SUM(CAST(id AS DECIMAL(38, 0))), SUM(CAST(total_cents AS DECIMAL(38, 0)))
    FROM shop_orders
    UNION ALL SELECT 'shop_order_items', COUNT(*), SUM(CAST(order_id AS DECIMAL(38, 0))),
           SUM(CAST(qty * unit_cents AS DECIMAL(38, 0))) FROM shop_order_items
    UNION ALL SELECT 'shop_refunds', COUNT(*), SUM(CAST(order_id AS DECIMAL(38, 0))),
           SUM(CAST(amount_cents AS DECIMAL(38, 0))) FROM shop_refunds""")
def table_fingerprint(spark, sf_dir):
    """L8 in SQL terms: per shop table, row count and exact key and amount sums."""
    s = sql_session(spark, sf_dir)
    dec = "decimal(38,0)"

    def fp(name, key, amount):
        df = s.table(name)
        amt = F.sum(F.expr(amount).cast(dec)) if amount else F.lit(None).cast(dec)
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                      F.sum(F.col(key).cast(dec)).alias("key_sum"), amt.alias("amount_sum"))
    frames = [fp("shop_customers", "id", None), fp("shop_orders", "id", "total_cents"),
              fp("shop_order_items", "order_id", "qty * unit_cents"), fp("shop_refunds", "order_id", "amount_cents")]
    return reduce(DataFrame.unionByName, frames)
