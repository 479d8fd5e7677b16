"""The relational questions of the suite, on the driver's tables (groups B-I, N2-N6).

Every query names the shop concept it answers and is written against the raw tables
with the ruling from ``sources.tables``, so that status filters and date ranges reach
the parquet scan. Where a join would only multiply rows before an aggregate, the child
is aggregated first (eager aggregation): the shuffle then carries one partial row per
key and map task instead of every line, and a hot key collapses map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources.tables import cents, shop_orders, small, status_is, table, REFUND_FLAG

# Fixed values of the ruling for period questions: the month the suite asks about.
MONTH_START = "1998-03-01"
MONTH_END = "1998-04-01"
# Fixed value: the nation the lookup question asks about.
LOOKUP_NATION = "NATION_7"

_CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"


def completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(status_is("completed"))


def _ts(day: str):
    return F.lit(day).cast("timestamp_ntz")


# --- D1 / M4 / N2 -----------------------------------------------------------------

@query("total_revenue", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders WHERE o_orderstatus = 'F'""")
def total_revenue(spark, sf_dir):
    return completed_orders(spark, sf_dir).agg(
        F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents"))


@query("sum_of_nothing", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents,
           COUNT(*) AS orders_counted,
           CAST(COALESCE(SUM({_CENTS}), 0) AS BIGINT) AS revenue_or_zero
    FROM orders WHERE o_orderdate < TIMESTAMP '1900-01-01 00:00:00'""")
def sum_of_nothing(spark, sf_dir):
    """SUM over zero rows is NULL, not 0; COUNT is 0; COALESCE gives the 0."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < _ts("1900-01-01"))
    c = cents(F.col("o_totalprice"))
    return o.agg(F.sum(c).alias("revenue_cents"), F.count(F.lit(1)).alias("orders_counted"),
                 F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias("revenue_or_zero"))


# --- B1, B6, B9, B8 ---------------------------------------------------------------

@query("project_columns", oracle="""
    SELECT c_custkey AS id, c_mktsegment AS segment, c_nationkey AS nation_key FROM customer""")
def project_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"))


@query("filter_equality", oracle=f"""
    SELECT o_orderkey AS id, {_CENTS} AS total_cents FROM orders WHERE o_orderstatus = 'F'""")
def filter_equality(spark, sf_dir):
    return completed_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"), cents(F.col("o_totalprice")).alias("total_cents"))


@query("filter_negated_or", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents FROM orders
    WHERE NOT (o_orderstatus = 'P' OR o_orderstatus = 'O')""")
def filter_negated_or(spark, sf_dir):
    """NOT (cancelled OR pending): the same rows as completed on a closed domain."""
    s = F.col("o_orderstatus")
    return (table(spark, sf_dir, "orders").where(~((s == "P") | (s == "O")))
            .agg(F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents")))


@query("revenue_with_pending", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents FROM orders
    WHERE o_orderstatus IN ('F', 'O')""")
def revenue_with_pending(spark, sf_dir):
    return (table(spark, sf_dir, "orders").where(status_is("completed", "pending"))
            .agg(F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents")))


# --- B7 / N4, B11 / N5, B10 / N7 ----------------------------------------------------

@query("month_revenue_ordered", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '{MONTH_START} 00:00:00'
      AND o_orderdate < TIMESTAMP '{MONTH_END} 00:00:00'""")
def month_revenue_ordered(spark, sf_dir):
    """Revenue booked on the order date, half-open month; both bounds push down."""
    d = F.col("o_orderdate")
    return (completed_orders(spark, sf_dir)
            .where((d >= _ts(MONTH_START)) & (d < _ts(MONTH_END)))
            .agg(F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents")))


def first_ship(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """One row per order that has lines: its first ship date (the ruling's shipped_at).

    ``before`` keeps orders first shipped before that day: later lines cannot bring a
    minimum below it, so they are filtered in the scan and the minimum stays right."""
    li = table(spark, sf_dir, "lineitem")
    if before is not None:
        li = li.where(F.col("l_shipdate") < _ts(before))
    return (li.groupBy("l_orderkey")
            .agg(F.min("l_shipdate").cast("date").alias("shipped_at")))


@query("month_revenue_shipped", oracle=f"""
    SELECT CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders o JOIN (SELECT l_orderkey, CAST(MIN(l_shipdate) AS DATE) AS shipped_at
                        FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey
    WHERE o.o_orderstatus = 'F' AND s.shipped_at >= DATE '{MONTH_START}'
      AND s.shipped_at < DATE '{MONTH_END}'""")
def month_revenue_shipped(spark, sf_dir):
    """Revenue booked on the ship date. Unshipped orders (no lines) have no date and
    fall out of the range, as NULL does in any comparison."""
    s = F.col("shipped_at")
    shipped = first_ship(spark, sf_dir, before=MONTH_END).where(s >= F.lit(MONTH_START).cast("date"))
    o = completed_orders(spark, sf_dir)
    return (o.join(shipped, o.o_orderkey == shipped.l_orderkey)
            .agg(F.sum(cents(F.col("o_totalprice"))).alias("revenue_cents")))


@query("month_straddlers", oracle=f"""
    SELECT o.o_orderkey AS id, {_CENTS} AS total_cents, CAST(o.o_orderdate AS DATE) AS ordered_at,
           s.shipped_at
    FROM orders o JOIN (SELECT l_orderkey, CAST(MIN(l_shipdate) AS DATE) AS shipped_at
                        FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey
    WHERE o.o_orderdate < TIMESTAMP '{MONTH_END} 00:00:00' AND s.shipped_at >= DATE '{MONTH_END}'""")
def month_straddlers(spark, sf_dir):
    """Orders placed before the boundary and shipped on or after it: the rows that
    make the two period rulings disagree."""
    boundary = F.lit(MONTH_END).cast("date")
    shipped = first_ship(spark, sf_dir).where(F.col("shipped_at") >= boundary)
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < _ts(MONTH_END))
    return o.join(shipped, o.o_orderkey == shipped.l_orderkey).select(
        F.col("o_orderkey").alias("id"), cents(F.col("o_totalprice")).alias("total_cents"),
        F.col("o_orderdate").cast("date").alias("ordered_at"), F.col("shipped_at"))


# --- C1 / D2, D3 --------------------------------------------------------------------

@query("revenue_by_country", oracle=f"""
    SELECT n.n_name AS country, CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE o.o_orderstatus = 'F' GROUP BY n.n_name""")
def revenue_by_country(spark, sf_dir):
    """Orders are summed per customer before the customer join, so the join and its
    shuffle see one row per customer instead of one per order; nation (25 rows) is
    broadcast."""
    per_cust = (completed_orders(spark, sf_dir).groupBy("o_custkey")
                .agg(F.sum(cents(F.col("o_totalprice"))).alias("cents")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = small(spark, sf_dir, "nation")
    return (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == n.n_nationkey)
            .groupBy(F.col("n_name").alias("country"))
            .agg(F.sum("cents").alias("revenue_cents")))


@query("count_pending", oracle="""
    SELECT COUNT(*) AS pending_orders FROM orders WHERE o_orderstatus = 'O'""")
def count_pending(spark, sf_dir):
    return (table(spark, sf_dir, "orders").where(status_is("pending"))
            .agg(F.count(F.lit(1)).alias("pending_orders")))


@query("count_customers_in_nation", oracle=f"""
    SELECT COUNT(*) AS customers FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE n.n_name = '{LOOKUP_NATION}'""")
def count_customers_in_nation(spark, sf_dir):
    n = small(spark, sf_dir, "nation").where(F.col("n_name") == LOOKUP_NATION)
    c = table(spark, sf_dir, "customer")
    return c.join(n, c.c_nationkey == n.n_nationkey).agg(F.count(F.lit(1)).alias("customers"))


# --- D5 -------------------------------------------------------------------------------

@query("avg_order_value", oracle=f"""
    SELECT ROUND(AVG({_CENTS}), 6) AS avg_cents FROM orders WHERE o_orderstatus = 'F'""")
def avg_order_value(spark, sf_dir):
    return completed_orders(spark, sf_dir).agg(
        F.round(F.avg(cents(F.col("o_totalprice"))), 6).alias("avg_cents"))


# --- F1, F2, F4 -------------------------------------------------------------------------

@query("top_products", oracle="""
    SELECT p.p_name AS product, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS units
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN part p ON p.p_partkey = l.l_partkey
    WHERE o.o_orderstatus = 'F'
    GROUP BY p.p_name ORDER BY units DESC, product ASC LIMIT 3""")
def top_products(spark, sf_dir):
    """Top 3 products by units on completed orders, ties broken by name.

    Lines are kept by a semi-join to completed orders and summed per part before the
    part join; the ranking is TakeOrderedAndProject, a per-partition top-k merged on
    the driver (3 rows per partition)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = completed_orders(spark, sf_dir).select("o_orderkey")
    per_part = (li.join(o, li.l_orderkey == o.o_orderkey, "left_semi").groupBy("l_partkey")
                .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units")))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (per_part.join(p, per_part.l_partkey == p.p_partkey)
            .groupBy(F.col("p_name").alias("product")).agg(F.sum("units").alias("units"))
            .orderBy(F.col("units").desc(), F.col("product").asc()).limit(3))


@query("top_by_ordinal", oracle=f"""
    SELECT c.c_mktsegment AS segment, CAST(SUM({_CENTS}) AS BIGINT) AS revenue_cents
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    GROUP BY 1 ORDER BY 2 DESC LIMIT 1""")
def top_by_ordinal(spark, sf_dir):
    """ORDER BY an output ordinal, as generated SQL writes it; run through Spark SQL. Orders
    are summed per customer first, so the join sees one row per customer."""
    per_cust = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    c = table(spark, sf_dir, "customer")
    joined = per_cust.join(c, c.c_custkey == per_cust.o_custkey).select("c_mktsegment", "cents")
    return spark.sql(
        "SELECT c_mktsegment AS segment, SUM(cents) AS revenue_cents FROM {t} "
        "GROUP BY 1 ORDER BY 2 DESC LIMIT 1", t=joined)


@query("limit_unordered", oracle="""
    SELECT COUNT(*) AS rows_returned FROM (SELECT c_mktsegment, c_nationkey FROM customer LIMIT 2) t""")
def limit_unordered(spark, sf_dir):
    """LIMIT without ORDER BY picks any rows; only how many is defined."""
    picked = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey").limit(2)
    return picked.agg(F.count(F.lit(1)).alias("rows_returned"))


# --- H1 / H3 / I1 / N3 ------------------------------------------------------------------

@query("net_revenue", oracle=f"""
    SELECT (SELECT CAST(SUM({_CENTS}) AS BIGINT) FROM orders WHERE o_orderstatus = 'F')
         - (SELECT CAST(COALESCE(SUM(CAST(ROUND(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)), 0)
                        AS BIGINT) FROM lineitem WHERE l_returnflag = 'R') AS net_cents""")
def net_revenue(spark, sf_dir):
    """Gross minus refunds, two scalar subqueries in the reference. Here one aggregate
    over the union of both inputs, signed by side: no join, one final row. Refunds are
    not limited to completed orders or a period, and only the refund side is
    coalesced, so no completed orders still gives NULL."""
    gross = completed_orders(spark, sf_dir).select(
        F.lit(True).alias("is_gross"), cents(F.col("o_totalprice")).alias("c"))
    refunds = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == REFUND_FLAG).select(
        F.lit(False).alias("is_gross"),
        cents(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("c"))
    both = gross.unionByName(refunds)
    return both.agg(
        (F.sum(F.when(F.col("is_gross"), F.col("c")))
         - F.coalesce(F.sum(F.when(~F.col("is_gross"), F.col("c"))), F.lit(0).cast("bigint")))
        .alias("net_cents"))


# --- B3 / D8 / M6 ----------------------------------------------------------------------

@query("item_side_revenue", oracle="""
    SELECT CAST(SUM(CAST(l.l_quantity AS BIGINT) * CAST(ROUND(p.p_retailprice * 100) AS BIGINT)) AS BIGINT)
           AS item_cents
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN part p ON p.p_partkey = l.l_partkey WHERE o.o_orderstatus = 'F'""")
def item_side_revenue(spark, sf_dir):
    """SUM(qty * unit_cents) over lines of completed orders. Quantities are summed per
    part first; exact in integers, so the product of sums equals the sum of products."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = completed_orders(spark, sf_dir).select("o_orderkey")
    per_part = (li.join(o, li.l_orderkey == o.o_orderkey, "left_semi").groupBy("l_partkey")
                .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty")))
    p = table(spark, sf_dir, "part").select("p_partkey", cents(F.col("p_retailprice")).alias("unit_cents"))
    return (per_part.join(p, per_part.l_partkey == p.p_partkey)
            .agg(F.sum(F.col("qty") * F.col("unit_cents")).alias("item_cents")))
