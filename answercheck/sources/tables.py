"""The driver's tables, read with declared schemas, and the ruling that maps the
four-table shop vocabulary (customers, orders, order_items, refunds) onto them.

The ruling lives here and nowhere else. It exists twice on purpose, in the same
words: as DataFrame code for the library's own queries (so filters on the raw status
code reach the parquet scan), and as SQL view text that both Spark and DuckDB run, so
a suite of SQL questions written in the shop vocabulary can be executed by either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The files store timestamps without a zone (isAdjustedToUTC=false): read them as
# TIMESTAMP_NTZ, so dates and comparisons do not depend on the session time zone.
L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                        ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                    ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                      ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                      ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
}

TABLE_NAMES = tuple(SCHEMAS)

# Tables whose size is fixed by the schema's design (TPC-H: 5 regions, 25 nations) and
# so may be broadcast at any scale. Nothing else is hinted; Spark's planner decides by
# measured size for the rest.
BOUNDED = {"region": 5, "nation": 25}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read with its declared schema (no footer inference)."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with a proven size bound, marked for broadcast."""
    if name not in BOUNDED:
        raise ValueError(f"{name} has no size bound and must not be broadcast")
    return F.broadcast(table(spark, sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Temp views named like the driver's tables; idempotent, replaces on repeat."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


# --- the ruling: shop vocabulary on the driver's tables ------------------------------

# Fixed values of the ruling: order status words and the one-letter codes they map to.
STATUS_CODES = {"completed": "F", "pending": "O", "cancelled": "P"}
# Fixed value: the return flag that marks a refunded line.
REFUND_FLAG = "R"


def cents(c: Column) -> Column:
    """Money as exact integer cents: CAST(ROUND(x * 100) AS BIGINT)."""
    return F.round(c * F.lit(100)).cast("bigint")


def status_is(*words: str) -> Column:
    """Filter on the raw status code, so the predicate reaches the parquet scan."""
    codes = [STATUS_CODES[w] for w in words]
    col = F.col("o_orderstatus")
    return col == F.lit(codes[0]) if len(codes) == 1 else col.isin(codes)


def shop_orders(spark: SparkSession, sf_dir: str, with_shipped: bool = False) -> DataFrame:
    """orders(id, customer_id, status_code, ordered_at, total_cents[, shipped_at]).

    ``shipped_at`` is the first ship date of the order's lines; an order without
    lines has none. It costs a shuffle of lineitem by order key, so it is only
    joined when asked for.
    """
    o = table(spark, sf_dir, "orders")
    out = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus"),
        F.col("o_orderdate").cast("date").alias("ordered_at"),
        cents(F.col("o_totalprice")).alias("total_cents"),
    )
    if with_shipped:
        first_ship = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                      .agg(F.min("l_shipdate").cast("date").alias("shipped_at")))
        out = out.join(first_ship, out.id == first_ship.l_orderkey, "left").drop("l_orderkey")
    return out


def shop_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """refunds(order_id, amount_cents, refunded_at): returned lines, net of discount."""
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_returnflag") == REFUND_FLAG).select(
        F.col("l_orderkey").alias("order_id"),
        cents(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("amount_cents"),
        F.col("l_shipdate").cast("date").alias("refunded_at"),
    )


# The same ruling as SQL text, runnable by Spark and by DuckDB. Column names follow
# the shop vocabulary. The protected column is ``customers.email``, played by c_name.
SHOP_VIEWS_SQL: dict[str, str] = {
    "shop_customers": """
        SELECT c.c_custkey AS id, c.c_mktsegment AS segment, n.n_name AS country,
               c.c_name AS email
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "shop_orders": """
        SELECT o.o_orderkey AS id, o.o_custkey AS customer_id,
               CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                                    WHEN 'P' THEN 'cancelled' END AS status,
               CAST(o.o_orderdate AS DATE) AS ordered_at,
               s.shipped_at,
               CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS total_cents
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, CAST(MIN(l_shipdate) AS DATE) AS shipped_at
                   FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey""",
    "shop_order_items": """
        SELECT l.l_linenumber AS id, l.l_orderkey AS order_id, p.p_name AS product,
               CAST(l.l_quantity AS BIGINT) AS qty,
               CAST(ROUND(p.p_retailprice * 100) AS BIGINT) AS unit_cents
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    "shop_refunds": """
        SELECT l.l_orderkey AS order_id,
               CAST(ROUND(l.l_extendedprice * (1 - l.l_discount) * 100) AS BIGINT) AS amount_cents,
               CAST(l.l_shipdate AS DATE) AS refunded_at
        FROM lineitem l WHERE l.l_returnflag = 'R'""",
}


def shop_cte() -> str:
    """The shop views as a WITH prefix, for engines that get only the raw tables."""
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in SHOP_VIEWS_SQL.items()) + "\n"


def sql_session(spark: SparkSession, sf_dir: str, shop: bool = True) -> SparkSession:
    """A child session (same SparkContext, its own temp views) with the driver's tables
    and, by default, the shop views registered. SQL text from a suite or a candidate
    runs here, so the caller's own views are never shadowed."""
    child = spark.newSession()
    register_tables(child, sf_dir)
    if shop:
        for name, body in SHOP_VIEWS_SQL.items():
            child.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {body}")
    return child
