"""A metric registry that compiles to one scan (group N).

The reference keeps metric definitions as prose in a prompt and runs one query per
number. Here a definition is a row: a measure and a filter as SQL expressions over
one source, and the period column it is booked on. All metrics of one source become
conditional sums in a single aggregate: every metric, whatever its source, costs one
pass over orders and one over lineitem together. Derived metrics (net) are arithmetic
on the one-row result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources.tables import cents, table
from .relational import MONTH_END, MONTH_START


@dataclass(frozen=True)
class Metric:
    name: str
    source: str        # "orders" or "refunds"
    measure: str       # SQL expression summed
    filter: str        # SQL predicate
    date_column: str | None = None   # the column the period applies to; None: all time
    owner: str = "finance"

    def predicate(self, period: tuple[str, str]) -> str:
        """The filter, within the half-open period if the metric is booked on a date."""
        if self.date_column is None:
            return self.filter
        d = self.date_column
        return f"({self.filter}) AND {d} >= DATE '{period[0]}' AND {d} < DATE '{period[1]}'"


PERIOD = (MONTH_START, MONTH_END)

# The definitions the suite rules on (gross, net, one period's revenue by
# either date, and revenue including unpaid pending orders).
REGISTRY: tuple[Metric, ...] = (
    Metric("gross_revenue", "orders", "total_cents", "status_code = 'F'"),
    Metric("revenue_with_pending", "orders", "total_cents", "status_code IN ('F', 'O')"),
    Metric("month_by_ordered", "orders", "total_cents", "status_code = 'F'", "ordered_at"),
    Metric("month_by_shipped", "orders", "total_cents", "status_code = 'F'", "shipped_at"),
    Metric("refunds", "refunds", "amount_cents", "TRUE"),
)
DERIVED = {"net_revenue": ("gross_revenue", "refunds")}   # a - coalesce(b, 0)


def _line_columns() -> list:
    """Refund lines as the refunds source sees them, one row per line."""
    return [F.col("l_orderkey"), F.col("l_shipdate"),
            (F.col("l_returnflag") == "R").alias("is_refund"),
            cents(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("amount_cents"),
            F.col("l_shipdate").cast("date").alias("refunded_at")]


def compile_metrics(spark: SparkSession, sf_dir: str, registry=REGISTRY, period=PERIOD) -> DataFrame:
    """One row per metric: (metric, date_column, value_cents), reading each table once.
    ``period`` applies to the metrics that are booked on a date column.

    Line-level metrics (refunds) are summed per order inside the one lineitem
    aggregate that also yields each order's first ship date; that per-order row is
    FULL OUTER joined to orders (so refunds of lines without an order still count),
    and a single aggregate evaluates every metric. A key holding a third of the lines
    collapses map-side in the per-order aggregate."""
    order_ms = [m for m in registry if m.source == "orders"]
    line_ms = [m for m in registry if m.source == "refunds"]
    unknown = {m.source for m in registry} - {"orders", "refunds"}
    if unknown:
        raise ValueError(f"unknown metric source {unknown}")
    need_ship = any("shipped_at" in f"{m.filter} {m.measure} {m.date_column}" for m in order_ms)
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status_code"),
        F.col("o_orderdate").cast("date").alias("ordered_at"),
        cents(F.col("o_totalprice")).alias("total_cents"))
    per_order_aggs = ([F.min("l_shipdate").cast("date").alias("shipped_at")] if need_ship else []) + [
        F.sum(F.when(F.col("is_refund") & F.expr(m.predicate(period)), F.expr(m.measure))).alias(f"_l_{m.name}")
        for m in line_ms]
    if per_order_aggs:
        lines = (table(spark, sf_dir, "lineitem").select(*_line_columns())
                 .groupBy("l_orderkey").agg(*per_order_aggs))
        base = o.join(lines, o.id == lines.l_orderkey, "full_outer") if line_ms else \
            o.join(lines, o.id == lines.l_orderkey, "left")
    else:
        base = o
    aggs = [F.sum(F.when(F.expr(m.predicate(period)), F.expr(m.measure))).cast("bigint").alias(m.name) for m in order_ms]
    aggs += [F.sum(f"_l_{m.name}").cast("bigint").alias(m.name) for m in line_ms]
    wide = base.agg(*aggs)
    names = [m.name for m in registry]
    for derived, (a, b) in DERIVED.items():
        wide = wide.withColumn(derived, F.col(a) - F.coalesce(F.col(b), F.lit(0).cast("bigint")))
        names.append(derived)
    booked = {m.name: m.date_column for m in registry}
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.lit(booked.get(n)).cast("string").alias("date_column"),
                 F.col(n).alias("value_cents")) for n in names
    ])).alias("m")).select("m.metric", "m.date_column", "m.value_cents")


_ORDERS_SQL = f"""
    SELECT o.o_orderstatus AS status_code, CAST(o.o_orderdate AS DATE) AS ordered_at,
           s.shipped_at, CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS total_cents
    FROM orders o LEFT JOIN (SELECT l_orderkey, CAST(MIN(l_shipdate) AS DATE) AS shipped_at
                             FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey"""
_REFUNDS_SQL = """
    SELECT CAST(ROUND(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS amount_cents
    FROM lineitem WHERE l_returnflag = 'R'"""


def _metric_oracle() -> str:
    sums = []
    for m in REGISTRY:
        src = _ORDERS_SQL if m.source == "orders" else _REFUNDS_SQL
        booked = f"'{m.date_column}'" if m.date_column else "CAST(NULL AS VARCHAR)"
        sums.append(f"SELECT '{m.name}' AS metric, {booked} AS date_column, "
                    f"CAST(SUM(CASE WHEN {m.predicate(PERIOD)} THEN {m.measure} END) AS BIGINT) AS value_cents FROM ({src}) t")
    body = "\nUNION ALL\n".join(sums)
    derived = []
    for name, (a, b) in DERIVED.items():
        derived.append(f"SELECT '{name}' AS metric, CAST(NULL AS VARCHAR) AS date_column, (SELECT value_cents FROM base WHERE metric = '{a}') - "
                       f"COALESCE((SELECT value_cents FROM base WHERE metric = '{b}'), 0) AS value_cents")
    return f"WITH base AS ({body})\nSELECT * FROM base UNION ALL " + " UNION ALL ".join(derived)


METRIC_ORACLE = _metric_oracle()


@query("metric_table", oracle=METRIC_ORACLE)
def metric_table(spark, sf_dir):
    return compile_metrics(spark, sf_dir)


@query("metric_spread", oracle=f"""
    WITH m AS ({METRIC_ORACLE}), r AS (SELECT * FROM m WHERE metric IN ('gross_revenue', 'revenue_with_pending',
        'month_by_ordered', 'month_by_shipped', 'net_revenue'))
    SELECT (SELECT metric FROM r ORDER BY value_cents DESC, metric LIMIT 1) AS widest_metric,
           (SELECT metric FROM r ORDER BY value_cents ASC, metric LIMIT 1) AS narrowest_metric,
           MAX(value_cents) - MIN(value_cents) AS spread_cents,
           ROUND((MAX(value_cents) - MIN(value_cents)) / (SELECT value_cents FROM r WHERE metric = 'net_revenue'), 6)
             AS spread_of_net
    FROM r""")
def metric_spread(spark, sf_dir):
    """Widest gap between the revenue definitions, absolute and relative to net."""
    m = compile_metrics(spark, sf_dir).where(F.col("metric") != "refunds")
    v, name = F.col("value_cents"), F.col("metric")
    return m.agg(
        F.min_by(name, F.struct(-v, name)).alias("widest_metric"),
        F.min_by(name, F.struct(v, name)).alias("narrowest_metric"),
        (F.max(v) - F.min(v)).alias("spread_cents"),
        F.round((F.max(v) - F.min(v)) / F.max(F.when(name == "net_revenue", v)), 6).alias("spread_of_net"),
    )
