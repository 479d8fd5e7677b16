"""Declared constraints as data-quality jobs.

The reference's storage engine enforces PRIMARY KEY, REFERENCES, NOT NULL and CHECK
at insert time. Parquet enforces nothing, so each rule becomes a query that counts
its violations: one shuffle per key rule, one anti-join per reference, and one pass
per table for all of its NOT NULL and domain rules together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources.tables import SCHEMAS, table

# The declared rules, as the driver's data dictionary states them.
PRIMARY_KEYS = [
    ("region", ("r_regionkey",)),
    ("nation", ("n_nationkey",)),
    ("customer", ("c_custkey",)),
    ("supplier", ("s_suppkey",)),
    ("part", ("p_partkey",)),
    ("orders", ("o_orderkey",)),
    ("lineitem", ("l_orderkey", "l_linenumber")),
]
FOREIGN_KEYS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]
DOMAINS = [
    ("orders", "o_orderstatus", ("F", "O", "P")),
    ("lineitem", "l_returnflag", ("A", "N", "R")),
    ("lineitem", "l_linestatus", ("F", "O")),
]
NOT_NULL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = []
    for name, keys in PRIMARY_KEYS:
        per_key = table(spark, sf_dir, name).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        frames.append(per_key.where(F.col("n") > 1).agg(
            F.lit(name).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"),
            F.count(F.lit(1)).alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("excess_rows")))
    return _union(frames)


def _pk_oracle() -> str:
    parts = []
    for name, keys in PRIMARY_KEYS:
        k = ", ".join(keys)
        parts.append(
            f"SELECT '{name}' AS table_name, '{k}' AS key_columns, COUNT(*) AS duplicated_keys, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows FROM "
            f"(SELECT {k}, COUNT(*) AS n FROM {name} GROUP BY {k} HAVING COUNT(*) > 1) t")
    return "\nUNION ALL\n".join(parts)


@query("dq_pk_duplicates", oracle=_pk_oracle())
def dq_pk_duplicates(spark, sf_dir):
    return pk_duplicates(spark, sf_dir)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        # Child keys are counted first: the anti-join then shuffles one row per
        # distinct key, and a key held by a third of the child rows is one row.
        c = table(spark, sf_dir, child).groupBy(ccol).agg(F.count(F.lit(1)).alias("_n"))
        p = table(spark, sf_dir, parent).select(pcol)
        frames.append(c.join(p, c[ccol] == p[pcol], "left_anti").agg(
            F.lit(f"{child}.{ccol} -> {parent}.{pcol}").alias("reference"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_rows"),
            F.count(F.col(ccol)).alias("orphan_keys")))
    return _union(frames)


def _fk_oracle() -> str:
    parts = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        parts.append(
            f"SELECT '{child}.{ccol} -> {parent}.{pcol}' AS reference, COUNT(*) AS orphan_rows, "
            f"COUNT(DISTINCT c.{ccol}) AS orphan_keys FROM {child} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{ccol})")
    return "\nUNION ALL\n".join(parts)


@query("dq_fk_orphans", oracle=_fk_oracle())
def dq_fk_orphans(spark, sf_dir):
    """Child rows whose key has no parent (a NULL key is not an orphan: it never
    matches, and the anti-join keeps it, so NULL keys are counted here too, as SQL
    NOT EXISTS does)."""
    return fk_orphans(spark, sf_dir)


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass per table: a NULL count for every column, unpivoted to rows."""
    frames = []
    for name in NOT_NULL_TABLES:
        cols = SCHEMAS[name].fieldNames()
        counts = table(spark, sf_dir, name).agg(
            *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        frames.append(counts.select(F.lit(name).alias("table_name"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols
        ])).alias("x")).select("table_name", "x.column_name", "x.null_rows"))
    return _union(frames)


def _nn_oracle() -> str:
    parts = []
    for name in NOT_NULL_TABLES:
        for c in SCHEMAS[name].fieldNames():
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {name}")
    return "\nUNION ALL\n".join(parts)


@query("dq_not_null", oracle=_nn_oracle())
def dq_not_null(spark, sf_dir):
    return not_null(spark, sf_dir)


def domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass per table: every domain rule of the table counted in one aggregate,
    unpivoted to one row per rule."""
    frames = []
    for name in dict.fromkeys(t for t, _, _ in DOMAINS):
        rules = [(col, allowed) for t, col, allowed in DOMAINS if t == name]
        counts = table(spark, sf_dir, name).agg(*[
            F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))).alias(col)
            for col, allowed in rules])
        frames.append(counts.select(F.lit(name).alias("table_name"), F.explode(F.array(*[
            F.struct(F.lit(col).alias("column_name"), F.col(col).alias("violations")) for col, _ in rules
        ])).alias("x")).select("table_name", "x.column_name", "x.violations"))
    return _union(frames)


def _domain_oracle() -> str:
    parts = []
    for name, col, allowed in DOMAINS:
        lst = ", ".join(f"'{a}'" for a in allowed)
        parts.append(f"SELECT '{name}' AS table_name, '{col}' AS column_name, "
                     f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({lst})) AS violations "
                     f"FROM {name}")
    return "\nUNION ALL\n".join(parts)


@query("dq_domain", oracle=_domain_oracle())
def dq_domain(spark, sf_dir):
    """CHECK (x IN (...)): NULL passes a CHECK, as in SQL."""
    return domain(spark, sf_dir)
