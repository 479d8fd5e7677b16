"""The tables as data: row counts, the catalog, answerability, capped preview
(A1, A7, A9, O1) and running a log of SQL statements as data (J1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources.suite import CONCEPTS
from ..sources.tables import TABLE_NAMES, cents, sql_session, table
from .execute import MAX_ROWS, error_facts, run_sql


@query("scan_tables", oracle="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLE_NAMES))
def scan_tables(spark, sf_dir):
    """A1: open every table (declared schema) and count it."""
    frames = [table(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
              for t in TABLE_NAMES]
    return reduce(DataFrame.unionByName, frames)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, ordinal, column_name, data_type, nullable), read from the
    files' own schemas (the footers), not from the declared ones."""
    rows = []
    for t in TABLE_NAMES:
        schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").schema
        for i, f in enumerate(schema.fields, start=1):
            rows.append((t, i, f.name, f.dataType.simpleString(), f.nullable))
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string, "
                                       "nullable boolean")


_NAMES = ", ".join(f"'{t}'" for t in TABLE_NAMES)


# How DuckDB names the types of the files' columns.
_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "array<float>": "FLOAT[]"}


def _catalog_oracle() -> str:
    counts = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLE_NAMES)
    kinds = " ".join(f"WHEN '{sql}' THEN '{spark}'" for spark, sql in _SQL_TYPES.items())
    return f"""
    WITH c AS (SELECT DISTINCT table_name, CAST(ordinal_position AS INTEGER) AS ordinal, column_name,
                      CASE data_type {kinds} WHEN 'TIMESTAMP_NS' THEN 'timestamp_ntz' ELSE data_type END AS data_type,
                      is_nullable = 'YES' AS nullable
               FROM information_schema.columns WHERE table_name IN ({_NAMES}))
    SELECT c.*, n.row_count,
           'CREATE TABLE ' || c.table_name || ' (' || string_agg(column_name || ' ' || upper(data_type), ', ' ORDER BY ordinal)
             OVER (PARTITION BY c.table_name ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
             || ')' AS ddl
    FROM c JOIN ({counts}) n ON n.table_name = c.table_name"""


@query("schema_catalog", oracle=_catalog_oracle())
def schema_catalog(spark, sf_dir):
    """The catalog from the files' schemas, each table's DDL, and its row count (which
    the files' footers answer; no column is read)."""
    cat = catalog(spark, sf_dir)
    counts = reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").agg(
            F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for t in TABLE_NAMES])
    return cat.join(counts, "table_name").join(ddl(cat), "table_name")


def ddl(catalog_df: DataFrame) -> DataFrame:
    """One CREATE TABLE text per table, columns in order."""
    cols = F.array_sort(F.collect_list(F.struct("ordinal", F.concat_ws(" ", "column_name", F.upper("data_type")))))
    return catalog_df.groupBy("table_name").agg(
        F.concat(F.lit("CREATE TABLE "), F.col("table_name"), F.lit(" ("),
                 F.array_join(F.transform(cols, lambda s: s.getField("col2")), ", "), F.lit(")")).alias("ddl"))


def concept_coverage(spark, sf_dir):
    """O1: is the concept an unanswerable question turns on absent from the schema?
    The schema text is the catalog's names; each concept is a substring test on it."""
    names = catalog(spark, sf_dir).select(F.lower("table_name").alias("t"), F.lower("column_name").alias("c"))
    text = names.agg(F.concat_ws(" ", F.array_distinct(F.flatten(F.collect_list(F.array("t", "c"))))).alias("schema"))
    concepts = F.array(*[F.struct(F.lit(q).cast("string").alias("question_id"), F.lit(c).alias("concept"))
                         for q, c in CONCEPTS])
    return (text.select("schema", F.explode(concepts).alias("k"))
            .select("k.question_id", "k.concept", F.col("schema").contains(F.col("k.concept")).alias("present")))


@query("capped_preview", oracle=f"""
    SELECT o_orderkey AS id, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS total_cents,
           (SELECT COUNT(*) > {MAX_ROWS} FROM orders WHERE o_orderstatus = 'F') AS truncated
    FROM orders WHERE o_orderstatus = 'F' ORDER BY id LIMIT {MAX_ROWS}""")
def capped_preview(spark, sf_dir):
    """At most 1,000 rows of an ordered result for display, and whether the cap
    cut it (read as at most cap + 1 rows: the cap is the feature here)."""
    o = (table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
         .select(F.col("o_orderkey").alias("id"), cents(F.col("o_totalprice")).alias("total_cents"))
         .orderBy("id"))
    truncated = o.limit(MAX_ROWS + 1).count() > MAX_ROWS
    return o.limit(MAX_ROWS).withColumn("truncated", F.lit(truncated))


# Statements that fail in each way Spark can fail, and one that works.
ERROR_CASES = (
    ("parse_error", "SELEC SUM(o_totalprice) FROM orders"),
    ("missing_table", "SELECT SUM(o.total_cents) FROM orders o JOIN marketing_channels ch ON ch.id = o.channel_id"),
    ("missing_column", "SELECT SUM(totl_cents) FROM orders"),
    ("bare_column", "SELECT o_orderkey, o_totalprice FROM orders GROUP BY o_custkey"),
    ("bad_cast_at_runtime", "SELECT SUM(CAST(o_orderpriority AS INT)) FROM orders"),
    ("divide_by_zero_at_runtime", "SELECT SUM(o_totalprice / (o_custkey - o_custkey)) FROM orders"),
    ("scalar_subquery_rows", "SELECT (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"),
    ("works", "SELECT COUNT(*) FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"),
)


def _errors_oracle() -> str:
    """How each statement ends, and the count of the one that works."""
    ends = {"parse_error": ("analysis", "PARSE_SYNTAX_ERROR"), "missing_table": ("analysis", "TABLE_OR_VIEW_NOT_FOUND"),
            "missing_column": ("analysis", "UNRESOLVED_COLUMN.WITH_SUGGESTION"), "bare_column": ("analysis", "MISSING_AGGREGATION"),
            "bad_cast_at_runtime": ("execution", "CAST_INVALID_INPUT"),
            "divide_by_zero_at_runtime": ("execution", "DIVIDE_BY_ZERO"),
            "scalar_subquery_rows": ("execution", "SCALAR_SUBQUERY_TOO_MANY_ROWS")}
    rows = [f"SELECT '{k}' AS statement_id, FALSE AS ok, '{p}' AS phase, '{c}' AS condition, CAST(NULL AS BIGINT) AS result_rows"
            for k, (p, c) in ends.items()]
    works = dict(ERROR_CASES)["works"].replace("COUNT(*)", "COUNT(*) AS n")
    return "\nUNION ALL ".join([*rows, f"SELECT 'works', TRUE, 'ok', NULL, (SELECT COUNT(*) FROM ({works}) q)"])


@query("error_taxonomy", oracle=_errors_oracle())
def error_taxonomy(spark, sf_dir):
    """Run each statement to the end; analysis and run-time failures become rows
    (phase, error condition) instead of exceptions."""
    s = sql_session(spark, sf_dir, shop=False)
    rows = []
    for sid, text in ERROR_CASES:
        out = run_sql(s, text)
        if not out.ok:
            rows.append((sid, False, "analysis", out.condition, None))
            continue
        try:
            # max of a hash of every column: nothing can be pruned away unevaluated
            n = out.df.select(F.xxhash64(*[F.col(f"`{c}`") for c in out.df.columns]).alias("h")) \
                .agg(F.count(F.lit(1)), F.max("h")).first()[0]
            rows.append((sid, True, "ok", None, int(n)))
        except Exception as exc:  # noqa: BLE001
            rows.append((sid, False, "execution", error_facts(exc)[0], None))
    return spark.createDataFrame(rows, "statement_id string, ok boolean, phase string, condition string, "
                                       "result_rows long")
