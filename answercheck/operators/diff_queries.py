"""Comparison pairs over the driver's tables, and the J keys built on them.

Each pair is two SQL texts in the dialect Spark and DuckDB share, run over the whole
tables: the Spark side runs both and compares with ``diff.compare`` (signed counts,
tolerance re-pairing, positions); the oracle states the same facts with EXCEPT ALL
and row_number in DuckDB. The pairs mirror the reference's comparison cases: same
meaning written differently, a missing filter, a fan-out join, int against float,
float noise, duplicated rows, padded text, NULL against zero, wrong order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.execute import has_global_sort, run_sql
from ..registry import query
from ..session import SharedTables
from ..sources.tables import sql_session
from .diff import BATCH, compare, compare_batch, ordered_pairs, residual_rows, strip_ws_sql
from .explain import explain_col, explain_sql

_CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"


@dataclass(frozen=True)
class Pair:
    pair_id: str
    gold: str
    cand: str
    kinds: tuple[str, ...]          # column comparison types, stated for the oracle
    ordered: bool = False
    gold_order: str = ""            # oracle only: the order each side promises
    cand_order: str = ""
    places: int = 6                 # oracle only: decimals that carry meaning in float columns
    unmatched: tuple[str, str] | None = None   # oracle only: unmatched rows per side, where rounding cannot tell


# The comparison cases.
PAIRS: tuple[Pair, ...] = (
    Pair("negated_or",
         f"SELECT SUM({_CENTS}) FROM orders WHERE o_orderstatus = 'F'",
         "SELECT SUM(CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) FROM orders AS o "
         "WHERE NOT (o.o_orderstatus = 'P' OR o.o_orderstatus = 'O')",
         ("exact",)),
    Pair("missing_filter",
         f"SELECT SUM({_CENTS}) FROM orders WHERE o_orderstatus = 'F'",
         f"SELECT SUM({_CENTS}) FROM orders",
         ("exact",)),
    Pair("fanout_join",
         f"SELECT SUM({_CENTS}) FROM orders WHERE o_orderstatus = 'F'",
         "SELECT SUM(CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) FROM orders o "
         "JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'",
         ("exact",)),
    Pair("country_rewritten",
         f"SELECT n.n_name, SUM({_CENTS}) FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey "
         "JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE o.o_orderstatus = 'F' GROUP BY n.n_name",
         "SELECT nat.n_name AS country, SUM(CAST(ROUND(ord.o_totalprice * 100) AS BIGINT)) AS revenue "
         "FROM nation nat JOIN customer cu ON nat.n_nationkey = cu.c_nationkey "
         "JOIN orders ord ON cu.c_custkey = ord.o_custkey "
         "WHERE ord.o_orderstatus IN ('F') GROUP BY nat.n_name",
         ("text", "exact")),
    Pair("int_vs_float",
         "SELECT o_orderstatus, COUNT(*) FROM orders GROUP BY o_orderstatus",
         "SELECT o_orderstatus, CAST(COUNT(*) AS DOUBLE) FROM orders GROUP BY o_orderstatus",
         ("text", "float")),
    Pair("float_noise",
         "SELECT o_orderpriority, AVG(o_totalprice) FROM orders GROUP BY o_orderpriority",
         "SELECT o_orderpriority, AVG(o_totalprice) + 1e-10 FROM orders GROUP BY o_orderpriority",
         ("text", "float")),
    Pair("multiplicity",
         "SELECT DISTINCT l_orderkey FROM lineitem",
         "SELECT l_orderkey FROM lineitem",
         ("exact",)),
    Pair("padded_text",
         "SELECT c_custkey, c_mktsegment FROM customer",
         "SELECT c_custkey, ' ' || c_mktsegment || chr(9) FROM customer",
         ("exact", "text")),
    Pair("null_vs_zero",
         "SELECT o_orderstatus, SUM(CASE WHEN o_totalprice < 0 THEN 1 END) FROM orders GROUP BY o_orderstatus",
         "SELECT o_orderstatus, COALESCE(SUM(CASE WHEN o_totalprice < 0 THEN 1 END), 0) FROM orders "
         "GROUP BY o_orderstatus",
         ("text", "exact")),
    Pair("wrong_order",
         "SELECT p.p_name, SUM(CAST(l.l_quantity AS BIGINT)) AS units FROM lineitem l "
         "JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_name ORDER BY units DESC, p.p_name ASC LIMIT 10",
         "SELECT product, units FROM (SELECT p.p_name AS product, SUM(CAST(l.l_quantity AS BIGINT)) AS units "
         "FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_name "
         "ORDER BY units DESC, p.p_name ASC LIMIT 10) t ORDER BY product",
         ("text", "exact"), ordered=True, gold_order="c1 DESC, c0 ASC", cand_order="c0 ASC"),
)

# Whole tables against themselves with noise under the tolerance, where the
# 6-place grid alone would not do. Prices have two decimals, so the oracle compares those.
_NOISE = "(CASE WHEN l_linenumber % 2 = 0 THEN 4e-7 ELSE -4e-7 END)"
_DENSE = "(l_orderkey * 6e-7)"
_DENSE2 = "(l_partkey * 6e-7)"
LARGE_PAIRS: tuple[Pair, ...] = (
    Pair("noisy_prices", "SELECT l_orderkey, l_extendedprice FROM lineitem",
         f"SELECT l_orderkey, l_extendedprice + {_NOISE} FROM lineitem", ("exact", "float"), places=2),
    Pair("noise_in_two_columns", "SELECT l_extendedprice, l_tax FROM lineitem",
         f"SELECT l_extendedprice + {_NOISE}, l_tax - {_NOISE} FROM lineitem", ("float", "float"), places=2),
    Pair("a_third_share_a_value_and_rows_lack",
         "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE o_totalprice END FROM orders",
         "SELECT (CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE o_totalprice END) + 3e-7 FROM orders WHERE o_orderkey % 1000 <> 6",
         ("float",), places=2),
    # Dense columns: neighbours lie within the tolerance of each other, so that a whole column
    # is one run. Every candidate row but the last has its own gold row within the tolerance
    # and the last is far from all, which is what the oracle counts.
    Pair("dense_column", f"SELECT {_DENSE} FROM lineitem",
         f"SELECT {_DENSE} + {_NOISE} FROM lineitem WHERE l_orderkey <> 7 UNION ALL SELECT 7.0e0", ("float",),
         unmatched=("(SELECT COUNT(*) FROM lineitem WHERE l_orderkey = 7)", "1")),
    Pair("two_dense_columns", f"SELECT {_DENSE}, {_DENSE2} FROM lineitem",
         f"SELECT {_DENSE} + {_NOISE}, {_DENSE2} - {_NOISE} FROM lineitem WHERE l_orderkey % 50 <> 7 "
         f"UNION ALL SELECT {_DENSE}, 7.0e0 FROM lineitem WHERE l_orderkey = 7", ("float", "float"),
         unmatched=("(SELECT COUNT(*) FROM lineitem WHERE l_orderkey % 50 = 7)",
                    "(SELECT COUNT(*) FROM lineitem WHERE l_orderkey = 7)")),
    Pair("long_decimals",
         "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20, 2)) + CAST('12345678901234567.00' AS DECIMAL(20, 2)) FROM orders",
         "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20, 2)) + CAST('12345678901234567.00' AS DECIMAL(20, 2)) "
         "+ CAST(CASE WHEN o_orderkey % 100 = 0 THEN '0.01' ELSE '0.00' END AS DECIMAL(20, 2)) FROM orders",
         ("exact", "fixed")),
    Pair("whole_order", f"SELECT o_orderkey, {_CENTS} FROM orders ORDER BY o_orderkey",
         f"SELECT o_orderkey + 0, {_CENTS} FROM orders ORDER BY o_orderkey ASC",
         ("exact", "exact"), ordered=True, gold_order="c0", cand_order="c0"),
    Pair("whole_order_reversed", f"SELECT o_orderkey, {_CENTS} FROM orders ORDER BY o_orderkey",
         f"SELECT o_orderkey, {_CENTS} FROM orders ORDER BY o_orderkey DESC",
         ("exact", "exact"), ordered=True, gold_order="c0", cand_order="c0 DESC"),
)

# Pairs with many rows on both sides, for the residual and row-count keys.
RESIDUAL_PAIR = Pair(
    "fanout_rows",
    f"SELECT o_orderkey, {_CENTS} FROM orders WHERE o_orderstatus = 'F'",
    "SELECT o.o_orderkey, CAST(ROUND(o.o_totalprice * 100) AS BIGINT) FROM orders o "
    "JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'",
    ("exact", "exact"))
NORMALIZE_PAIR = Pair(
    "mixed_types",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
    "SELECT CAST(o_orderkey AS DOUBLE), CAST(o_totalprice AS DECIMAL(12, 2)), ' ' || o_orderpriority || chr(10) "
    "FROM orders",
    ("float", "float", "text"))


# --- Spark side -------------------------------------------------------------------------

def _value_text(v) -> str | None:
    """A cell as text for an explanation; floats as the comparison sees them (6 places)."""
    from decimal import Decimal
    if isinstance(v, float):
        return str(round(v, 6))
    if isinstance(v, Decimal) and v == v.to_integral_value():
        return str(int(v))
    return None if v is None else str(v)


def _value_number(v) -> float | None:
    if isinstance(v, bool) or v is None:
        return None
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


FACT_SCHEMA = T.StructType([
    T.StructField("pair_id", T.StringType()),
    T.StructField("cand_ok", T.BooleanType()), T.StructField("gold_ok", T.BooleanType()),
    T.StructField("cand_error", T.StringType()), T.StructField("gold_error", T.StringType()),
    T.StructField("cand_denied", T.BooleanType()), T.StructField("gold_denied", T.BooleanType()),
    T.StructField("cand_condition", T.StringType()), T.StructField("cand_unsorted", T.BooleanType()),
    T.StructField("gold_rows", T.LongType()), T.StructField("cand_rows", T.LongType()),
    T.StructField("unmatched_gold", T.LongType()), T.StructField("unmatched_cand", T.LongType()),
    T.StructField("bag_equal", T.BooleanType()), T.StructField("equal", T.BooleanType()),
    T.StructField("ordered", T.BooleanType()), T.StructField("approximate", T.BooleanType()),
    T.StructField("single_cell", T.BooleanType()),
    T.StructField("gold_value", T.StringType()), T.StructField("cand_value", T.StringType()),
    T.StructField("gold_number", T.DoubleType()), T.StructField("cand_number", T.DoubleType()),
    T.StructField("fanout_joins", T.IntegerType()), T.StructField("fanout_factor", T.DoubleType()),
])


def _side_failure(out) -> tuple[str, str] | None:
    """Run one side alone to see whether it fails at run time: (condition, message)."""
    from ..plans.execute import error_facts
    try:
        # max of a hash of every column: pruning cannot skip the failing expression
        out.df.select(F.xxhash64(*[F.col(f"`{n}`") for n in out.df.columns]).alias("h")) \
            .agg(F.max("h")).collect()
        return None
    except Exception as exc:  # noqa: BLE001
        return error_facts(exc)


def compare_sql_many(spark: SparkSession, specs: list[tuple[str, str, str, bool]], runner=None,
                     audit_joins: bool = False) -> list[dict]:
    """Facts for many comparisons of SQL texts (pair_id, gold_sql, cand_sql, ordered).

    ``runner(text) -> QueryOutcome`` decides where SQL runs (default: ``spark``
    unrestricted; ``GovernedSession.run`` for the analyst role). A refused candidate is
    judged before its gold. All pairs that analyse cleanly are compared together."""
    run = runner or (lambda text: run_sql(spark, text))
    rows, outcomes = [], {}
    # Analysis of each text happens on the driver; run it from threads.
    from concurrent.futures import ThreadPoolExecutor
    golds = list(dict.fromkeys(sp[1] for sp in specs))   # each trusted query once
    with ThreadPoolExecutor(max_workers=8) as pool:
        trusted = dict(zip(golds, pool.map(run, golds)))
        analysed = [(c, trusted[sp[1]]) for c, sp in zip(pool.map(lambda sp: run(sp[2]), specs), specs)]
    for (pair_id, gold_sql, cand_sql, ordered), (c, g) in zip(specs, analysed):
        rows.append(dict(pair_id=pair_id, cand_ok=c.ok, gold_ok=g.ok, cand_error=c.error, gold_error=g.error,
                         cand_denied=c.denied, gold_denied=g.denied, cand_condition=c.condition,
                         cand_unsorted=(not has_global_sort(c.df)) if (ordered and c.ok) else None,
                         gold_rows=None, cand_rows=None, unmatched_gold=None, unmatched_cand=None,
                         bag_equal=False, equal=False, ordered=ordered, approximate=False, single_cell=False,
                         gold_value=None, cand_value=None, gold_number=None, cand_number=None,
                         fanout_joins=None, fanout_factor=None))
        outcomes[pair_id] = (g, c)
    items = [(r["pair_id"], outcomes[r["pair_id"]][0].df, outcomes[r["pair_id"]][1].df, r["ordered"])
             for r in rows if r["gold_ok"] and r["cand_ok"]]
    diffs = compare_batch(items)
    for row in rows:
        if row["pair_id"] not in diffs:
            continue
        d = diffs[row["pair_id"]]
        if isinstance(d, Exception):
            g, c = outcomes[row["pair_id"]]
            failed = {side: _side_failure(out) for side, out in (("gold", g), ("cand", c))}
            if not any(failed.values()):
                raise d   # both sides run alone: the failure is the comparison's, not a verdict
            for side, fact in failed.items():
                if fact:
                    row[f"{side}_ok"], row[f"{side}_error"] = False, fact[1]
                    if side == "cand":
                        row["cand_condition"] = fact[0]
            continue
        row.update(gold_rows=d.gold_rows, cand_rows=d.cand_rows, unmatched_gold=d.unmatched_gold,
                   unmatched_cand=d.unmatched_cand, bag_equal=d.bag_equal, equal=d.equal,
                   approximate=d.approximate)
        if d.gold_rows == 1 and d.cand_rows == 1 and d.gold_arity == 1 and d.cand_arity == 1:
            gv, cv = d.gold_value, d.cand_value
            row.update(single_cell=not d.equal, gold_value=_value_text(gv), cand_value=_value_text(cv),
                       gold_number=_value_number(gv), cand_number=_value_number(cv))
    if audit_joins:
        _audit_wrong(rows, outcomes)
    return rows


def _audit_wrong(rows: list[dict], outcomes: dict) -> None:
    """For every candidate that ran and disagreed, did one of its joins change
    the row count of its FROM side? All audits run as one job."""
    from .fanout import join_audit
    audits = {}
    for row in rows:
        if row["gold_ok"] and row["cand_ok"] and row["gold_rows"] is not None and not row["equal"]:
            try:
                a = join_audit(outcomes[row["pair_id"]][1].df, row["pair_id"])
            except Exception:  # noqa: BLE001  an audit that fails leaves its facts NULL
                a = None
            if a is not None:
                audits[row["pair_id"]] = a

    def run(keys: list[str]) -> dict:
        if not keys:
            return {}
        try:
            joint = reduce(DataFrame.unionByName, [audits[k] for k in keys]).groupBy("query_id").agg(
                F.count_if("changed_rows").cast("int").alias("n"), F.max("factor").alias("f"))
            return {r["query_id"]: r for r in joint.collect()}
        except Exception:  # noqa: BLE001  halve to leave out only the audit that fails
            half = len(keys) // 2
            return run(keys[:half]) | run(keys[half:]) if half else {}

    found = {}
    names = list(audits)
    for i in range(0, len(names), BATCH):   # bounded plans, as for the comparisons
        found |= run(names[i:i + BATCH])
    for row in rows:
        if row["pair_id"] in found:
            row["fanout_joins"] = found[row["pair_id"]]["n"]
            row["fanout_factor"] = found[row["pair_id"]]["f"]


def compare_sql(spark: SparkSession, pair_id: str, gold_sql: str, cand_sql: str, ordered: bool,
                runner=None) -> dict:
    """All facts about one comparison of two SQL texts; failures are facts too."""
    return compare_sql_many(spark, [(pair_id, gold_sql, cand_sql, ordered)], runner)[0]


def pair_facts(spark: SparkSession, sf_dir: str, pairs=PAIRS) -> DataFrame:
    """One fact row per pair, all pairs compared in one Spark job."""
    s = sql_session(spark, sf_dir, shop=False)
    rows = compare_sql_many(s, [(p.pair_id, p.gold, p.cand, p.ordered) for p in pairs])
    return spark.createDataFrame(rows, FACT_SCHEMA)


# --- oracle side ---------------------------------------------------------------------------

def _oracle_norm(i: int, kind: str, prefix: str = "", places: int = 6) -> str:
    c = f"{prefix}c{i}"
    if kind == "fixed":
        return f"CAST({c} AS DECIMAL(38, 2))"
    if kind == "exact":
        return f"CAST({c} AS DECIMAL(38, 0))"
    if kind == "float":
        return f"ROUND(CAST({c} AS DOUBLE), {places})"
    if kind == "text":
        return strip_ws_sql(f"CAST({c} AS VARCHAR)")
    return c


def _oracle_pair(p: Pair) -> str:
    cols = ", ".join(f"c{i}" for i in range(len(p.kinds)))
    norm = ", ".join(f"{_oracle_norm(i, k, places=p.places)} AS c{i}" for i, k in enumerate(p.kinds))
    gn = f"SELECT {norm} FROM ({p.gold}) AS g({cols})"
    cn = f"SELECT {norm} FROM ({p.cand}) AS c({cols})"
    if p.ordered:
        same = " AND ".join(f"gp.c{i} IS NOT DISTINCT FROM cp.c{i}" for i in range(len(p.kinds)))
        om = (f"(SELECT COUNT(*) FROM (SELECT row_number() OVER (ORDER BY {p.gold_order}) AS pos, {norm} "
              f"FROM ({p.gold}) AS g({cols})) gp FULL JOIN (SELECT row_number() OVER (ORDER BY {p.cand_order}) "
              f"AS pos, {norm} FROM ({p.cand}) AS c({cols})) cp ON gp.pos = cp.pos "
              f"WHERE gp.pos IS NULL OR cp.pos IS NULL OR NOT ({same}))")
    else:
        om = "0"
    g1 = f"(SELECT MAX({_oracle_norm(0, p.kinds[0])}) FROM ({p.gold}) AS g({cols}))"
    c1 = f"(SELECT MAX({_oracle_norm(0, p.kinds[0])}) FROM ({p.cand}) AS c({cols}))"
    ug, uc = p.unmatched or (f"(SELECT COUNT(*) FROM ({gn} EXCEPT ALL {cn}) t)",
                             f"(SELECT COUNT(*) FROM ({cn} EXCEPT ALL {gn}) t)")
    return f"""SELECT '{p.pair_id}' AS pair_id, gr AS gold_rows, cr AS cand_rows, ug AS unmatched_gold,
        uc AS unmatched_cand, (ug = 0 AND uc = 0) AS bag_equal, (ug = 0 AND uc = 0 AND om = 0) AS equal,
        {str(p.ordered).upper()} AS ordered,
        (gr = 1 AND cr = 1 AND {len(p.kinds)} = 1 AND NOT (ug = 0 AND uc = 0 AND om = 0)) AS single_cell,
        CASE WHEN gr = 1 AND cr = 1 AND {len(p.kinds)} = 1 THEN CAST({g1} AS VARCHAR) END AS gold_value,
        CASE WHEN gr = 1 AND cr = 1 AND {len(p.kinds)} = 1 THEN CAST({c1} AS VARCHAR) END AS cand_value,
        CASE WHEN gr = 1 AND cr = 1 AND {len(p.kinds)} = 1 AND '{p.kinds[0]}' IN ('exact', 'float')
             THEN CAST({g1} AS DOUBLE) END AS gold_number,
        CASE WHEN gr = 1 AND cr = 1 AND {len(p.kinds)} = 1 AND '{p.kinds[0]}' IN ('exact', 'float')
             THEN CAST({c1} AS DOUBLE) END AS cand_number
    FROM (SELECT (SELECT COUNT(*) FROM ({p.gold}) t) AS gr, (SELECT COUNT(*) FROM ({p.cand}) t) AS cr,
                 {ug} AS ug, {uc} AS uc, {om} AS om) f"""


def _oracle_facts(pairs=PAIRS) -> str:
    return "\nUNION ALL\n".join(_oracle_pair(p) for p in pairs)


_BAG_COLS = "pair_id, gold_rows, cand_rows, unmatched_gold, unmatched_cand, bag_equal, equal"


@query("bag_diff_equal", oracle=f"SELECT {_BAG_COLS} FROM ({_oracle_facts()}) f")
def bag_diff_equal(spark, sf_dir):
    """Equality of each pair as a multiset (and by position where ordered)."""
    return pair_facts(spark, sf_dir).select(*[c.strip() for c in _BAG_COLS.split(",")])


@query("tolerance_diff", oracle=f"SELECT {_BAG_COLS} FROM ({_oracle_facts(LARGE_PAIRS)}) f")
def tolerance_diff(spark, sf_dir):
    """J4-J6 where most rows need the tolerance or a position: whole tables, a value that a
    third of the rows share, sides of different size, two inexact columns, long decimals."""
    return pair_facts(spark, sf_dir, LARGE_PAIRS).select(*[c.strip() for c in _BAG_COLS.split(",")])


@query("explain_diff", oracle=f"""
    SELECT pair_id, {explain_sql()} AS detail
    FROM (SELECT *, TRUE AS cand_ok, TRUE AS gold_ok, CAST(NULL AS VARCHAR) AS cand_error,
                 CAST(NULL AS VARCHAR) AS gold_error FROM ({_oracle_facts()}) f) x""")
def explain_diff(spark, sf_dir):
    """Why each pair differs, in words."""
    return pair_facts(spark, sf_dir).select("pair_id", explain_col().alias("detail"))


@query("bag_diff_rows", oracle=f"""
    SELECT c0, c1, CASE WHEN n > 0 THEN 'gold' ELSE 'candidate' END AS side, ABS(n) AS excess_rows
    FROM (SELECT c0, c1, SUM(tag) AS n FROM (
            SELECT CAST(c0 AS DECIMAL(38, 0)) AS c0, CAST(c1 AS DECIMAL(38, 0)) AS c1, 1 AS tag
            FROM ({RESIDUAL_PAIR.gold}) AS g(c0, c1)
            UNION ALL
            SELECT CAST(c0 AS DECIMAL(38, 0)), CAST(c1 AS DECIMAL(38, 0)), -1
            FROM ({RESIDUAL_PAIR.cand}) AS c(c0, c1)) t
          GROUP BY c0, c1 HAVING SUM(tag) <> 0) r""")
def bag_diff_rows(spark, sf_dir):
    """J5 residual over whole tables: which rows the fan-out join repeats (candidate
    surplus) and which it drops (childless parents, gold surplus)."""
    s = sql_session(spark, sf_dir, shop=False)
    return residual_rows(s.sql(RESIDUAL_PAIR.gold), s.sql(RESIDUAL_PAIR.cand))


@query("row_count_diff", oracle=f"""
    SELECT gr AS gold_rows, cr AS cand_rows,
           CASE WHEN cr > gr THEN 'more' WHEN cr < gr THEN 'fewer' ELSE 'same' END AS direction,
           ug AS missing_rows, uc AS extra_rows
    FROM (SELECT (SELECT COUNT(*) FROM ({RESIDUAL_PAIR.gold}) t) AS gr,
                 (SELECT COUNT(*) FROM ({RESIDUAL_PAIR.cand}) t) AS cr,
                 (SELECT COUNT(*) FROM (SELECT * FROM ({RESIDUAL_PAIR.gold}) a EXCEPT ALL
                                        SELECT * FROM ({RESIDUAL_PAIR.cand}) b) t) AS ug,
                 (SELECT COUNT(*) FROM (SELECT * FROM ({RESIDUAL_PAIR.cand}) a EXCEPT ALL
                                        SELECT * FROM ({RESIDUAL_PAIR.gold}) b) t) AS uc) f""")
def row_count_diff(spark, sf_dir):
    """Fewer or more rows, and how many rows each side lacks."""
    s = sql_session(spark, sf_dir, shop=False)
    d = compare(s.sql(RESIDUAL_PAIR.gold), s.sql(RESIDUAL_PAIR.cand))
    direction = "more" if d.cand_rows > d.gold_rows else "fewer" if d.cand_rows < d.gold_rows else "same"
    return spark.createDataFrame(
        [(d.gold_rows, d.cand_rows, direction, d.unmatched_gold, d.unmatched_cand)],
        "gold_rows long, cand_rows long, direction string, missing_rows long, extra_rows long")


_WRONG_ORDER = next(p for p in PAIRS if p.pair_id == "wrong_order")


@query("ordered_diff", oracle=f"""
    SELECT COALESCE(gp.pos, cp.pos) - 1 AS position, gp.c0 AS gold_c0, gp.c1 AS gold_c1,
           cp.c0 AS cand_c0, cp.c1 AS cand_c1,
           (gp.pos IS NOT NULL AND cp.pos IS NOT NULL AND gp.c0 IS NOT DISTINCT FROM cp.c0
            AND gp.c1 IS NOT DISTINCT FROM cp.c1) AS same
    FROM (SELECT row_number() OVER (ORDER BY {_WRONG_ORDER.gold_order}) AS pos, {_oracle_norm(0, 'text')} AS c0,
                 {_oracle_norm(1, 'exact')} AS c1 FROM ({_WRONG_ORDER.gold}) AS g(c0, c1)) gp
    FULL JOIN (SELECT row_number() OVER (ORDER BY {_WRONG_ORDER.cand_order}) AS pos, {_oracle_norm(0, 'text')} AS c0,
                 {_oracle_norm(1, 'exact')} AS c1 FROM ({_WRONG_ORDER.cand}) AS c(c0, c1)) cp ON gp.pos = cp.pos""")
def ordered_diff(spark, sf_dir):
    """Position by position, for a question that asked for an order."""
    s = sql_session(spark, sf_dir, shop=False)
    return ordered_pairs(s.sql(_WRONG_ORDER.gold), s.sql(_WRONG_ORDER.cand), SharedTables(s))


@query("normalize_values", oracle=f"""
    SELECT {_oracle_norm(0, 'float')} AS c0, {_oracle_norm(1, 'float')} AS c1, {_oracle_norm(2, 'text')} AS c2
    FROM ({NORMALIZE_PAIR.cand}) AS c(c0, c1, c2)""")
def normalize_values(spark, sf_dir):
    """The candidate's rows as the comparison sees them (int against float is a
    float pair, rounded to 6 places; text stripped)."""
    from .diff import normalized_values
    s = sql_session(spark, sf_dir, shop=False)
    return normalized_values(s.sql(NORMALIZE_PAIR.gold), s.sql(NORMALIZE_PAIR.cand))


# Results of each shape a scalar view may meet.
SCALAR_CASES = {
    "one_cell": f"SELECT SUM({_CENTS}) AS x FROM orders WHERE o_orderstatus = 'F'",
    "one_null_cell": "SELECT MAX(o_orderkey) AS x FROM orders WHERE o_orderkey < 0",
    "no_rows": "SELECT o_orderkey AS x FROM orders WHERE o_orderkey < 0",
    "two_rows": "SELECT o_orderkey AS x FROM orders WHERE o_orderkey IN (SELECT MIN(o_orderkey) FROM orders "
                "UNION ALL SELECT MAX(o_orderkey) FROM orders)",
    "many_rows": "SELECT o_orderkey AS x FROM orders",
    "two_columns": "SELECT MIN(o_orderkey) AS x, MAX(o_orderkey) AS y FROM orders",
}


def _scalar_oracle() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{k}' AS result, " + ("CAST(NULL AS BIGINT)" if k == "two_columns" else
        f"(SELECT CASE WHEN COUNT(*) = 1 THEN CAST(MAX(x) AS BIGINT) END FROM ({q}) q)") + " AS scalar"
        for k, q in SCALAR_CASES.items())


@query("scalar_view", oracle=_scalar_oracle())
def scalar_view(spark, sf_dir):
    """The one cell of a result, for results of every shape."""
    from ..plans.execute import scalar
    s = sql_session(spark, sf_dir, shop=False)
    return spark.createDataFrame([(k, scalar(s.sql(q))) for k, q in SCALAR_CASES.items()], "result string, scalar long")
