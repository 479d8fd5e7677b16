"""Distributed comparison of two query results (group J).

Two results are the same answer when they hold the same rows as a multiset: order
ignored unless the question asked for one, column names ignored (positions count),
integers compared exactly, floats within an absolute tolerance, text compared after
stripping surrounding whitespace. A failed side is never equal to anything.

How it runs:

1. Columns are renamed by position and each column *pair* gets one comparison type
   (``pair_kind``): exact integers, floats, text, booleans, or "incompatible" (text
   against a number), where only NULL meets NULL.
2. Both sides are tagged, unioned and grouped by every normalized column (floats on
   the 6-place grid); each group carries how many rows each side has. Map-side
   combine collapses duplicates before the one shuffle. Groups whose counts agree are
   settled. In the common case (equal answers) this is the whole cost.
3. Each query runs once. Where more than the grid counts may be asked of a result, what is
   needed is written first and everything reads what was written. Where columns are floats, the
   one shuffle brings rows of a cell of the float columns together: it counts the grid and
   settles what has partners in its cell alone (``cells``), and only sums and the rows that are
   left are written. For fine decimals, a relative tolerance or one finer than the grid, the
   distinct raw rows with their counts per side are. Each side is written with its
   positions where an order was asked for. Comparisons of one batch share what was written
   for the same query (``Positions``).
4. If groups disagree and inexact columns are involved, the rows left (of written distinct
   rows: those of every group of exact column values that holds a disagreement) are matched
   within the tolerance (``matching``). Counts may differ between the sides: the unmatched
   rows are those no matching can pair.
5. Ordered comparison pairs rows by position: a row's place in its partition plus the rows
   of the partitions before.
"""

from __future__ import annotations

import threading
from concurrent.futures import Future
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOLERANCE = 1e-6
GRID = 6

from ..functions.ws import WS_CLASS, strip_ws, strip_ws_sql  # noqa: F401,E402
from ..session import SharedTables  # noqa: E402
from .cells import serves, settle  # noqa: E402
from .matching import close, inexact, unmatched_within, within  # noqa: E402


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def _is_integral(t: T.DataType) -> bool:
    return isinstance(t, _INTEGRAL) or (isinstance(t, T.DecimalType) and t.scale == 0)


def _is_number(t: T.DataType) -> bool:
    return isinstance(t, _INTEGRAL + _FLOATING + (T.DecimalType,))


def _digits(t: T.DataType) -> tuple[int, int]:
    """(precision, scale) of a decimal or integer type."""
    if isinstance(t, T.DecimalType):
        return t.precision, t.scale
    return {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}[type(t)], 0


def pair_kind(a: T.DataType, b: T.DataType) -> str:
    """One comparison type for a column pair.

    exact   both integral, or integral against boolean (True equals 1), compared as
            exact integers: no loss above 2**53
    fixed:s two decimals, or a decimal against an integer, with at most 5 places, where the
            tolerance cannot matter: compared as DECIMAL(38, s)
    decimal the same with more places: compared in decimal, with the tolerance in decimal
    float   a number against a float, or decimals that no DECIMAL(38, s) holds
    text    both strings: compared after stripping whitespace
    bool    both boolean
    same    any other identical type (dates, arrays...): compared as is
    void    nothing but NULL on both sides
    incompatible   text against a number, or other mixed types: only NULL = NULL
    """
    if isinstance(a, T.NullType) and isinstance(b, T.NullType):
        return "void"
    if isinstance(a, T.NullType):
        a = b
    if isinstance(b, T.NullType):
        b = a
    if isinstance(a, T.BooleanType) and isinstance(b, T.BooleanType):
        return "bool"
    if (_is_integral(a) or isinstance(a, T.BooleanType)) and (_is_integral(b) or isinstance(b, T.BooleanType)):
        return "exact"
    if isinstance(a, _INTEGRAL + (T.DecimalType,)) and isinstance(b, _INTEGRAL + (T.DecimalType,)):
        (pa, sa), (pb, sb) = _digits(a), _digits(b)
        scale = max(sa, sb)
        if max(pa - sa, pb - sb) + scale <= 38:
            return f"fixed:{scale}" if scale < GRID else f"decimal:{scale}"
    if _is_number(a) and _is_number(b):
        return "float"
    if isinstance(a, T.BooleanType) and _is_number(b) or isinstance(b, T.BooleanType) and _is_number(a):
        return "float"
    if isinstance(a, T.StringType) and isinstance(b, T.StringType):
        return "text"
    if a == b:
        return "same"
    if {type(a), type(b)} == {T.DateType, T.StringType}:
        return "text"   # a date against its ISO text
    if {type(a), type(b)} <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return "same_ts"
    return "incompatible"


def _normalize(c: Column, kind: str, side: str) -> Column:
    if kind == "exact":
        return c.cast(T.DecimalType(38, 0))
    if kind.startswith(("fixed:", "decimal:")):
        return c.cast(T.DecimalType(38, int(kind.split(":")[1])))
    if kind == "float":
        return c.cast("double")
    if kind == "text":
        return strip_ws(c.cast("string"))
    if kind == "same_ts":
        return c.cast("timestamp")
    if kind == "void":
        return c.cast("string")
    if kind == "incompatible":
        # Tag by side: a value only ever meets NULL.
        return F.when(c.isNotNull(), F.concat(F.lit(side + ":"), c.cast("string")))
    return c


def align(gold: DataFrame, cand: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Positional names c0..cn and one normalized type per column pair."""
    n = min(len(gold.columns), len(cand.columns))
    kinds = [pair_kind(gold.schema[i].dataType, cand.schema[i].dataType) for i in range(n)]
    g = gold.toDF(*[f"c{i}" for i in range(len(gold.columns))])
    c = cand.toDF(*[f"c{i}" for i in range(len(cand.columns))])
    g = g.select(*[_normalize(F.col(f"c{i}"), k, "g").alias(f"c{i}") for i, k in enumerate(kinds)])
    c = c.select(*[_normalize(F.col(f"c{i}"), k, "c").alias(f"c{i}") for i, k in enumerate(kinds)])
    return g, c, kinds


def normalized_values(gold: DataFrame, cand: DataFrame, side: str = "candidate") -> DataFrame:
    """J3 as a table: one side's rows as the comparison sees them, floats on the grid."""
    g, c, kinds = align(gold, cand)
    df = c if side == "candidate" else g
    return df.select(*[(F.round(F.col(f"c{i}"), GRID) if inexact(k) else F.col(f"c{i}")).alias(f"c{i}")
                       for i, k in enumerate(kinds)])


def _grid(df: DataFrame, kinds: list[str]) -> list[Column]:
    return [(F.round(F.col(f"c{i}"), GRID) if inexact(k) else F.col(f"c{i}")).alias(f"c{i}")
            for i, k in enumerate(kinds)]


def signed_groups(g: DataFrame, c: DataFrame, kinds: list[str], keep_raw: bool = False) -> DataFrame:
    """Per distinct normalized row: rows on each side. One shuffle, map-side combined.

    ``keep_raw`` (single-column results) also carries the unrounded value per side,
    so a one-cell answer is settled, tolerance included, by this one job."""
    cols = [f"c{i}" for i in range(len(kinds))]
    raw = [F.col("c0").alias("_raw")] if keep_raw else []
    tagged = (g.select(*_grid(g, kinds), F.lit(1).alias("_g"), F.lit(0).alias("_c"), *raw)
              .unionByName(c.select(*_grid(c, kinds), F.lit(0).alias("_g"), F.lit(1).alias("_c"), *raw)))
    aggs = [F.sum("_g").cast("long").alias("n_gold"), F.sum("_c").cast("long").alias("n_cand")]
    if keep_raw:
        aggs += [F.max(F.when(F.col("_g") == 1, F.col("_raw"))).alias("raw_gold"),
                 F.max(F.when(F.col("_c") == 1, F.col("_raw"))).alias("raw_cand")]
    if not cols:   # zero-column results: only the counts matter
        return tagged.agg(*aggs)
    return tagged.groupBy(*cols).agg(*aggs)


def residual_rows(gold: DataFrame, cand: DataFrame) -> DataFrame:
    """J5 residual: rows one side has more often than the other, with the surplus.

    Floats are compared on the 6-place grid here (the exact step); the tolerance
    re-pairing is done by ``compare``."""
    g, c, kinds = align(gold, cand)
    groups = signed_groups(g, c, kinds)
    d = F.col("n_gold") - F.col("n_cand")
    return (groups.where(d != 0)
            .select(*[f"c{i}" for i in range(len(kinds))],
                    F.when(d > 0, F.lit("gold")).otherwise(F.lit("candidate")).alias("side"),
                    F.abs(d).alias("excess_rows")))


# --- positions (ordered results) -------------------------------------------------------

def with_position(df: DataFrame, tables: SharedTables, name: str = "_pos", keep_pid: bool = False) -> DataFrame:
    """Attach the 0-based row position of a result in its current order.

    The result is written once with each row's partition and place in it, so that both
    are fixed; a position is then that place plus the row count of all earlier
    partitions. The offsets table has one row per partition."""
    tagged = tables.put(df.select("*", F.spark_partition_id().alias("_pid"),
                                  F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_local")))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (tagged.join(offsets, "_pid")
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_local")).alias(name),
                    *([F.col("_pid")] if keep_pid else [])))


class Positions:
    """Results with positions, written once each: of deterministic plans that Spark finds to
    be the same (a trusted query beside several candidates, a candidate that repeats it), the
    first one's rows serve all. May be asked from several threads."""

    def __init__(self, tables: SharedTables):
        self.tables, self.lock = tables, threading.Lock()
        self.held: dict[int, list[tuple[DataFrame, Future]]] = {}

    def of(self, df: DataFrame) -> DataFrame:
        if not df._jdf.queryExecution().analyzed().deterministic():
            return with_position(df, self.tables)
        with self.lock:
            alike = self.held.setdefault(df.semanticHash(), [])
            done = next((f for other, f in alike if other.columns == df.columns and other.sameSemantics(df)), None)
            mine = done is None
            if mine:
                done = Future()
                alike.append((df, done))
        if mine:
            try:
                done.set_result(with_position(df, self.tables))
            except Exception as exc:  # noqa: BLE001  the failure of every comparison that asks
                done.set_exception(exc)
        return done.result()


# --- the comparison ---------------------------------------------------------------------------

@dataclass
class Diff:
    """Facts about one comparison; ``equal`` is the verdict input."""
    gold_rows: int = 0
    cand_rows: int = 0
    gold_arity: int = 0
    cand_arity: int = 0
    arity_match: bool = True
    unmatched_gold: int = 0
    unmatched_cand: int = 0
    equal: bool = False
    bag_equal: bool = False
    ordered: bool = False
    approximate: bool = False
    kinds: list[str] = field(default_factory=list)
    gold_value: object = None     # the cell of a one-row, one-column result
    cand_value: object = None


@dataclass
class Prepared:
    """A comparison whose queries have run as far as they must: ``groups`` (counts per side
    of each grid row) is a plan over the queries themselves or over what was written."""
    key: str
    gold: DataFrame
    cand: DataFrame
    ordered: bool
    kinds: list[str]
    groups: DataFrame | None = None
    multiset: DataFrame | None = None                          # distinct raw rows, written
    settled: DataFrame | None = None                           # sums and rows left of ``cells``, written
    positions: tuple[DataFrame, DataFrame] | None = None       # both sides, written


def at_most_one_row(df: DataFrame) -> bool:
    most = df._jdf.queryExecution().analyzed().maxRows()
    return most.isDefined() and most.get() <= 1


def prepare(key: str, gold: DataFrame, cand: DataFrame, ordered: bool, tables: SharedTables,
            positions: Positions | None = None, tol: float = TOLERANCE, rel_tol: float = 0.0) -> Prepared:
    """Write what will be read more than once."""
    if len(gold.columns) != len(cand.columns):
        return Prepared(key, gold, cand, ordered, [])
    g, c, kinds = align(gold, cand)
    out = Prepared(key, gold, cand, ordered, kinds)
    if ordered:
        positions = positions or Positions(tables)
        out.positions = positions.of(g), positions.of(c)
        g, c = (p.drop("_pos") for p in out.positions)
    single = len(kinds) == 1
    if any(map(inexact, kinds)) and not (single and at_most_one_row(gold) and at_most_one_row(cand)):
        if serves(g.schema, kinds, tol, rel_tol):
            out.settled = settle(g, c, kinds, tol, GRID, tables)
            return out
        names = [F.col(f"c{i}") for i in range(len(kinds))]
        tagged = g.select(*names, F.lit(1).alias("_g"), F.lit(0).alias("_c")).unionByName(
            c.select(*names, F.lit(0).alias("_g"), F.lit(1).alias("_c")))
        out.multiset = tables.put(tagged.groupBy(*names).agg(
            F.sum("_g").cast("long").alias("n_gold"), F.sum("_c").cast("long").alias("n_cand")))
        raw = [F.max(F.when(F.col(f"_n{side}") > 0, F.col("_raw"))).alias(name)
               for side, name in (("g", "raw_gold"), ("c", "raw_cand"))] if single else []
        out.groups = out.multiset.select(
            *_grid(out.multiset, kinds), F.col("n_gold").alias("_ng"), F.col("n_cand").alias("_nc"),
            *([F.col("c0").alias("_raw")] if single else [])).groupBy(*[f"c{i}" for i in range(len(kinds))]).agg(
            F.sum("_ng").alias("n_gold"), F.sum("_nc").alias("n_cand"), *raw)
    else:
        out.groups = signed_groups(g, c, kinds, keep_raw=single)
    return out


def _surplus(p: Prepared) -> tuple[DataFrame, tuple[Column, Column]]:
    """Rows with the counts of a comparison, and what either side has more often on the grid."""
    d = F.col("n_gold") - F.col("n_cand")
    more, fewer = F.greatest(d, F.lit(0)), F.greatest(-d, F.lit(0))
    if p.settled is None:
        return p.groups, (more, fewer)
    raw = ["raw_gold", "raw_cand"] if len(p.kinds) == 1 else []
    counted = p.settled.where("left = 0").select("n_gold", "n_cand", *raw, "ug", "uc")
    rows = p.settled.where("left = 2")
    kept = [F.max(F.when(F.col(f"_n{side}") > 0, F.col("_raw"))).alias(name) for side, name in zip("gc", raw)]
    others = rows.select(*_grid(rows, p.kinds), F.col("n_gold").alias("_ng"), F.col("n_cand").alias("_nc"),
                         *([F.col("c0").alias("_raw")] if raw else []))
    others = others.groupBy(*[f"c{i}" for i in range(len(p.kinds))]).agg(
        F.sum("_ng").alias("n_gold"), F.sum("_nc").alias("n_cand"), *kept)
    others = others.select("n_gold", "n_cand", *raw, more.alias("ug"), fewer.alias("uc"))
    return counted.unionByName(others), (F.col("ug"), F.col("uc"))


def _summary(p: Prepared, tol: float = TOLERANCE, rel_tol: float = 0.0) -> DataFrame:
    """One row of counts for a comparison: rows and unmatched rows per side, and for a
    single-column result its cell per side (as text and as a number).

    For an ordered comparison a second row (key + ORDERED_SUFFIX, positional mismatches in
    ``g``) is unioned in, so the position check runs in the same job."""
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    if len(p.gold.columns) != len(p.cand.columns):
        both = (p.gold.select(F.lit(1).alias("_g"), F.lit(0).alias("_c"))
                .unionByName(p.cand.select(F.lit(0).alias("_g"), F.lit(1).alias("_c"))))
        g, c = F.coalesce(F.sum("_g"), F.lit(0)).cast("long"), F.coalesce(F.sum("_c"), F.lit(0)).cast("long")
        return both.agg(F.lit(p.key).alias("pid"), g.alias("g"), c.alias("c"), g.alias("ug"), c.alias("uc"),
                        none_s.alias("gv_s"), none_s.alias("cv_s"), none_d.alias("gv_d"), none_d.alias("cv_d"))
    single = len(p.kinds) == 1
    groups, (more, fewer) = _surplus(p)
    numeric = single and (p.kinds[0] == "exact" or inexact(p.kinds[0]) or p.kinds[0].startswith("fixed:"))
    gv, cv = F.max("raw_gold"), F.max("raw_cand")
    out = groups.agg(
        F.lit(p.key).alias("pid"),
        F.coalesce(F.sum("n_gold"), F.lit(0)).cast("long").alias("g"),
        F.coalesce(F.sum("n_cand"), F.lit(0)).cast("long").alias("c"),
        F.coalesce(F.sum(more), F.lit(0)).cast("long").alias("ug"),
        F.coalesce(F.sum(fewer), F.lit(0)).cast("long").alias("uc"),
        (gv.cast("string") if single else none_s).alias("gv_s"),
        (cv.cast("string") if single else none_s).alias("cv_s"),
        (gv.cast("double") if numeric else none_d).alias("gv_d"),
        (cv.cast("double") if numeric else none_d).alias("cv_d"))
    if p.positions:
        none_l = F.lit(None).cast("long")
        pos = positions_paired(*p.positions, p.kinds, tol, rel_tol).agg(
            F.lit(p.key + ORDERED_SUFFIX).alias("pid"), F.count_if(~F.col("same")).cast("long").alias("g"),
            none_l.alias("c"), none_l.alias("ug"), none_l.alias("uc"), none_s.alias("gv_s"),
            none_s.alias("cv_s"), none_d.alias("gv_d"), none_d.alias("cv_d"))
        out = out.unionByName(pos)
    return out


# Marks the positional-mismatch row of an ordered comparison in a summary.
ORDERED_SUFFIX = "#positions"


def _cell(kind: str, text, number):
    if text is None:
        return None
    if kind == "float":
        return number
    if kind == "exact" or kind.startswith(("fixed:", "decimal:")):
        return Decimal(text)
    if kind == "bool":
        return text == "true"
    return text


def _finish(rows: dict, p: Prepared, tol: float, rel_tol: float, tables: SharedTables) -> Diff:
    """Turn summary rows into a Diff; match within the tolerance where the grid disagrees."""
    row, kinds = rows[p.key], p.kinds
    ga, ca = len(p.gold.columns), len(p.cand.columns)
    out = Diff(gold_arity=ga, cand_arity=ca, arity_match=ga == ca, ordered=p.ordered, kinds=kinds)
    out.gold_rows, out.cand_rows = int(row["g"]), int(row["c"])
    out.unmatched_gold, out.unmatched_cand = int(row["ug"]), int(row["uc"])
    if ga != ca:
        # Empty against empty is equal at any arity: arity is a property of rows.
        out.bag_equal = out.equal = out.gold_rows == 0 and out.cand_rows == 0
        return out
    one_cell = ga == 1 and out.gold_rows == 1 and out.cand_rows == 1
    if one_cell:
        out.gold_value = _cell(kinds[0], row["gv_s"], row["gv_d"])
        out.cand_value = _cell(kinds[0], row["cv_s"], row["cv_d"])
    off_grid = bool(out.unmatched_gold or out.unmatched_cand)
    if off_grid and any(map(inexact, kinds)):
        if one_cell:
            out.unmatched_gold = out.unmatched_cand = int(not close(out.gold_value, out.cand_value, tol, rel_tol))
        elif p.settled is not None:
            names = [f"c{i}" for i in range(len(kinds))]
            left = p.settled.where("left > 0").select(*names, "n_gold", "n_cand")
            done = p.settled.where("left = 0").agg(F.sum("sg").alias("sg"), F.sum("sc").alias("sc")).first()
            out.unmatched_gold, out.unmatched_cand = int(done["sg"] or 0), int(done["sc"] or 0)
            if not left.isEmpty():
                gold, cand = unmatched_within(left, kinds, None, tol, rel_tol, tables)
                out.unmatched_gold, out.unmatched_cand = out.unmatched_gold + gold, out.unmatched_cand + cand
        elif p.multiset is not None:
            exact = [f"c{i}" for i, k in enumerate(kinds) if not inexact(k)]
            disagree = p.groups.where("n_gold <> n_cand").select(*exact).distinct()
            out.unmatched_gold, out.unmatched_cand = unmatched_within(p.multiset, kinds, disagree, tol, rel_tol, tables)
    out.bag_equal = out.unmatched_gold == 0 and out.unmatched_cand == 0
    out.approximate = out.bag_equal and off_grid
    out.equal = out.bag_equal
    if p.ordered and out.bag_equal and out.gold_rows > 1:
        out.equal = int(rows[p.key + ORDERED_SUFFIX]["g"]) == 0
    return out


def compare(gold: DataFrame, cand: DataFrame, ordered: bool = False, tol: float = TOLERANCE,
            rel_tol: float = 0.0) -> Diff:
    """Compare two results. Eager: one job for the grouped counts, more only when
    floats need matching or an order must be checked.

    ``tol`` is the absolute float tolerance (the reference's 1e-6). ``rel_tol``, off by
    default, also accepts floats within that fraction of the larger magnitude: the last
    digits of a large distributed float sum depend on the order partitions are added
    in, which an absolute bound cannot absorb."""
    with SharedTables(gold.sparkSession) as tables:
        p = prepare("x", gold, cand, ordered, tables, tol=tol, rel_tol=rel_tol)
        rows = {r["pid"]: r for r in _summary(p, tol, rel_tol).collect()}
        return _finish(rows, p, tol, rel_tol, tables)


# Pairs per comparison job: enough to share gold queries and fill the cluster, few
# enough that the unioned plan stays small for the optimizer.
BATCH = 32


def compare_batch(items: list[tuple[str, DataFrame, DataFrame, bool]], tol: float = TOLERANCE,
                  batch: int | None = None, workers: int = 4, rel_tol: float = 0.0) -> dict:
    """Compare many pairs, ``batch`` pairs per Spark job. Within a job the per-pair
    summaries are unioned into one plan, so their stages run together and identical
    sub-plans (the same gold query under several candidates) share their exchanges;
    a few jobs run at once from threads. If a job fails, its pairs are halved until the
    failing ones stand alone; each result is a ``Diff`` or the exception its own
    comparison raised."""
    from concurrent.futures import ThreadPoolExecutor
    size = batch or BATCH
    chunks = [items[i:i + size] for i in range(0, len(items), size)]
    out: dict = {}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for part in pool.map(lambda ch: _compare_chunk(ch, tol, rel_tol), chunks):
            out.update(part)
    return out


def _compare_chunk(items: list[tuple[str, DataFrame, DataFrame, bool]], tol: float,
                   rel_tol: float = 0.0) -> dict:
    if not items:
        return {}
    # Analysing a plan is driver work and results are written one by one: both from threads.
    from concurrent.futures import ThreadPoolExecutor
    with SharedTables(items[0][1].sparkSession) as tables:
        positions = Positions(tables)

        def ready(item) -> Prepared | Exception:
            try:
                return prepare(*item, tables, positions, tol, rel_tol)
            except Exception as exc:  # noqa: BLE001  the pair's own failure
                return exc

        with ThreadPoolExecutor(max_workers=8) as pool:
            prepared = list(pool.map(ready, items))
        out: dict = {item[0]: p for item, p in zip(items, prepared) if isinstance(p, Exception)}
        out |= _summarized([p for p in prepared if isinstance(p, Prepared)], tol, rel_tol, tables)
    return out


def _summarized(parts: list[Prepared], tol: float, rel_tol: float, tables: SharedTables) -> dict:
    """Results of prepared comparisons from one job, halved where a query fails at run time."""
    if not parts:
        return {}
    try:
        rows = {r["pid"]: r for r in reduce(DataFrame.unionByName, [_summary(p, tol, rel_tol) for p in parts]).collect()}
    except Exception as exc:  # noqa: BLE001  some query fails at run time: halve to find which
        if len(parts) == 1:
            return {parts[0].key: exc}
        half = len(parts) // 2
        return _summarized(parts[:half], tol, rel_tol, tables) | _summarized(parts[half:], tol, rel_tol, tables)
    out = {}
    for p in parts:
        try:
            out[p.key] = _finish(rows, p, tol, rel_tol, tables)
        except Exception as exc:  # noqa: BLE001
            out[p.key] = exc
    return out


def positions_paired(gp: DataFrame, cp: DataFrame, kinds: list[str], tol: float = TOLERANCE,
                     rel_tol: float = 0.0) -> DataFrame:
    """Position-by-position pairing of two aligned results with positions (full outer on
    position)."""
    gp, cp = gp.alias("g"), cp.alias("c")
    same = reduce(lambda x, y: x & y,
                  [within(F.col(f"g.c{i}"), F.col(f"c.c{i}"), k, tol, rel_tol) for i, k in enumerate(kinds)],
                  F.lit(True))
    return gp.join(cp, F.col("g._pos") == F.col("c._pos"), "full_outer").select(
        F.coalesce(F.col("g._pos"), F.col("c._pos")).alias("position"),
        *[F.col(f"g.c{i}").alias(f"gold_c{i}") for i in range(len(kinds))],
        *[F.col(f"c.c{i}").alias(f"cand_c{i}") for i in range(len(kinds))],
        (F.col("g._pos").isNotNull() & F.col("c._pos").isNotNull() & same).alias("same"))


def ordered_pairs(gold: DataFrame, cand: DataFrame, tables: SharedTables) -> DataFrame:
    """Two results row by row in their own order. Reads ``tables``, which must outlive it."""
    g, c, kinds = align(gold, cand)
    return positions_paired(with_position(g, tables), with_position(c, tables), kinds)
