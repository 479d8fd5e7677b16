"""How many rows a join makes, drops and repeats, without building a pair.

Equality keys are counted per key value on either side. A range condition on top of them
(or alone) is counted by one sorted sweep: with the points of the right rows and the ends of
the left rows' ranges in one order, running totals of points tell how many right rows lie
below each end, and a left row's partners are the difference of two such totals. The order is
a range sort by (keys, value) and totals are per-partition sums plus the partitions' before,
so neither a hot key nor a join without any key gathers its rows in a task. Conditions on one
side alone filter that side; ``<>`` is the key's rows less the equal ones.

A lateral join is rewritten by Spark's own decorrelation into a join on the columns its
subquery referred to, and counted as that. What none of this covers is left unknown; no join
is ever run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import SharedTables
from .matching import numbered, running

COUNTS = ("left_rows", "right_rows", "joined_rows", "dropped_rows", "repeated_rows")
# Join types whose output size follows from how many partners each row has.
SIZED = ("Inner", "LeftOuter", "RightOuter", "FullOuter", "LeftSemi", "LeftAnti")
_DEC = "decimal(38,0)"


def plan_rows(session, plan) -> DataFrame:
    return DataFrame(session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, plan), session)


def projected(session, plan, columns: dict, filters=()) -> DataFrame:
    """``plan`` filtered by Catalyst predicates and projected to named Catalyst expressions."""
    jvm = session._jvm
    catalyst = jvm.org.apache.spark.sql.catalyst
    none = jvm.scala.Option.empty()
    nothing = jvm.org.apache.spark.api.python.PythonUtils.toSeq([])
    for f in filters:
        plan = catalyst.plans.logical.Filter(f, plan)
    if not columns:
        return plan_rows(session, plan).select()
    named = [catalyst.expressions.Alias(e, name, catalyst.expressions.NamedExpression.newExprId(), nothing, none, nothing)
             for name, e in columns.items()]
    out = catalyst.plans.logical.Project(jvm.org.apache.spark.api.python.PythonUtils.toSeq(named), plan)
    return plan_rows(session, out)


def decorrelated(session, j):
    """A lateral join as a join with a plain right side, or None."""
    optimizer = session._jvm.org.apache.spark.sql.catalyst.optimizer
    plan = optimizer.RewriteLateralSubquery.apply(optimizer.PullupCorrelatedPredicates.apply(j))
    while plan.nodeName() in ("Project", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan if plan.nodeName() == "Join" else None


@dataclass
class Condition:
    """A join condition taken apart. ``ranges`` holds (left, right, operator) with the
    operator read as ``right operator left``; ``unequal`` (left, right)."""
    keys: list[tuple] = field(default_factory=list)
    left_only: list = field(default_factory=list)
    right_only: list = field(default_factory=list)
    ranges: list[tuple] = field(default_factory=list)
    unequal: list[tuple] = field(default_factory=list)


_FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}
_OPERATORS = {"LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}


def taken_apart(session, j) -> Condition | None:
    """The condition of a join, or None where a part of it is of no known form."""
    out = Condition()
    left, right = j.left().outputSet(), j.right().outputSet()
    stack = [j.condition().get()] if j.condition().isDefined() else []
    while stack:
        e = stack.pop()
        name = e.getClass().getSimpleName()
        refs = e.references()
        if not e.deterministic():
            return None
        if name == "And":
            stack += [e.left(), e.right()]
        elif name == "Between":
            comparison = session._jvm.org.apache.spark.sql.catalyst.expressions
            stack += [comparison.GreaterThanOrEqual(e.input(), e.lower()), comparison.LessThanOrEqual(e.input(), e.upper())]
        elif refs.subsetOf(left):
            out.left_only.append(e)
        elif refs.subsetOf(right):
            out.right_only.append(e)
        else:
            inner = e.child() if name == "Not" and e.child().getClass().getSimpleName() == "EqualTo" else e
            if inner.getClass().getSimpleName() not in {"EqualTo", *_OPERATORS}:
                return None
            a, b = inner.left(), inner.right()
            if a.references().subsetOf(left) and b.references().subsetOf(right):
                flip = True
            elif a.references().subsetOf(right) and b.references().subsetOf(left):
                a, b, flip = b, a, False
            else:
                return None
            if name == "EqualTo":
                out.keys.append((a, b))
            elif name == "Not":
                out.unequal.append((a, b))
            else:
                op = _OPERATORS[name]
                out.ranges.append((a, b, _FLIPPED[op] if flip else op))
    return out


def partners(probe: DataFrame, points: DataFrame, keys: list[str], upper: str | None, lower: str | None,
             tables: SharedTables) -> DataFrame:
    """``probe`` rows (_id, keys, u, l, n) with ``m``, the number of point rows (keys, u, l,
    n) of their key with ``point.u upper probe.u`` (< or <=) and ``point.l lower probe.l``
    (> or >=); None stands for no condition.

    m = points with a small enough u, less points whose l is too small. That the second are
    among the first is for the caller to see to."""
    first = [F.col(k).asc() for k in keys]
    zero = F.lit(0).cast("long")
    none = F.lit(None)

    def events(df, value, end, order, one, two, tag):
        # end: -1 before all values of the key, 1 after them.
        return df.select(*keys, F.lit(end).alias("_end"), (F.col(value) if value else none.cast(kind)).alias("_v"),
                         F.lit(order).alias("_order"), one.alias("_one"), two.alias("_two"), tag.alias("_tag"),
                         (F.col("_id") if "_id" in df.columns else none.cast("long")).alias("_id"))

    kind = points.schema["u" if upper else "l"].dataType if upper or lower else "int"
    n = F.col("n")
    first_point, second_point, ask_first, ask_second = F.lit(0), F.lit(0), F.lit(1), F.lit(2)
    parts = [
        events(points, "u" if upper else None, 0 if upper else -1, 0 if upper in (None, "<=") else 1, n, zero, first_point),
        events(points, "l" if lower else None, 0 if lower else 1, 0 if lower == ">" else 1, zero, n, second_point),
        events(probe, "u" if upper else None, 0, 0 if upper == "<" else 1, zero, zero, ask_first),
        events(probe, "l" if lower else None, 0, 0 if lower == ">=" else 1, zero, zero, ask_second)]
    fixed = numbered(reduce(DataFrame.unionByName, parts),
                     [*first, F.col("_end"), F.col("_v"), F.col("_order")], tables)
    totals = running(fixed, {"below": "_one", "past": "_two"}).where("_tag > 0")
    per_row = totals.groupBy("_id").agg(F.sum(F.when(F.col("_tag") == 1, F.col("below")).otherwise(-F.col("past"))).alias("m"))
    return probe.join(per_row, "_id").select("n", F.greatest("m", F.lit(0)).alias("m"))


def unequal_partners(probe: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """``probe`` rows with the number of point rows of their key whose value is another."""
    same = points.groupBy(*keys, "u").agg(F.sum("n").alias("same"))
    out = probe.join(same, [*keys, "u"], "left")
    if keys:
        out = out.join(points.groupBy(*keys).agg(F.sum("n").alias("all")), keys, "left")
    else:
        out = out.withColumn("all", F.lit(points.agg(F.sum("n").alias("n")).first()["n"]).cast("long"))
    return out.select("n", (F.coalesce("all", F.lit(0)) - F.coalesce("same", F.lit(0))).alias("m"))


def _total(c):
    return F.coalesce(F.sum(c.cast(_DEC)), F.lit(0)).cast(_DEC)


def _spread(counted: DataFrame) -> dict:
    """What the partner counts (n rows with m partners) add up to."""
    n, m = F.col("n").cast("decimal(19,0)"), F.col("m").cast("decimal(19,0)")
    return counted.agg(_total(n * m).alias("pairs"), _total(F.when(m > 0, n).otherwise(0)).alias("met"),
                       _total(F.when(m > 1, n * (m - 1)).otherwise(0)).alias("repeated")).first().asDict()


def _rows(session, plan) -> int:
    return plan_rows(session, plan).agg(F.count(F.lit(1)).alias("n")).first()["n"]


def _by_join_type(kind: str, left: int, right: int, spread: dict, right_met) -> dict:
    pairs, met = int(spread["pairs"]), int(spread["met"])
    lone_left = left - met
    out = {"Inner": pairs, "LeftOuter": pairs + lone_left, "LeftSemi": met, "LeftAnti": lone_left}.get(kind)
    if kind in ("RightOuter", "FullOuter"):
        out = pairs + right - right_met + (lone_left if kind == "FullOuter" else 0)
    dropped = {"Inner": lone_left, "RightOuter": lone_left, "LeftSemi": lone_left, "LeftAnti": met}.get(kind, 0)
    repeated = 0 if kind in ("LeftSemi", "LeftAnti") else int(spread["repeated"])
    return dict(zip(COUNTS, (left, right, out, dropped, repeated)))


def _bounds(c: Condition):
    """(upper term, lower term), each (left, right, operator) or None; None altogether if
    there are two of one direction, or other forms beside a range."""
    if c.unequal:
        return None
    upper = [t for t in c.ranges if t[2] in ("<", "<=")]
    lower = [t for t in c.ranges if t[2] in (">", ">=")]
    if len(upper) > 1 or len(lower) > 1:
        return None
    return (upper or [None])[0], (lower or [None])[0]


def _same(a, b) -> bool:
    return a.semanticEquals(b)


def _grouped(session, plan, key_exprs: list, u, low, filters: list) -> tuple[DataFrame, list[str]]:
    keys = [f"k{i}" for i in range(len(key_exprs))]
    columns = dict(zip(keys, key_exprs))
    if u is not None:
        columns["u"] = u
    if low is not None:
        columns["l"] = low
    rows = projected(session, plan, columns, filters)
    for name in columns:   # NULL meets nothing
        rows = rows.where(F.col(name).isNotNull())
    names = list(columns)
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), keys


def sized(session, j) -> dict | None:
    """Counts of a join with equality keys, one-sided conditions and a range or ``<>``; None
    where its condition or type is of another form. Runs its counting jobs at once."""
    kind = j.joinType().toString()
    c = taken_apart(session, j) if kind in SIZED else None
    if c is None:
        return None
    left, right = _rows(session, j.left()), _rows(session, j.right())
    lk, rk = [a for a, _ in c.keys], [b for _, b in c.keys]
    with SharedTables(session) as tables:
        def grouped(plan, keys, u, low, filters) -> tuple[DataFrame, list[str]]:
            rows, names = _grouped(session, plan, keys, u, low, filters)
            return tables.put(rows.withColumn("_id", F.monotonically_increasing_id())), names

        if c.unequal:
            if len(c.unequal) > 1 or c.ranges:
                return None
            (a, b), = c.unequal
            ls, names = grouped(j.left(), lk, a, None, c.left_only)
            rs, _ = grouped(j.right(), rk, b, None, c.right_only)
            spread = _spread(unequal_partners(ls, rs, names))
            back = _spread(unequal_partners(rs, ls, names)) if kind in ("RightOuter", "FullOuter") else None
            return _by_join_type(kind, left, right, spread, int(back["met"]) if back else None)

        bounds = _bounds(c)
        if bounds is None:
            return None
        upper, lower = bounds
        both = [t for t in bounds if t]
        types = {t[i].dataType().sql() for t in both for i in (0, 1)}
        if len(types) > 1:
            return None
        ls, names = grouped(j.left(), lk, upper and upper[0], lower and lower[0], c.left_only)
        rs, _ = grouped(j.right(), rk, upper and upper[1], lower and lower[1], c.right_only)
        up, low = upper and upper[2], lower and lower[2]
        if upper and lower:
            strict = "<" in (up, low) or ">" in (up, low)
            # right.u < left.u and right.l > left.l: ranges of right rows (u to l) and of left rows (l to u).
            right_empty, left_empty = ("u >= l", "l >= u") if strict else ("u > l", "l > u")
            if _same(upper[0], lower[0]):       # a left point in ranges of the right: empty ones meet nothing
                rs = rs.where(f"not ({right_empty})")
            elif _same(upper[1], lower[1]):     # right points in a range of the left
                ls = ls.where(f"not ({left_empty})")
            elif not rs.where(right_empty).isEmpty() or not ls.where(left_empty).isEmpty():
                return None                     # overlaps of ranges, some of them empty
        spread = _spread(partners(ls, rs, names, up, low, tables))
        back = None
        if kind in ("RightOuter", "FullOuter"):
            # Seen from the right the terms change places and direction.
            swap = [F.col("l").alias("u")] if low else []
            swap += [F.col("u").alias("l")] if up else []
            turned = [s.select("_id", "n", *names, *swap) for s in (rs, ls)]
            back = _spread(partners(*turned, names, _FLIPPED[low] if low else None, _FLIPPED[up] if up else None, tables))
        return _by_join_type(kind, left, right, spread, int(back["met"]) if back else None)
