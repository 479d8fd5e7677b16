"""Most rows of two multisets that can be paired within a tolerance.

Rows match when their exact columns are equal and every inexact one (floats, fine
decimals) lies within the tolerance. The number of rows left unpaired on either side must
not depend on row order, so it comes from a largest matching:

- **One inexact column**: partners form intervals of the sorted values, and pairing the
  oldest open row first is optimal. Swept in order, the only state is one signed number:
  how many rows of one side are open. An arrival adds to it, a row leaving the tolerance
  clips it; so what a whole partition does to the number is one clamp function with two
  losses, five integers. Partitions are swept on their own, their functions applied in
  turn. No group, run or window of values is gathered, however dense the column is.
- **Several inexact columns**: rows are cut into runs of neighbours, column by column; runs
  no wider than the tolerance are settled by two sums. Wider ones that disagree become a
  graph: rows are joined on slabs of tolerance width and their neighbours, free rows are
  paired in rounds of proposals, and augmenting paths, found by breadth-first joins from all
  free rows at once, complete the matching. Rounds are joins over written tables; only
  their number depends on how far a chain of shifted rows must move.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import SharedTables


def inexact(kind: str) -> bool:
    """Whether values of this kind match within a tolerance."""
    return kind == "float" or kind.startswith("decimal:")


def within(a: Column, b: Column, kind: str, tol: float, rel_tol: float = 0.0) -> Column:
    """Equal, or for inexact kinds within ``tol``, or within ``rel_tol`` of the larger
    magnitude when a relative tolerance is given (off by default)."""
    if inexact(kind):
        return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= _bound(a, b, kind, tol, rel_tol), F.lit(False))
    return a.eqNullSafe(b)


def _bound(a: Column, b: Column, kind: str, tol: float, rel_tol: float) -> Column:
    fixed = F.lit(tol) if kind == "float" else F.lit(Decimal(repr(tol)))
    if not rel_tol:
        return fixed
    return F.greatest(fixed.cast("double"), F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)).cast("double"))


def close(a, b, tol: float, rel_tol: float = 0.0) -> bool:
    """``within`` for two Python numbers."""
    if a is None or b is None:
        return a is b
    if isinstance(a, Decimal):
        return abs(a - b) <= max(Decimal(repr(tol)), Decimal(repr(rel_tol)) * max(abs(a), abs(b)))
    return a == b or abs(a - b) <= max(tol, rel_tol * max(abs(a), abs(b)))


def value_class(c: Column, kind: str) -> Column:
    """What matches only its own kind among inexact values: NULL, NaN, the infinities."""
    if kind != "float":
        return F.when(c.isNull(), F.lit("null")).otherwise(F.lit("number"))
    return (F.when(c.isNull(), F.lit("null")).when(F.isnan(c), F.lit("nan"))
            .when(c == float("inf"), F.lit("inf")).when(c == float("-inf"), F.lit("-inf")).otherwise(F.lit("number")))


# --- one inexact column: a sweep -----------------------------------------------------------------

def furthest_float(v: np.ndarray, tol: float, rel_tol: float = 0.0) -> np.ndarray:
    """The largest double that is still within the tolerance of each value, by bisection
    over the doubles in order: exactly what subtracting and comparing would say."""
    sign = np.uint64(1 << 63)

    def to_order(x):
        bits = x.view(np.uint64)
        return np.where(bits & sign, ~bits, bits | sign)

    def to_float(order):
        return np.where(order & sign, order ^ sign, ~order).view(np.float64)

    low, high = to_order(v), to_order(np.full(len(v), np.inf))
    with np.errstate(over="ignore", invalid="ignore"):
        # A first guess just above leaves a few steps for all but extreme values.
        guess = to_order(np.minimum(v + 2 * np.maximum(tol, rel_tol * np.abs(v) / (1 - rel_tol)), np.finfo(float).max))
        for trial in [guess] + [None] * 64:
            middle = low + (high - low) // np.uint64(2) if trial is None else np.maximum(trial, low)
            w = to_float(middle)
            fits = (w - v <= np.maximum(tol, rel_tol * np.maximum(np.abs(v), np.abs(w)))) & np.isfinite(w)
            low, high = np.where(fits, middle, low), np.where(fits, high, np.minimum(high, middle))
            if (high - low <= 1).all():
                break
    return to_float(low)


def furthest_decimal(v: Decimal, scale: int, tol: float, rel_tol: float = 0.0) -> Decimal | None:
    """The same for a decimal of ``scale`` places; None beyond 38 digits."""
    with localcontext() as ctx:
        ctx.prec = 100
        end = v + Decimal(repr(tol))
        if rel_tol:
            rel = Decimal(repr(rel_tol))
            end = max(end, v / (1 - rel) if v > 0 else v * (1 - rel))
        end = (end * 10 ** scale).to_integral_value("ROUND_FLOOR").scaleb(-scale)
        return end if abs(end) < Decimal(10) ** (38 - scale) else None


def furthest(c: Column, kind: str, tol: float, rel_tol: float) -> Column:
    """The largest value of a column's type that is within the tolerance of each."""
    if kind == "float":
        @F.pandas_udf("double")
        def ends(v: pd.Series) -> pd.Series:
            known = v.notna().to_numpy()
            out = np.full(len(v), np.nan)
            out[known] = furthest_float(v.to_numpy(np.float64)[known], tol, rel_tol)
            return pd.Series(out).where(known, None)
        return F.when(c.isNotNull(), ends(c))
    scale = int(kind.split(":")[1])

    @F.pandas_udf(f"decimal(38, {scale})")
    def decimal_ends(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None else furthest_decimal(x, scale, tol, rel_tol))
    return F.when(c.isNotNull(), decimal_ends(c))


def numbered(rows: DataFrame, order: list[Column], tables: SharedTables) -> DataFrame:
    """``rows`` range-sorted and written, with each one's partition and place in it."""
    return tables.put(rows.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_at")))


def running(fixed: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Running totals of columns in the order of ``numbered`` rows: inside a partition, plus
    the totals of the partitions before it (one row per partition, so sent to all)."""
    here = Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = fixed.groupBy("_pid").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).select(
        "_pid", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums])
    inside = fixed.select("*", *[F.sum(c).over(here).alias(n) for n, c in sums.items()])
    return inside.join(F.broadcast(totals), "_pid").withColumns(
        {n: F.col(n) + F.col(f"_before_{n}") for n in sums}).drop(*[f"_before_{n}" for n in sums])


def totalled(ordered: DataFrame, tables: SharedTables) -> DataFrame:
    """Range-sorted rows, written, with the running totals ``gold`` and ``cand`` of ``ng`` and ``nc``:
    those inside a partition are added up while it is written."""
    def run(batches):
        import pyarrow as pa
        before = [0, 0]
        for batch in batches:
            sums = [np.cumsum(batch.column(n).to_numpy()) + b for n, b in zip(("ng", "nc"), before)]
            if batch.num_rows:
                before = [int(x[-1]) for x in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in sums)],
                                             names=[*batch.schema.names, "gold", "cand"])

    placed = ordered.select("*", F.spark_partition_id().alias("_pid"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    fixed = tables.put(placed.mapInArrow(run, f"{schema}, gold long, cand long"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = fixed.groupBy("_pid").agg(F.max("gold").alias("g"), F.max("cand").alias("c")).select(
        "_pid", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in ("g", "c")])
    return fixed.join(F.broadcast(totals), "_pid").withColumns(
        {"gold": F.col("gold") + F.col("_g"), "cand": F.col("cand") + F.col("_c")}).drop("_pid", "_g", "_c")


class Clamp:
    """What a stretch of the sweep does to the number of open rows (gold counts up, candidate
    down): inputs in [least, most] are shifted so that ``least`` becomes ``out``; beyond,
    rows leave unpaired: ``gold`` plus what the input exceeds ``most`` by, and ``cand`` plus
    what it falls short of ``least`` by."""
    UNBOUNDED = 1 << 62

    def __init__(self, least: int = -UNBOUNDED, most: int = UNBOUNDED, out: int = -UNBOUNDED, gold: int = 0, cand: int = 0):
        self.least, self.most, self.out, self.gold, self.cand = least, most, out, gold, cand

    def add(self, n: int) -> None:
        self.out += n

    def at_most(self, bound: int) -> None:
        over = self.out + self.most - self.least - bound
        if over <= 0:
            return
        width = min(over, self.most - self.least)
        self.most -= width
        if over > width:
            self.gold += over - width
            self.out = bound

    def at_least(self, bound: int) -> None:
        under = bound - self.out
        if under <= 0:
            return
        width = min(under, self.most - self.least)
        self.least += width
        self.out += width
        if under > width:
            self.cand += under - width
            self.out = bound

    def apply(self, n: int) -> tuple[int, int, int]:
        """Open rows afterwards, and gold and candidate rows that left unpaired."""
        return (self.out + min(max(n, self.least), self.most) - self.least,
                self.gold + max(0, n - self.most), self.cand + max(0, self.least - n))


_SWEPT = ("_pid int, least long, most long, out long, gold long, cand long, "
          "left_gold long, left_cand long, ended boolean, came_gold long, came_cand long")
ARRIVES, LEAVES, ENDS = 0, 1, 2


class Stretch:
    """What one partition of the sorted events does. Rows that leave before its first arrival, or the
    first end of a group, wait for the rows that came before: the last of them (``left``) tells
    what all do. Then a clamp, and how many rows have come at the last arrival (``came``)."""

    def __init__(self):
        self.clamp, self.left, self.ended, self.came = Clamp(), None, False, None

    def event(self, event: int, ng: int, nc: int, gold: int, cand: int) -> None:
        if event == ARRIVES:
            self.clamp.add(ng - nc)
            self.came = gold, cand
        elif event == LEAVES:   # open rows all came after the one that leaves
            if self.came:
                self.clamp.at_most(self.came[0] - gold)
                self.clamp.at_least(cand - self.came[1])
            elif not self.ended:
                self.left = gold, cand
        elif self.came:
            self.clamp.at_most(0)
            self.clamp.at_least(0)
        else:
            self.ended = True


def swept(events: DataFrame, order: list[Column]) -> DataFrame:
    """What each partition of the sorted events (event, ng, nc, gold, cand) does: counts of an
    arrival, and the running totals up to an arrival or at the arrival of what leaves."""
    def run(batches):
        stretches: dict[int, Stretch] = {}
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("_pid", "event", "ng", "nc", "gold", "cand")]
            for pid, *event in zip(*columns):
                if pid not in stretches:
                    stretches[pid] = Stretch()
                stretches[pid].event(*event)
        yield from _stretch_rows(stretches)

    placed = events.orderBy(*order).select(F.spark_partition_id().alias("_pid"), "event", "ng", "nc", "gold", "cand")
    return placed.mapInArrow(run, _SWEPT)


def _stretch_rows(stretches: dict[int, Stretch]):
    import pyarrow as pa
    rows = [(p, s.clamp.least, s.clamp.most, s.clamp.out, s.clamp.gold, s.clamp.cand, *(s.left or (None, None)), s.ended,
             *(s.came or (None, None))) for p, s in stretches.items()]
    fields = [f.split(" ") for f in _SWEPT.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    yield pa.RecordBatch.from_arrays([pa.array(x, types[t]) for x, (_, t) in zip(
        list(zip(*rows)) if rows else [()] * len(fields), fields)], names=[n for n, _ in fields])


def composed(stretches: list) -> tuple[int, int]:
    """Unpaired (gold, candidate) rows after all stretches, in their order."""
    still_open = gold = cand = came_gold = came_cand = 0
    for r in stretches:
        first = Clamp()
        if r["left_gold"] is not None:
            first.at_most(came_gold - r["left_gold"])
            first.at_least(r["left_cand"] - came_cand)
        if r["ended"]:
            first.at_most(0)
            first.at_least(0)
        for clamp in (first, Clamp(r["least"], r["most"], r["out"], r["gold"], r["cand"])):
            still_open, more_gold, more_cand = clamp.apply(still_open)
            gold, cand = gold + more_gold, cand + more_cand
        if r["came_gold"] is not None:
            came_gold, came_cand = r["came_gold"], r["came_cand"]
    return gold, cand


def unmatched_by_sweep(rows: DataFrame, keys: list[str], value: str, kind: str, tol: float, rel_tol: float,
                       tables: SharedTables) -> tuple[int, int]:
    """Unpaired (gold, candidate) rows of ``rows`` (keys, value, ng, nc) by one
    inexact column. A NULL value stands for its class and matches only its equals."""
    first = [F.col(k).asc_nulls_first() for k in keys]
    ordered = rows.select(*keys, F.col(value).alias("_v"), "ng", "nc").orderBy(*first, F.col("_v").asc_nulls_first())
    arrivals = totalled(ordered, tables).select(*keys, "_v", "ng", "nc", "gold", "cand")
    zero = F.lit(0).cast("long")
    leaving = arrivals.where("_v is not null").select(
        *keys, furthest(F.col("_v"), kind, tol, rel_tol).alias("_v"), F.lit(LEAVES).alias("event"), zero.alias("ng"),
        zero.alias("nc"), "gold", "cand")
    ends = rows.select(*keys).distinct().select(
        *keys, F.lit(None).cast(rows.schema[value].dataType).alias("_v"), F.lit(ENDS).alias("event"),
        *[zero.alias(n) for n in ("ng", "nc", "gold", "cand")])
    events = arrivals.withColumn("event", F.lit(ARRIVES)).unionByName(leaving).unionByName(ends)
    order = [*first, F.col("_v").asc_nulls_last(), F.col("event").asc()]
    return composed(sorted(swept(events, order).collect(), key=lambda r: r["_pid"]))  # one row per partition


# --- several inexact columns: runs, then augmenting paths ------------------------------------------

def runs_of(rows: DataFrame, keys: list[str], value: str, kind: str, tol: float, rel_tol: float,
            tables: SharedTables) -> DataFrame:
    """``rows`` with ``_run``: the run of its key group that each row belongs to, sorted by
    ``value``, neighbours in a run being within tolerance. A row is compared with the one
    before it, in the same partition or at the end of the one before."""
    fixed = numbered(rows, [F.col(k).asc_nulls_first() for k in [*keys, value]], tables)
    here = Window.partitionBy("_pid").orderBy("_at")
    last = fixed.groupBy("_pid").agg(F.max_by(F.struct(*keys, value), "_at").alias("_last"))
    carried = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_carried"))
    seen = fixed.withColumn("_previous", F.lag(F.struct(*keys, value)).over(here)).join(F.broadcast(carried), "_pid")
    before = F.coalesce("_previous", "_carried")
    same_keys = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(before[k]) for k in keys], F.lit(True))
    joined = before.isNotNull() & same_keys & within(F.col(value), before[value], kind, tol, rel_tol)
    flagged = seen.withColumn("_new", F.when(joined, 0).otherwise(1)).drop("_previous", "_carried")
    return running(flagged, {"_run": "_new"}).drop("_new", "_pid", "_at")


def slabs(c: Column, kind: str, tol: float, rel_tol: float, around: bool) -> Column:
    """The slab of a value, four tolerances wide, as an array; ``around`` adds the neighbour on
    the nearer side (both where values are so large that the place in a slab is inexact), so
    that all partners lie in one of them. A relative tolerance widens slabs with the magnitude."""
    if kind == "float":
        scaled = c / (4 * tol)
        if rel_tol:
            scaled = F.signum(c) * F.log1p(F.abs(c) * (rel_tol / tol)) * ((1 - rel_tol) / (4 * rel_tol))
        # Values beyond 2^62 slabs differ by more than a tolerance unless they are equal.
        at = F.greatest(F.least(F.floor(scaled), F.lit(1 << 62)), F.lit(-(1 << 62)))
        at = F.coalesce(at, F.lit(-(1 << 62)))
        if not around:
            return F.array(at)
        nearer = F.when(scaled - F.floor(scaled) < 0.5, at - 1).otherwise(at + 1)
        return F.when(F.abs(at) < 1 << 48, F.array(at, nearer)).otherwise(F.array(at - 1, at, at + 1))

    @F.pandas_udf("array<string>")
    def decimal_slabs(v: pd.Series) -> pd.Series:
        def names(x):
            if x is None:
                return ["none"]
            with localcontext() as ctx:
                ctx.prec = 100
                if rel_tol:
                    x = Decimal(math.copysign(math.log1p(abs(x) * Decimal(rel_tol / tol)) / rel_tol * tol * (1 - rel_tol), x))
                at = int((x / (4 * Decimal(repr(tol)))).to_integral_value("ROUND_FLOOR"))
            return [str(at + d) for d in ((-1, 0, 1) if around else (0,))]
        return v.map(names, na_action=None)
    return decimal_slabs(c)


def edges_of(rows: DataFrame, loose: list[str], kinds: dict[str, str], tol: float, rel_tol: float) -> DataFrame:
    """Pairs (g, c) of row ids that match, of a run: joined on the slabs of the first two
    inexact columns, gold rows standing in neighbouring slabs too."""
    by = loose[:2]

    def side(count: str, prefix: str, around: bool) -> DataFrame:
        out = rows.where(F.col(count) > 0).select(F.col("_id").alias(prefix), F.col("_run").alias(f"{prefix}_run"),
                                                  *[F.col(n).alias(f"{prefix}_{n}") for n in loose])
        for n in by:
            out = out.withColumn(f"{prefix}_slab_{n}", F.explode(slabs(F.col(f"{prefix}_{n}"), kinds[n], tol, rel_tol, around)))
        return out

    gold, cand = side("ng", "g", True), side("nc", "c", False)
    meet = (F.col("g_run") == F.col("c_run"))
    for n in by:
        meet &= F.col(f"g_slab_{n}") == F.col(f"c_slab_{n}")
    for n in loose:
        meet &= within(F.col(f"g_{n}"), F.col(f"c_{n}"), kinds[n], tol, rel_tol)
    return gold.join(cand, meet).select("g", "c")


class Flow:
    """A matching under way, as written tables: rows left on either side, and how many rows
    each used pair takes."""

    def __init__(self, rows: DataFrame, edges: DataFrame, tables: SharedTables):
        self.spark = rows.sparkSession
        self.edges = tables.put(edges)
        self.gold = rows.where("ng > 0").select(F.col("_id").alias("g"), F.col("ng").alias("left"), "_run")
        self.cand = rows.where("nc > 0").select(F.col("_id").alias("c"), F.col("nc").alias("left"), "_run")
        self.used = self.edges.limit(0).select("g", "c", F.lit(0).cast("long").alias("n"))
        self.held: SharedTables | None = None   # where the three lie now

    def take(self, change: DataFrame) -> None:
        """Apply written changes (g, c, n) of pairs, n negative where a pair is given up."""
        new = SharedTables(self.spark)
        used = self.used.unionByName(change).groupBy("g", "c").agg(F.sum("n").alias("n")).where("n > 0")
        spent = {k: change.groupBy(k).agg(F.sum("n").alias("_n")) for k in ("g", "c")}
        gold, cand = (new.put(rows.join(spent[k], k, "left").select(
            k, (F.col("left") - F.coalesce("_n", F.lit(0))).alias("left"), "_run"))
            for k, rows in (("g", self.gold), ("c", self.cand)))
        self.used, self.gold, self.cand = new.put(used), gold, cand
        self.close()
        self.held = new

    def close(self) -> None:
        if self.held:
            self.held.__exit__()

    def propose(self) -> bool:
        """One round: every free gold row proposes to one free candidate row, which takes
        proposals in order while it has room. False when nobody could propose."""
        free = self.edges.join(self.gold.where("left > 0").select("g", F.col("left").alias("have")), "g").join(
            self.cand.where("left > 0").select("c", F.col("left").alias("room")), "c")
        # A pair's hash decides, so that proposals spread over the candidates.
        choice = free.groupBy("g").agg(F.min_by(F.struct("c", "have", "room"), F.xxhash64("g", "c")).alias("p"))
        queue = Window.partitionBy("p.c").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("p.have").over(queue), F.lit(0))
        with SharedTables(self.spark) as tables:
            taken = tables.put(choice.select("g", F.col("p.c").alias("c"), F.least(
                F.col("p.have"), F.greatest(F.col("p.room") - before, F.lit(0))).alias("n")).where("n > 0"))
            if taken.isEmpty():
                return False
            self.take(taken)
            return True

    def augment(self) -> bool:
        """One phase: a forest grown from all free gold rows, by pairs to candidate rows not
        reached yet and back along used pairs; as soon as a layer holds free candidate rows,
        one path per tree is flipped. Trees share no row, so neither do paths. False when
        no free candidate row can be reached, so that the matching is a largest one."""
        with SharedTables(self.spark) as tables:
            return self._augment(tables.put)

    def _augment(self, put) -> bool:
        # Only where the run has rows free on both sides can there be a path.
        lacking = self.cand.where("left > 0").select("_run").distinct()
        roots = self.gold.where("left > 0").join(lacking, "_run", "left_semi")
        frontier = put(roots.select("g", F.col("g").alias("root"), F.lit(None).cast("long").alias("via")))
        reached_g, reached_c = frontier.select("g"), self.cand.limit(0).select("c")
        layers: list[tuple[DataFrame, DataFrame]] = []
        while True:
            met = self.edges.join(frontier.select("g", "root"), "g").join(reached_c, "c", "left_anti")
            cands = put(met.groupBy("c").agg(F.min(F.struct("g", "root")).alias("p")).select("c", "p.g", "p.root"))
            layers.append((frontier, cands))
            ends = cands.join(self.cand.where("left > 0").select("c", F.col("left").alias("room")), "c")
            chosen = put(ends.groupBy("root").agg(F.min(F.struct("c", "room")).alias("e")).select(
                "root", F.col("e.c").alias("c"), F.col("e.room").alias("n")))
            if not chosen.isEmpty():
                break
            back = self.used.select("g", "c").join(cands.select("c", "root"), "c").join(reached_g, "g", "left_anti")
            frontier = put(back.groupBy("g").agg(F.min(F.struct("c", "root")).alias("p")).select(
                "g", F.col("p.root").alias("root"), F.col("p.c").alias("via")))
            if frontier.isEmpty():
                return False
            reached_g, reached_c = put(reached_g.union(frontier.select("g"))), put(reached_c.union(cands.select("c")))
        # Walk back from the ends, layer by layer; a path's least room is what it carries.
        at, steps = chosen.select("root", "c"), []
        room = chosen.select("root", "n")
        for depth in range(len(layers) - 1, -1, -1):
            golds, cands = layers[depth]
            here = put(at.join(cands.select("c", "g"), "c").join(golds.select("g", "via"), "g").select(
                "root", "g", "c", "via"))
            steps.append(here.select("root", "g", "c", F.lit(1).alias("sign")))
            if depth:
                given = here.select("root", "g", F.col("via").alias("c"))
                steps.append(given.select("*", F.lit(-1).alias("sign")))
                room = room.unionByName(given.join(self.used, ["g", "c"]).select("root", "n"))
                at = given.select("root", "c")
        room = room.unionByName(self.gold.join(chosen.select(F.col("root").alias("g")), "g").select(
            F.col("g").alias("root"), F.col("left").alias("n")))
        least = room.groupBy("root").agg(F.min("n").alias("n"))
        self.take(put(reduce(DataFrame.unionByName, steps).join(least, "root").select(
            "g", "c", (F.col("sign") * F.col("n")).alias("n"))))
        return True

    def left(self) -> tuple[int, int]:
        return tuple(int(x.agg(F.coalesce(F.sum("left"), F.lit(0))).first()[0]) for x in (self.gold, self.cand))


def unmatched_by_paths(rows: DataFrame, keys: list[str], loose: list[str], kinds: dict[str, str], tol: float,
                       rel_tol: float, tables: SharedTables) -> tuple[int, int]:
    """Unpaired (gold, candidate) rows of ``rows`` by several inexact columns."""
    run, by = rows, keys
    for n in loose:  # runs of one column fall apart further by the next
        run = runs_of(run, by, n, kinds[n], tol, rel_tol, tables).withColumnRenamed("_run", f"_run_{n}")
        by = [f"_run_{n}"]
    run = tables.put(run.withColumnRenamed(by[0], "_run").withColumn("_id", F.monotonically_increasing_id()))
    narrow = reduce(lambda x, y: x & y, [
        F.coalesce(within(F.min(n), F.max(n), kinds[n], tol, rel_tol), F.lit(True)) for n in loose])
    per_run = tables.put(run.groupBy("_run").agg(
        F.sum("ng").alias("ng"), F.sum("nc").alias("nc"), narrow.alias("narrow"),
        F.max((F.col("ng") != F.col("nc")).cast("int")).alias("differs")))
    settled = F.col("narrow") | (F.col("ng") == 0) | (F.col("nc") == 0)
    over = [F.coalesce(F.sum(F.greatest(a - b, F.lit(0))), F.lit(0)).alias(n) for n, a, b in
            (("ug", F.col("ng"), F.col("nc")), ("uc", F.col("nc"), F.col("ng")))]
    sums = per_run.where((F.col("differs") == 1) & settled).agg(*over).first()
    wide = tables.put(run.join(per_run.where((F.col("differs") == 1) & ~settled).select("_run"), "_run", "left_semi"))
    if wide.isEmpty():
        return int(sums["ug"]), int(sums["uc"])
    flow = Flow(wide, edges_of(wide, loose, kinds, tol, rel_tol), tables)
    try:
        while flow.propose():
            pass
        while flow.augment():
            pass
        gold, cand = flow.left()
    finally:
        flow.close()
    return int(sums["ug"]) + gold, int(sums["uc"]) + cand


def unmatched_within(multiset: DataFrame, kinds: list[str], disagree: DataFrame | None, tol: float, rel_tol: float,
                     tables: SharedTables) -> tuple[int, int]:
    """Rows that no matching within the tolerance can pair, on (gold, candidate) side.
    ``multiset`` holds rows (c0.., n_gold, n_cand), an equal one mostly once; ``disagree`` the
    distinct exact columns of the groups that need a look, if not all do."""
    if rel_tol >= 1:
        raise ValueError("a relative tolerance of 1 or more matches everything")
    names = [f"c{i}" for i in range(len(kinds))]
    kind_of = dict(zip(names, kinds))
    loose = [n for n in names if inexact(kind_of[n])]
    exact = [n for n in names if n not in loose]
    rows = multiset
    if exact and disagree is not None:
        bad = disagree.select(*[F.col(n).alias(f"_b_{n}") for n in exact])
        rows = rows.join(bad, reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"_b_{n}")) for n in exact]), "left_semi")
    classes = [f"k{n}" for n in loose]
    for n, k in zip(loose, classes):
        rows = rows.withColumn(k, value_class(F.col(n), kind_of[n]))
        rows = rows.withColumn(n, F.when(F.col(k) == "number", F.col(n)))
    rows = rows.select(*exact, *classes, *loose, F.col("n_gold").alias("ng"), F.col("n_cand").alias("nc"))
    if len(loose) == 1:
        return unmatched_by_sweep(rows, exact + classes, loose[0], kind_of[loose[0]], tol, rel_tol, tables)
    return unmatched_by_paths(rows, exact + classes, loose, kind_of, tol, rel_tol, tables)
