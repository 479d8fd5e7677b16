"""Rows of two results with float columns, settled cell by cell.

The float columns are cut into cells of ``SIDE`` tolerances. All rows of a cell with equal exact
columns meet after the one shuffle that also counts the grid; before it, equal rows of a stretch
of input become one. In a cell, rows that match form components:

- a component with no row near the edge of its cell has no partner elsewhere. If each of its gold
  rows matches each of its candidate rows, as a pair of partners always does, the sums of both
  sides say how many stay unpaired: it is settled;
- all others (near an edge, incomplete, crowded) are written as they are, whole, and matched
  together with the rows of other cells by ``matching``.

A cell's rows are read in order and at most ``MOST`` are held; a cell of more is written as it is,
and its grid counted by a group-by afterwards. So a column whose values all lie in one cell
passes through one task, a piece at a time. A component's matching does not depend on
other components, so the sums over all are what one matching of everything would give, for
tolerances that hold a step of the grid.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import SharedTables
from .matching import inexact

# No round number, so that round values do not lie on the edges of cells.
SIDE = 1011.358
# Rows of one cell, rows handled at once, neighbours a row is held against, and pairs of rows.
MOST, CHUNK, SHIFTS, PAIRS = 1 << 16, 1 << 17, 512, 1 << 22
STEP = 1e-6     # of the grid

_PLAIN = (T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DoubleType,
          T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType)
_SUMS = ("n_gold", "n_cand", "ug", "uc", "sg", "sc")
TOTAL, LEFT, UNCOUNTED = 0, 1, 2


def serves(schema: T.StructType, kinds: list[str], tol: float, rel_tol: float) -> bool:
    """Whether rows of these types and this tolerance can be settled by cells."""
    plain = all(isinstance(f.dataType, _PLAIN) or f.dataType.simpleString() == "string" for f in schema)
    loose = [k for k in kinds if inexact(k)]
    return plain and bool(loose) and set(loose) == {"float"} and not rel_tol and tol >= STEP


def reach(rounded: np.ndarray, tol: float) -> np.ndarray:
    """How far partners' grid values may lie from each other, the rounding of large numbers
    included; where the next number lies beyond the tolerance, only equals are partners."""
    step = np.spacing(np.abs(rounded))
    return np.where(step > 2 * tol, 0.0, 2 * (tol + STEP) + 4 * step)


def cell(rounded: Column, tol: float) -> Column:
    finite = rounded.isNotNull() & ~F.isnan(rounded) & (F.abs(rounded) < float("inf"))
    return F.when(finite, F.rint(rounded / F.lit(SIDE * tol)) + F.lit(0.0)).otherwise(F.lit(0.0))


def once(names: list[str]):
    """Equal rows of a stretch of input as one."""
    def run(batches):
        held, n = [], 0

        def flush():
            rows = pa.Table.from_batches(held).group_by(names, use_threads=False).aggregate([("_g", "sum"), ("_c", "sum")])
            rows = rows.rename_columns({"_g_sum": "_g", "_c_sum": "_c"}).select([*names, "_g", "_c"])
            return rows.combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()
    return run


def changes(rows: pa.Table, by: list[str]) -> np.ndarray:
    """Where rows begin that differ from the row before in one of the columns."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in by:
        code = rows.column(name).combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return new


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the rows that each row is linked with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        following = label.copy()
        np.minimum.at(following, label[i], least)
        np.minimum.at(following, label[j], least)
        following = following[following]
        if np.array_equal(following, label):
            return label
        label = following


def near_pairs(group: np.ndarray, values: list[np.ndarray], tol: float, has_g: np.ndarray, has_c: np.ndarray):
    """(i, j) of rows of different sides within the tolerance, rows being sorted by group and first
    value, and the groups where too many rows lie close together to say."""
    n, out, found = len(group), [], 0
    at, shift = np.arange(n), 0
    while len(at):
        shift += 1
        at = at[at + shift < n]
        there = at + shift
        near = (group[there] == group[at]) & (np.abs(values[0][there] - values[0][at]) <= tol)
        at, there = at[near], there[near]
        if shift > SHIFTS or found > PAIRS:
            break
        keep = (has_g[at] & has_c[there]) | (has_c[at] & has_g[there])
        for v in values[1:]:
            keep &= np.abs(v[there] - v[at]) <= tol
        out.append((at[keep], there[keep]))
        found += len(out[-1][0])
    i, j = (np.concatenate([p[k] for p in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
    return i, j, np.unique(group[at])


class Settler:
    """One task's sums, and what its cells leave over."""

    def __init__(self, names: list[str], loose: list[str], tol: float):
        self.names, self.loose, self.tol = names, loose, tol
        self.by = [n for n in names if n not in loose] + [f"_cell_{n}" for n in loose]
        self.sums = dict.fromkeys(_SUMS, 0)
        self.raw: dict[str, float | None] = {"raw_gold": None, "raw_cand": None}

    def _row_batches(self, rows: pa.Table, ng, nc, left: int):
        n = rows.num_rows
        if not n:
            return
        empty = {c: pa.nulls(n, pa.int64()) for c in _SUMS[2:]} | {c: pa.nulls(n, pa.float64()) for c in self.raw}
        out = pa.table({**{c: rows.column(c) for c in self.names}, "n_gold": ng, "n_cand": nc,
                        "left": pa.array(np.full(n, left, np.int32)), **empty})
        yield from out.combine_chunks().to_batches()

    def _seen(self, rows: pa.Table) -> None:
        if len(self.names) > 1:
            return
        for side, name in (("_g", "raw_gold"), ("_c", "raw_cand")):
            v = rows.column("c0").filter(pc.greater(rows.column(side), 0)).drop_null().to_numpy()
            if len(v):
                own = np.nan if np.isnan(v).any() else float(v.max())
                held = self.raw[name]
                self.raw[name] = own if held is None else float(np.maximum(held, own))

    def over(self, rows: pa.Table):
        """Rows of a cell that is not held whole."""
        yield from self._row_batches(rows, rows.column("_g"), rows.column("_c"), UNCOUNTED)

    def work(self, rows: pa.Table, new: np.ndarray):
        """Whole cells."""
        self._seen(rows)
        group = np.cumsum(new)
        values, rounded = [], []
        for n in self.loose:
            null = rows.column(n).is_null().to_numpy()
            v = rows.column(n).fill_null(0.0).to_numpy().copy()
            r = rows.column(f"_r_{n}").fill_null(0.0).to_numpy().copy()
            # NULL, NaN and the infinities match only their own kind.
            kind = np.select([null, np.isnan(v), v == np.inf, v == -np.inf], [1, 2, 3, 4], 0)
            v[kind > 0] = r[kind > 0] = 0.0
            if kind.any():
                group = np.unique(group * 5 + kind, return_inverse=True)[1]
            values.append(v)
            rounded.append(r)
        order = np.lexsort((*reversed(values), group))
        same = np.zeros(len(order), bool)
        same[1:] = group[order[1:]] == group[order[:-1]]
        for v in values:
            same[1:] &= v[order[1:]] == v[order[:-1]]
        start = np.flatnonzero(~same)
        ng, nc = (np.add.reduceat(rows.column(c).to_numpy()[order], start) for c in ("_g", "_c"))
        at = order[start]
        group, values, rounded = group[at], [v[at] for v in values], [r[at] for r in rounded]
        self._count(group, rounded, ng, nc)

        has_g, has_c = ng > 0, nc > 0
        i, j, crowded = near_pairs(group, values, self.tol, has_g, has_c)
        label = components(len(at), i, j)
        aside = np.isin(group, crowded)
        width = SIDE * self.tol
        for r in rounded:
            far = reach(r, self.tol)
            aside |= np.rint((r - far) / width) != np.rint((r + far) / width)
        n = len(at)
        def number(of: np.ndarray) -> np.ndarray:
            return np.bincount(of, minlength=n)

        links = number(label[i[has_g[i] & has_c[j]]]) + number(label[i[has_c[i] & has_g[j]]]) + number(label[has_g & has_c])
        done = links == number(label[has_g]) * number(label[has_c])
        done[label[aside]] = False
        gold, cand = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(gold, label, ng)
        np.add.at(cand, label, nc)
        self.sums["sg"] += int(np.maximum(gold - cand, 0)[done].sum())
        self.sums["sc"] += int(np.maximum(cand - gold, 0)[done].sum())
        rest = np.flatnonzero(~done[label])
        yield from self._row_batches(rows.take(pa.array(at[rest])), pa.array(ng[rest]), pa.array(nc[rest]), LEFT)

    def _count(self, group, rounded, ng, nc) -> None:
        order = np.lexsort((*reversed(rounded), group))
        new = np.ones(len(order), bool)
        new[1:] = group[order[1:]] != group[order[:-1]]
        for r in rounded:
            new[1:] |= r[order[1:]] != r[order[:-1]]
        more = np.add.reduceat((ng - nc)[order], np.flatnonzero(new))
        self.sums["n_gold"] += int(ng.sum())
        self.sums["n_cand"] += int(nc.sum())
        self.sums["ug"] += int(more[more > 0].sum())
        self.sums["uc"] -= int(more[more < 0].sum())

    def total(self, schema: pa.Schema):
        cells = {c: pa.nulls(1, schema.field(c).type) for c in self.names}
        sums = {c: pa.array([n], pa.int64()) for c, n in self.sums.items()}
        raw = {c: pa.array([v], pa.float64()) for c, v in self.raw.items()}
        out = {**cells, **{c: sums[c] for c in _SUMS[:2]}, "left": pa.array([TOTAL], pa.int32()),
               **{c: sums[c] for c in _SUMS[2:]}, **raw}
        yield from pa.table(out).to_batches()

    def run(self, batches):
        held, n, passing, schema = [], 0, None, None   # passing: the cell whose rows go on uncounted

        def key(rows: pa.Table, i: int) -> list:
            return [rows.column(c)[i].as_py() for c in self.by]

        def handle(last: bool):
            nonlocal held, n, passing
            rows = pa.Table.from_batches(held).combine_chunks()
            new = changes(rows, self.by)
            start = np.append(np.flatnonzero(new), len(new))
            if passing is not None and key(rows, 0) == passing:
                yield from self.over(rows.slice(0, start[1]))
                rows, new, start = rows.slice(start[1]), new[start[1]:], start[1:] - start[1]
            if len(new):
                # The last cell may go on in the next batch.
                whole = len(new) if last else int(start[-2])
                if not last and len(new) - whole > MOST:
                    passing = key(rows, whole)
                    yield from self.over(rows.slice(whole))
                    rest = rows.slice(0, 0)
                else:
                    rest = rows.slice(whole)
                if whole:
                    yield from self.work(rows.slice(0, whole).combine_chunks(), new[:whole])
                held, n = rest.to_batches(), rest.num_rows
            else:
                held, n = [], 0

        for batch in batches:
            schema = batch.schema
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield from handle(False)
        if n:
            yield from handle(True)
        if schema is not None:
            yield from self.total(schema)


def settle(g: DataFrame, c: DataFrame, kinds: list[str], tol: float, grid: int, tables: SharedTables) -> DataFrame:
    """A written table: sums of the tasks (``left`` 0: rows per side, surplus on the grid ``ug`` and
    ``uc``, unpaired rows of settled components ``sg`` and ``sc``), and the rows that are left,
    counted on the grid (1) or not (2)."""
    names = [f"c{i}" for i in range(len(kinds))]
    loose = [n for n, k in zip(names, kinds) if inexact(k)]
    exact = [n for n in names if n not in loose]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tagged = g.select(*names, one.alias("_g"), none.alias("_c")).unionByName(c.select(*names, none.alias("_g"), one.alias("_c")))
    fields = [T.StructField(f.name, f.dataType) for f in tagged.schema]
    moved = tagged.mapInArrow(once(names), T.StructType(fields))
    rounded = {n: F.round(F.col(n), grid) for n in loose}
    cells = [cell(rounded[n], tol) for n in loose]
    dealt = moved.repartition(*exact, *cells).select(
        "*", *[rounded[n].alias(f"_r_{n}") for n in loose], *[x.alias(f"_cell_{n}") for n, x in zip(loose, cells)])
    dealt = dealt.sortWithinPartitions(*exact, *[f"_cell_{n}" for n in loose])
    out = T.StructType(fields[:len(names)] + [T.StructField(n, T.LongType()) for n in _SUMS[:2]]
                       + [T.StructField("left", T.IntegerType())] + [T.StructField(n, T.LongType()) for n in _SUMS[2:]]
                       + [T.StructField(n, T.DoubleType()) for n in ("raw_gold", "raw_cand")])

    return tables.put(dealt.mapInArrow(lambda batches: Settler(names, loose, tol).run(batches), out))
