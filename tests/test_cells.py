"""Comparisons settled cell by cell, and sweeps in stretches, against trying all ways."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from answercheck.operators import cells, diff
from answercheck.operators.matching import ARRIVES, ENDS, LEAVES, Stretch, composed
from answercheck.session import SharedTables
from tests.test_matching import by_force, some


def settled(gold, cand, columns, tol, batch):
    """What one task makes of all rows, in batches: its sums and the rows left, as (gold, candidate)."""
    names = ["c0", *[f"c{i + 1}" for i in range(columns)]]
    loose = names[1:]
    rows = []
    for r, g, c in [(r, 1, 0) for r in gold] + [(r, 0, 1) for r in cand]:
        rounded = [None if v is None else round(v, 6) if np.isfinite(v) else v for v in r[1:]]
        cell = [float(np.rint(v / (cells.SIDE * tol))) + 0.0 if v is not None and np.isfinite(v) else 0.0 for v in rounded]
        rows.append((*r, g, c, *rounded, *cell))
    rows.sort(key=lambda r: (r[0], *r[-columns:]))
    fields = [("c0", pa.int32())] + [(n, pa.float64()) for n in loose] + [("_g", pa.int64()), ("_c", pa.int64())]
    fields += [(f"_r_{n}", pa.float64()) for n in loose] + [(f"_cell_{n}", pa.float64()) for n in loose]
    batches = [pa.RecordBatch.from_pylist([dict(zip([n for n, _ in fields], r)) for r in rows[i:i + batch]], pa.schema(fields))
               for i in range(0, len(rows), batch)]
    out = [r for b in cells.Settler(names, loose, tol).run(batches) for r in b.to_pylist()]
    total, = [r for r in out if r["left"] == cells.TOTAL]
    left = [[tuple(r[n] for n in names) for r in out if r["left"] != cells.TOTAL for _ in range(r[side])] for side in ("n_gold", "n_cand")]
    uncounted = [r for r in out if r["left"] == cells.UNCOUNTED]
    return total, left, uncounted


@pytest.mark.parametrize("seed", range(12))
def test_settled_components_and_the_rest_make_the_whole(seed, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(cells, "SIDE", r.choice([4, 16, 1024]))
    monkeypatch.setattr(cells, "MOST", r.choice([3, 10, 1000]))
    monkeypatch.setattr(cells, "CHUNK", r.choice([4, 20, 1000]))
    monkeypatch.setattr(cells, "SHIFTS", r.choice([1, 500]))
    monkeypatch.setattr(cells, "PAIRS", r.choice([2, 5000]))
    columns, tol = 1 + seed % 3, r.choice([0.5, 1.0])
    gold, cand = some(r, columns, 60, 30), some(r, columns, r.randint(40, 70), 30)
    total, left, uncounted = settled(gold, cand, columns, tol, r.choice([1, 7, 500]))
    rest = by_force(*left, tol) if left[0] or left[1] else (0, 0)
    assert (total["sg"] + rest[0], total["sc"] + rest[1]) == by_force(gold, cand, tol)
    assert total["n_gold"] + sum(x["n_gold"] for x in uncounted) == len(gold)
    assert total["n_cand"] + sum(x["n_cand"] for x in uncounted) == len(cand)


def test_grid_surplus_is_counted_within_cells():
    gold = [(0, 1.0), (0, 1.0000004), (0, 5.0), (1, 1.0), (1, None), (2, float("nan"))]
    cand = [(0, 1.0000001), (0, 5.0000011), (1, 1.0), (1, None), (2, float("nan"))]
    total, left, _ = settled(gold, cand, 1, 1e-6, 3)
    assert (total["ug"], total["uc"], total["sg"], total["sc"]) == (2, 1, 2, 1) and left == [[], []]


def test_pairs_of_neighbours_move_once_and_leave_sums_only(spark):
    rows = spark.range(3000).select((F.col("id") % 50).alias("k"), (F.col("id") * 0.01).alias("x"), (F.col("id") * 0.5).alias("y"))
    noisy = rows.select("k", F.col("x") + 4e-7, F.col("y") - 4e-7).where("k <> 3")
    plans = []

    class Watched(SharedTables):
        def put(self, df):
            plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
            return super().put(df)

    with Watched(spark) as tables:
        p = diff.prepare("k", rows, noisy, False, tables)
        assert plans == [1]
        assert p.settled.where("left > 0").count() < 150
    d = diff.compare(rows, noisy)
    assert (d.gold_rows, d.cand_rows, d.unmatched_gold, d.unmatched_cand) == (3000, 2940, 60, 0)


def test_a_tolerance_finer_than_the_grid_or_relative_takes_the_written_rows(spark):
    g = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 100.0)], "k int, x double")
    c = spark.createDataFrame([(1, 1.0000003), (1, 2.0), (2, 101.0)], "k int, x double")
    with SharedTables(spark) as tables:
        for tol, rel in ((1e-7, 0.0), (1e-6, 0.1)):
            assert diff.prepare("k", g, c, False, tables, None, tol, rel).settled is None
    assert diff.compare(g, c, rel_tol=0.1).equal
    assert diff.compare(g, c).unmatched_gold == 1


def test_stretches_cut_anywhere_sum_up_alike():
    r = random.Random(4)
    for _ in range(300):
        events, g, c = [], 0, 0
        for _ in range(r.randint(1, 3)):   # groups
            open_rows = []
            for _ in range(r.randint(1, 6)):
                while open_rows and r.random() < 0.4:
                    events.append((LEAVES, 0, 0, *open_rows.pop(0)))
                ng, nc = r.choice([(1, 0), (0, 1), (2, 1), (0, 3)])
                g, c = g + ng, c + nc
                events.append((ARRIVES, ng, nc, g, c))
                open_rows.append((g, c))
            events += [(LEAVES, 0, 0, *x) for x in open_rows] + [(ENDS, 0, 0, 0, 0)]

        def swept(cuts):
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(events)]):
                s = Stretch()
                for e in events[a:b]:
                    s.event(*e)
                gold, cand = s.left or (None, None)
                came_gold, came_cand = s.came or (None, None)
                out.append(dict(least=s.clamp.least, most=s.clamp.most, out=s.clamp.out, gold=s.clamp.gold, cand=s.clamp.cand,
                                left_gold=gold, left_cand=cand, ended=s.ended, came_gold=came_gold, came_cand=came_cand))
            return composed(out)

        whole = swept([])
        assert swept(sorted(r.sample(range(len(events) + 1), min(len(events), r.randint(1, 6))))) == whole
        assert swept(list(range(1, len(events)))) == whole


@pytest.mark.parametrize("size", [1.0, 1e6, 3e9, 6e9, 1e10, 1e13, 1e300])
def test_partners_of_any_size_are_found(size):
    r = np.random.default_rng(int(np.log10(size)))
    gold = [(0, float(v)) for v in size * (1 + r.random(400)) * r.choice([-1, 1], 400)]
    cand = [(0, float(v + d)) for (_, v), d in zip(gold, r.choice([-1e-6, 4e-7, 0.0, 9e-7], 400))]
    total, left, _ = settled(gold, cand, 1, 1e-6, 100)
    rest = by_force(*left, 1e-6) if left[0] or left[1] else (0, 0)
    assert (total["sg"] + rest[0], total["sc"] + rest[1]) == by_force(gold, cand, 1e-6)
