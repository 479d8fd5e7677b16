"""Hard-negative mining: integer scores of anchors against all rows by Strassen products.

Components become floor(scale * x), scores are integer inner products. Rows are dealt by
their place into stripes, anchors into groups, both of bounded bytes; a cell (group, stripe)
meets once in each of two passes:

1. Positives: a cell multiplies its anchor tile with its candidate tiles and keeps, per
   anchor, a heap of the best ``positives`` rows of the same label. Heaps of all stripes
   merge by rank: partial top-k before the shuffle, the final one after it.
2. Negatives: each positive opens a window of scores, low% to high% of its own. A cell keeps
   per window a heap of the best ``negatives`` rows of another label inside it; they merge
   alike.

Tiles are multiplied by Strassen's recursion (seven half-size products, integer additions,
zero padding to even halves) down to small leaves, in int64. Its sums are exact modulo 2^64,
so what fits a long comes out exact whatever wraps on the way; tiles whose scores might not
fit are multiplied in unbounded integers, and a score that does not fit fails the query.

Every anchor meets every row by definition: work is anchors x rows. Anchors are a stated
query set, moved once a stripe, rows once a group; no pair of rows is ever a row of a
shuffle, only heaps are.

Defined cases: a null id, label or vector, or a null, NaN or infinite component, takes no
part; vectors of another length than the anchor's are not compared with it; an empty vector
scores 0 with empty ones; equal scores go by smaller id; rows that repeat an id are one row
whose best score counts (an anchor's vector is then the greatest of its rows); an anchor
without a positive, or a positive without a negative, has no rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 5, 80, 100, 256
# Bytes of a cell's side, rows of a side; anchors and rows of a tile; side of a leaf product.
SIDE_BYTES, SIDE_ROWS, TILE, WIDE, LEAF = 16 << 20, 16_384, 512, 2048, 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The integer matrix product a @ b by Strassen's recursion, padded with zeros where a
    side is odd."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), a.dtype)
    out[:r, :t], out[:r, t:] = m1 + m4 - m5 + m7, m3 + m5
    out[r:, :t], out[r:, t:] = m2 + m4, m1 - m2 + m3 + m6
    return out[:n, :m]


def whole(x: np.ndarray) -> np.ndarray:
    """Floored doubles as integers: int64, or unbounded where needed."""
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        return np.array([[int(v) for v in row] for row in x], object)
    return x.astype(np.int64)


def product(a: np.ndarray, c: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Exact scores of all rows of ``a`` with all rows of ``c`` as int64."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(c)), np.int64)
    top_a, top_c = (int(max(x.max(), -x.min())) for x in (a, c))
    if top_a * top_c * a.shape[1] < 1 << 63 and a.dtype != object and c.dtype != object:
        return strassen(a, c.T, leaf)
    out = strassen(a.astype(object), c.T.astype(object), leaf)
    if max(out.max(), -out.min()) >= 1 << 63:
        raise OverflowError("a score does not fit a long")
    return out.astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the places of the ``k`` best allowed scores, equal ones by place. Places are
    in the order of ids."""
    out = []
    for row, ok in zip(scores, allowed):
        at = np.flatnonzero(ok)
        if len(at) > 4 * k:
            # All that reach the k-th best score, ties included.
            kth = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= kth]
        out.append(at[np.argsort(-row[at], kind="stable")[:k]])
    return out


class Heaps:
    """Per key the best rows (score, id) of the tiles seen, an id once."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, key, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        top: dict[int, int] = {i: s for s, i in self.held.get(key, ())}
        for i, s in zip(ids.tolist(), scores.tolist()):
            top[i] = max(s, top.get(i, s))
        self.held[key] = sorted(((s, i) for i, s in top.items()), key=lambda x: (-x[0], x[1]))[:self.k]

    def columns(self) -> tuple[list, list, list]:
        flat = [(key, i, s) for key, heap in self.held.items() for s, i in heap]
        return tuple(map(list, zip(*flat))) if flat else ([], [], [])


def by_length(table: pa.Table, scale: float, *names: str) -> dict[int, tuple]:
    """Columns of a cell's side and its matrix, per vector length, in the order of ids."""
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    vectors = table.column("v").combine_chunks()
    values = vectors.values.to_numpy(zero_copy_only=False)
    start = vectors.offsets.to_numpy()
    lengths = np.diff(start)
    out = {}
    for n in np.unique(lengths).tolist():
        rows = order[lengths[order] == n]
        matrix = values[start[rows][:, None] + np.arange(n)].astype(np.float64)
        out[n] = [table.column(c).take(pa.array(rows)) for c in names], whole(np.floor(scale * matrix))
    return out


def _distinct_limit(ids: np.ndarray, k: int) -> int:
    """How many places to take so that ``k`` different ids are among them: ids may repeat."""
    return k * int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else k


def cells(anchors: DataFrame, rows: DataFrame, ddl: str, fn) -> DataFrame:
    """``fn(anchors, rows)`` of every (group, stripe) that both are dealt to."""
    return anchors.groupBy("group", "stripe").cogroup(rows.groupBy("group", "stripe")).applyInArrow(fn, ddl)


def ranked(heaps: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of each key over all stripes, an id once, with their rank from 1."""
    once = heaps.groupBy(*keys, "id").agg(F.max("score").alias("score"))
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, scratch: Scratch, *, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, side_bytes: int = SIDE_BYTES, side_rows: int = SIDE_ROWS) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` holds: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score."""
    x = F.col(f"`{vector}`")
    usable = vectors.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))))
    ready = usable.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                          x.alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    sizes = ready.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"),
                      F.max(F.size("v")).alias("dim")).first()
    per_side = max(1, min(side_rows, side_bytes // (8 * max(sizes["dim"] or 1, 1))))
    groups, stripes = (max(1, -(-sizes[c] // per_side)) for c in ("anchors", "n"))

    # One row an anchor; an anchor's group is a hash of its unique id, a row's stripe of its place.
    first = ready.where("is_anchor").groupBy("id").agg(F.max(F.struct("label", "v")).alias("best"))
    queries = scratch.put(first.select(
        "id", F.col("best.label").alias("label"), F.col("best.v").alias("v"),
        F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group")), "anchors")
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = ready.select("id", "label", "v", F.pmod(place, F.lit(stripes)).cast("int").alias("stripe"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    every = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe")

    def tiles(left: pa.Table, right: pa.Table, *names: str):
        """Scores of all anchor tiles with all candidate tiles of a cell."""
        candidates = by_length(right, scale, "id", "label")
        for n, (columns, a) in by_length(left, scale, *names).items():
            if n not in candidates:
                continue
            (ids, labels), c = candidates[n]
            ids, labels = ids.to_numpy(), labels.to_numpy()
            for j in range(0, len(c), WIDE):
                for i in range(0, len(a), TILE):
                    yield ([x.slice(i, TILE) for x in columns], ids[j:j + WIDE], labels[j:j + WIDE],
                           product(a[i:i + TILE], c[j:j + WIDE]))

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps = Heaps(positives)
        for (own, own_label), ids, labels, scores in tiles(left, right, "id", "label"):
            own, own_label = own.to_numpy(), own_label.to_numpy()
            allowed = (own_label[:, None] == labels) & (own[:, None] != ids)
            for key, at, row in zip(own.tolist(), best(scores, allowed, _distinct_limit(ids, positives)), scores):
                heaps.add(key, ids[at], row[at])
        keys, found, values = heaps.columns()
        return pa.table({"anchor_id": pa.array(keys, pa.int64()), "id": pa.array(found, pa.int64()),
                         "score": pa.array(values, pa.int64())})

    heaps = cells(queries.select("id", "label", "v", "group", every), dealt,
                  "anchor_id long, id long, score long", find_positives)
    found = scratch.put(ranked(heaps, ["anchor_id"], positives).select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.col("rank").alias("slot")), "positives")
    windows = found.groupBy("anchor_id").agg(  # at most ``positives`` rows each
        F.array_sort(F.collect_list(F.struct("slot", "positive_score"))).alias("w"))
    asking = queries.join(windows, queries["id"] == windows["anchor_id"]).select(
        "id", "label", "v", F.col("w.positive_score").alias("tops"), F.col("w.slot").alias("slots"), "group", every)

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps = Heaps(negatives)
        for (own, own_label, tops, slots), ids, labels, scores in tiles(left, right, "id", "label", "tops", "slots"):
            limit = _distinct_limit(ids, negatives)
            own, own_label = own.to_numpy(), own_label.to_numpy()
            other = (own_label[:, None] != labels) & (own[:, None] != ids)
            tops, slots = tops.to_pylist(), slots.to_pylist()
            for k in range(max(map(len, tops), default=0)):
                # Bounds by Python's integers: low * top may leave int64.
                has = [r for r in range(len(own)) if len(tops[r]) > k]
                least = np.array([min(-(-low * tops[r][k] // 100), (1 << 63) - 1) for r in has], np.int64)
                most = np.array([max(high * tops[r][k] // 100, -(1 << 63)) for r in has], np.int64)
                part = scores[has]
                allowed = other[has] & (part >= least[:, None]) & (part <= most[:, None])
                some = np.flatnonzero(allowed.any(axis=1))
                for r, at in zip(some.tolist(), best(part[some], allowed[some], limit)):
                    heaps.add((int(own[has[r]]), slots[has[r]][k]), ids[at], part[r][at])
        keys, ids, values = heaps.columns()
        return pa.table({"anchor_id": pa.array([k[0] for k in keys], pa.int64()),
                         "slot": pa.array([k[1] for k in keys], pa.int32()),
                         "id": pa.array(ids, pa.int64()), "score": pa.array(values, pa.int64())})

    hard = ranked(cells(asking, dealt, "anchor_id long, slot int, id long, score long", find_negatives),
                  ["anchor_id", "slot"], negatives)
    return hard.join(found, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
