"""Embedding near-dedup by an epsilon grid order join.

Vectors of equal label are linked when their cosine is at least ``threshold``. On unit
vectors that is a distance of at most eps = sqrt(2 - 2 * threshold), and an orthonormal
projection never lengthens a distance, so whatever is more than eps apart in the leading
principal dimensions is provably not linked.

1. Equal vectors of a label become one class with a count (partial aggregates), so
   copies cost nothing further.
2. Principal dimensions come from the sums of products of all unit vectors (one number
   per pair of dimensions, whatever the number of vectors).
3. Epsilon grid order: vectors are range-sorted by label and by their grid cells (side eps)
   on the leading dimensions, lexicographically; the sorted sequence is cut into blocks of
   at most ``block`` vectors, each with its bounding box.
4. Recursive join of sequence intervals: intervals of the sequence form a tree (blocks,
   partitions, runs of 16 partitions, ...). From the top, pairs of intervals whose boxes are
   at most eps apart are replaced by the pairs of their parts; the others are skipped.
5. A surviving pair of blocks is joined in a task, again by halving both intervals and
   skipping distant boxes, down to ``leaf`` vectors, where cosines are taken in double
   precision. Values within 1e-9 of the threshold are recomputed exactly from the given
   numbers. A task returns link counts per vector and a spanning forest, never all pairs.
6. Counts are summed; the forests' components give the classes.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component,
and one with a null label or id, is linked with nothing and kept; vectors of different
lengths are never linked; repeated rows count as vectors of their own (rows repeating an
id with other values may share one node, whose links are added up); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

THRESHOLD = 0.93
LEADING, BLOCK, LEAF = 8, 512, 64
FAN_BITS = 4


def _valid() -> F.Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & (F.size("embedding") > 0) & F.forall("embedding", finite)
            & F.exists("embedding", lambda x: x != 0))


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest entry first, against underflow."""
    m = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def principal(classes: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal basis (columns, leading first) of the vectors of length ``dim``. The
    driver gets dim * (dim + 1) / 2 sums."""
    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            u = _unit(flat.reshape(-1, dim)) if len(flat) else np.zeros((0, dim))
            total += u.T @ u
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total[i, j])], names=["i", "j", "v"])

    own = classes.where(F.size("embedding") == dim).select("embedding")
    sums = own.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    gram = np.zeros((dim, dim))
    for r in sums:
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["v"]
    return np.linalg.eigh(gram)[1][:, ::-1]


def _basis(bases: dict[int, np.ndarray], dim: int, leading: int) -> np.ndarray:
    """Leading dimensions of a vector length: principal ones where known, else the first."""
    return (bases[dim] if dim in bases else np.eye(dim))[:, :leading]


_BLOCKS = ("label int, dim int, node long, n int, ids binary, copies binary, vectors binary, "
           "lo array<double>, hi array<double>")


def grid_order(classes: DataFrame, bases: dict[int, np.ndarray], eps: float, leading: int, block: int) -> DataFrame:
    """Blocks of the sequence of ``classes`` (label, embedding, rep, copies) in epsilon grid
    order. A block's node is its partition and its place there, so nodes follow the
    sequence."""
    cells = [f"c{i}" for i in range(leading)]

    def place(batches):
        for batch in batches:
            rows = batch.column("embedding").to_pylist()
            out = np.zeros((len(rows), leading), np.int32)
            dims = np.array([len(r) for r in rows])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                u = _unit(np.array([rows[i] for i in at], np.float64))
                p = u @ _basis(bases, int(d), leading)
                out[at, :p.shape[1]] = np.floor(p / eps)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("label", "rep", "copies", "embedding")] + [pa.array(dims.astype(np.int32))]
                + [pa.array(out[:, i].copy()) for i in range(leading)],
                names=["label", "rep", "copies", "embedding", "dim", *cells])

    def cut(batches):
        from pyspark import TaskContext
        base, seq = TaskContext.get().partitionId() << 32, 0
        held: list = []

        def flush():
            nonlocal seq, held
            label, dim = held[0][0], held[0][1]
            raw = np.array([h[4] for h in held], np.float32)
            p = _unit(raw.astype(np.float64)) @ _basis(bases, dim, leading)
            p = np.pad(p, ((0, 0), (0, leading - p.shape[1])))
            row = [label, dim, base + seq, len(held), np.array([h[2] for h in held], "<i8").tobytes(),
                   np.array([h[3] for h in held], "<i8").tobytes(), raw.astype("<f4").tobytes(),
                   p.min(axis=0).tolist(), p.max(axis=0).tolist()]
            seq += 1
            held = []
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3, *[pa.list_(pa.float64())] * 2]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              names=[f.split(" ")[0] for f in _BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "rep", "copies", "embedding"))):
                if held and (held[0][:2] != row[:2] or len(held) == block):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    placed = classes.select("label", "rep", "copies", "embedding").mapInArrow(
        place, "label int, rep long, copies long, embedding array<float>, dim int, "
        + ", ".join(f"{c} int" for c in cells))
    order = ["label", "dim", *cells, "rep"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, _BLOCKS)


def _apart2(suffix_a: str, suffix_b: str):
    """Squared distance of two boxes given as lo/hi arrays."""
    gap = lambda lo, hi: F.zip_with(F.col(lo), F.col(hi), lambda l, h: F.greatest(l - h, F.lit(0.0)))  # noqa: E731,E741
    each = F.zip_with(gap(f"lo{suffix_a}", f"hi{suffix_b}"), gap(f"lo{suffix_b}", f"hi{suffix_a}"),
                      lambda x, y: x * x + y * y)
    return F.aggregate(each, F.lit(0.0), lambda s, x: s + x)


def close_blocks(blocks: DataFrame, eps: float, leading: int, scratch: Scratch) -> DataFrame:
    """(label, dim, a, b) with a <= b: pairs of blocks whose boxes are at most eps apart,
    found from the top of the interval tree downwards."""
    shifts = [0, 32]
    top = blocks.agg(F.max(F.shiftright("node", 32))).first()[0] or 0
    while top >> (shifts[-1] - 32):
        shifts.append(shifts[-1] + FAN_BITS)
    corner = lambda f, c: F.array(*[f(F.get(c, F.lit(i))) for i in range(leading)])
    boxes = blocks.select("label", "dim", "node", "lo", "hi")
    levels = [boxes]
    for low, high in zip(shifts, shifts[1:]):
        up = levels[-1].withColumn("node", F.shiftright("node", high - low))
        levels.append(scratch.put(up.groupBy("label", "dim", "node").agg(
            corner(F.min, "lo").alias("lo"), corner(F.max, "hi").alias("hi")), f"level{high}"))
    limit = F.lit((eps + 1e-9) ** 2)
    pairs = levels[-1].select("label", "dim", F.col("node").alias("a"), F.col("node").alias("b"))
    for at in range(len(levels) - 2, -1, -1):
        parts = levels[at].withColumn("parent", F.shiftright("node", shifts[at + 1] - shifts[at]))
        side = lambda s: parts.select(
            "label", "dim", F.col("parent").alias(s), F.col("node").alias(f"n{s}"),
            F.col("lo").alias(f"lo{s}"), F.col("hi").alias(f"hi{s}"))
        joined = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"])
        pairs = scratch.put(joined.where((F.col("na") <= F.col("nb")) & (_apart2("a", "b") <= limit)).select(
            "label", "dim", F.col("na").alias("a"), F.col("nb").alias("b")), f"close{at}")
    return pairs


class _Side:
    """Vectors of a block: as given, as unit vectors, and projected."""

    def __init__(self, ids, copies, vectors, dim, basis):
        self.ids, self.copies = np.frombuffer(ids, "<i8"), np.frombuffer(copies, "<i8")
        self.raw = np.frombuffer(vectors, "<f4").reshape(-1, dim).astype(np.float64)
        self.unit = _unit(self.raw)
        self.low = self.unit @ basis


def _exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    dot = math.fsum((x * y).tolist())
    return dot / (math.sqrt(math.fsum((x * x).tolist())) * math.sqrt(math.fsum((y * y).tolist())))


def links(a: _Side, b: _Side, same: bool, threshold: float, eps: float, leaf: int) -> np.ndarray:
    """Boolean matrix of the links between two blocks, by recursion on their intervals."""
    out = np.zeros((len(a.ids), len(b.ids)), bool)

    def join(a0, a1, b0, b1):
        if same and b1 <= a0:
            return
        x, y = a.low[a0:a1], b.low[b0:b1]
        gap = np.maximum(0, np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0)))
        if (gap * gap).sum() > (eps + 1e-9) ** 2:
            return
        if max(a1 - a0, b1 - b0) <= leaf:
            cos = a.unit[a0:a1] @ b.unit[b0:b1].T
            hit = cos >= threshold
            for i, j in np.argwhere(np.abs(cos - threshold) < 1e-9):
                hit[i, j] = _exact_cosine(a.raw[a0 + i], b.raw[b0 + j]) >= threshold
            out[a0:a1, b0:b1] = hit
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            join(a0, mid, b0, b1)
            join(mid, a1, b0, b1)
        else:
            mid = (b0 + b1) // 2
            join(a0, a1, b0, mid)
            join(a0, a1, mid, b1)

    join(0, len(a.ids), 0, len(b.ids))
    if same:
        out = np.triu(out, 1)
        out |= out.T
    return out


def _forest(a: _Side, b: _Side, hit: np.ndarray) -> list[tuple[int, int]]:
    """Links that join every linked vector to the smallest id it reaches within the pair."""
    la, lb = a.ids.copy(), b.ids.copy()
    big = np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(hit, lb[None, :], big).min(axis=1))
        nb = np.minimum(lb, np.where(hit, na[:, None], big).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    found = {(int(i), int(r)) for ids, label in ((a.ids, la), (b.ids, lb)) for i, r in zip(ids, label) if i != r}
    return sorted(found)


def join_blocks(pairs: DataFrame, blocks: DataFrame, bases: dict[int, np.ndarray], threshold: float, eps: float,
                leading: int, leaf: int) -> DataFrame:
    """(node long, links long, other long): link counts of vectors (other null) and forest
    edges (links 0) of every pair of blocks."""
    def run(batches):
        for batch in batches:
            node, count, other = [], [], []
            for row in batch.to_pylist():
                basis = _basis(bases, row["dim"], leading)
                a = _Side(row["ids_a"], row["copies_a"], row["vectors_a"], row["dim"], basis)
                same = row["a"] == row["b"]
                b = a if same else _Side(row["ids_b"], row["copies_b"], row["vectors_b"], row["dim"], basis)
                hit = links(a, b, same, threshold, eps, leaf)
                if not hit.any():
                    continue
                for side, n in [(a, hit @ b.copies)] + ([] if same else [(b, a.copies @ hit)]):
                    at = np.flatnonzero(n)
                    node += side.ids[at].tolist()
                    count += n[at].tolist()
                    other += [None] * len(at)
                edges = _forest(a, b, hit)
                node += [x for x, _ in edges]
                count += [0] * len(edges)
                other += [y for _, y in edges]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, count, other)],
                                             names=["node", "links", "other"])

    side = lambda s: blocks.select("label", "dim", F.col("node").alias(s), *[
        F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vectors")])
    joined = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"])
    return joined.mapInArrow(run, "node long, links long, other long")


def near_duplicates(vectors: DataFrame, scratch: Scratch, *, threshold: float = THRESHOLD, leading: int = LEADING,
                    block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<float>").alias("embedding"),
                          F.col("label").cast("int").alias("label"))
    classes = scratch.put(rows.where(_valid()).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    common = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    bases = {common["d"]: principal(classes, common["d"])} if common else {}
    blocks = scratch.put(grid_order(classes, bases, eps, leading, block), "blocks")
    pairs = close_blocks(blocks, eps, leading, scratch)
    found = scratch.put(join_blocks(pairs, blocks, bases, threshold, eps, leading, leaf), "found")
    counts = found.where("other is null").groupBy(F.col("node").alias("rep")).agg(F.sum("links").alias("near"))
    comp = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")),
                      scratch).withColumnRenamed("node", "rep")
    of_class = classes.join(counts, "rep", "left").join(comp, "rep", "left").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n"),
        F.coalesce("component", "rep").alias("component"))
    given = rows.withColumn("_ok", _valid())
    hit = (F.col("_ok") & (given["label"] == of_class["label"]) & (given["embedding"] == of_class["embedding"]))
    out = given.join(of_class, hit, "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
