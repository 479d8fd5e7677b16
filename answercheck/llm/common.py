"""Helpers shared by the operators: reading tables, scratch tables in the shared
checkpoint folder, and batch-wise mapping over documents."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answercheck.session import ensure_checkpoint_dir
from answercheck.sources.tables import table

# ASCII white space; a word is a maximal run of other characters, which is what
# bytes.split() yields on UTF-8 text.
WHITE = b" \t\n\r\x0b\x0c"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


class Scratch:
    """Tables written to the shared checkpoint folder, so that a lost executor costs a
    re-read and not a recomputation. ``clear`` deletes all but the named ones (those
    a returned DataFrame still reads)."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.names: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        df.write.mode("overwrite").option("compression", codec).parquet(self.path(name))
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if name in self.names:
            self.names.remove(name)

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of finished steps now: it does so
        when the driver's garbage collector finds that nothing refers to them, which for
        a plan that Python still held takes a second look."""
        import gc
        import time
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)

    def clear(self, *keep: str) -> None:
        for name in [n for n in self.names if n not in keep]:
            self.drop(name)


SIEVE_BITS = 1 << 24


def sieve(keys: DataFrame, key: str, bits: int = SIEVE_BITS) -> DataFrame:
    """(_word, _set): a filter of fixed size (4 MB as rows), one bit set for each value of
    ``key``. With many more keys than bits it lets all through, so it only ever saves rows."""
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    return keys.select(place.alias("p")).groupBy(F.expr("shiftright(p, 6)").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p % 64))")).alias("_set"))


def sifted(rows: DataFrame, key: str, words: DataFrame, bits: int = SIEVE_BITS) -> DataFrame:
    """``rows`` with ``_likely``: false only where no key of the ``sieve`` is equal."""
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    at = rows.withColumn("_place", place).join(F.broadcast(words), F.expr("shiftright(_place, 6) = _word"), "left")
    return at.withColumn("_likely", F.expr("coalesce(shiftright(_set, int(_place % 64)) & 1L = 1L, false)")).drop(
        "_place", "_word", "_set")


def texts(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` compressed, as ``z`` and the number of bytes ``n_bytes``: a text that is
    to be moved takes about two thirds of what a shuffle's own compression leaves of it."""
    kept = [f for f in rows.schema if f.name != "text"]

    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for batch in slices(batches):
            raws = [x.encode("utf-8", "replace") for x in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([codec.compress(r, asbytes=True) for r in raws], pa.binary())],
                names=[*(f.name for f in kept), "n_bytes", "z"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_bytes long, z binary")


def unpacked(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The UTF-8 bytes of ``packed`` texts, one after the other."""
    codec = pa.Codec("zstd")
    for n, z in zip(batch.column("n_bytes").to_pylist(), batch.column("z")):
        yield codec.decompress(z.as_buffer(), n, asbytes=True) if n else b""


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows: what a task holds of texts as Python objects, and what
    it sends back at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Return a worker's free memory to the system: Spark keeps workers for later tasks, beside
    the memory of the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def blocks(rows: list[str], size: int) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters, which bound a task's memory."""
    start = held = 0
    for i, t in enumerate(rows):
        held += len(t) if t else 0
        if held >= size:
            yield rows[start:i + 1]
            start, held = i + 1, 0
    if start < len(rows):
        yield rows[start:]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[str, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64, up to ``n``."""
    if len(_POWERS.get("up", ())) <= n:
        size = 1 << n.bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(1, np.uint64)
            while len(out) <= size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            _POWERS[name] = out
    return _POWERS["up"], _POWERS["down"]


def hashed_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, in order, and each text's number of words.
    A word's hash is a polynomial over its bytes, cut out of the running sum over all."""
    buffer = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    inside = ~_IS_WHITE[buffer]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    start, stop = edges[0::2], edges[1::2]
    up, down = _powers(len(buffer))
    total = np.cumsum(_BYTE[buffer] * up[:len(buffer)])
    before = np.where(start > 0, total[start - 1], np.uint64(0))
    hashes = mix((total[stop - 1] - before) * down[start])
    ends = np.cumsum(np.array([len(r) + 1 for r in raws], np.int64))
    upto = np.searchsorted(start, ends)
    return hashes, np.diff(upto, prepend=0)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; a text of fewer words (but at
    least one) is one shingle. A text without words has none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = mix(words[:n] + np.uint64(size))
    for i in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return out


def union_find(pairs) -> dict:
    """Representative (smallest) of each item named in ``pairs``, within one task."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges``: (a long, b long) without nulls. Returns (node, component), component being
    the smallest node reachable; nodes without an edge are absent. Every round joins the
    edges with per-node minima twice (partial aggregates first, so a hub's edges are
    combined map-side, and the join can split it); a round's edges are a written table.
    It is over when every node but the roots has one parent and no parent has one: an edge
    then joins each node to the smallest of its component."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # each node's larger neighbours move to its smallest
            both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:      # each node and its smaller neighbours move to the smallest of them
            least = e.groupBy("a").agg(F.min("b").alias("m"))
            joined = e.join(least, "a")
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def settled(e: DataFrame) -> bool:
        ends = e.select(F.col("a").alias("node"), "b").union(
            e.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("b")))
        per_node = ends.groupBy("node").agg(F.min("b").alias("b0"), F.max("b").alias("b1"),
                                            F.count_if(F.col("b").isNull()).alias("children"))
        return per_node.where("b0 < b1 or (b0 is not null and children > 0)").isEmpty()

    current = scratch.put(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    step = 0
    while not settled(current):
        step += 1
        current = scratch.put(star(star(current, True), False), f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
