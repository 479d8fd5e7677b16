"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters. A
window is ``window`` (10) consecutive words of an item; an item of fewer words, but not
none, is one window. Document words inside any occurrence of a window are hit.

1. Winnowing: in every run of ``window`` words the k-gram (k = 4) of smallest hash is kept.
   It depends on the run alone, so a run that document and item share yields the same
   fingerprint in both: every shared span of ``window`` words or more is found. For an item
   of fewer words the gram is the whole item (k = its words, in a window of one), looked for
   at every place.
2. Fingerprints of the items set bits of a filter of fixed size, built by partial
   aggregates; a document's fingerprint whose bit is not set has no partner. The filter
   only saves rows; whatever it lets through is joined.
3. Fingerprints left are extended to the runs they were kept for, and joined with the items'
   by fingerprint and SHA-256 of the run's words: exact, one item row per distinct run, so
   that no two occurrences of a passage are paired with each other. Runs that many documents
   hold are salted.
4. Runs of a document are merged into spans; the items that hold one of its runs are its
   items. Runs held by the same items share a set id, so a passage is one entry and not
   one per run, and documents with the same sets have their items listed once.

Defined cases: a null or wordless text has no words and is never contaminated; a null or
wordless item has no window; a null item_id marks words but is not listed or counted; rows
that repeat an item_id are one item with the windows of all; repeated documents give a row
each; no items or an empty table leave every document clean (or no rows); other columns are
ignored. Short texts are handled together, about a million characters at a time; a longer
text alone, in memory of about 40 times its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, blocks, mix, texts

WINDOW, GRAM = 10, 4
# Bits of the filter (2 MB), salts of the join by run, bytes of text handled at once.
FILTER_BITS, SALTS, BLOCK = 1 << 24, 16, 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64, up to ``n``."""
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        while len(_POWERS[k]) <= n:
            _POWERS[k] = np.concatenate([_POWERS[k], _POWERS[k] * np.uint64(pow(base, len(_POWERS[k]), 1 << 64))])
    return _POWERS


def words(raws: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case, joined by spaces; start and end of each word in that; each
    word's hash (a polynomial over its bytes, cut out of the running sum over all); and
    each text's first word, with the number of all words last."""
    buffer = _LOWER[np.frombuffer(b" ".join(raws) + b" ", np.uint8)]
    edges = np.flatnonzero(np.diff(_INSIDE[buffer], prepend=False))
    start, stop = edges[0::2], edges[1::2]
    up, down = _powers(len(buffer))
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * up[:len(buffer)], out=total[1:])
    ends = np.cumsum([0, *(len(r) + 1 for r in raws)])
    return buffer.tobytes(), start, stop, mix((total[stop] - total[start]) * down[start]), np.searchsorted(start, ends)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:n] + np.uint64(k))
    for i in range(1, k):
        out = mix(out * _STEP + hashes[i:i + n])
    return out


def winnow(hashes: np.ndarray, window: int, k: int) -> np.ndarray:
    """For every run of ``window`` words, the hash of the k-gram kept for it: the smallest."""
    each = grams(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = each[:n]
    for i in range(1, window - k + 1):
        least = np.minimum(least, each[i:i + n])
    return least


def runs(hashes: np.ndarray, size: int, window: int, k: int) -> np.ndarray:
    """The fingerprint of every run of ``size`` words: a full window's kept k-gram, or a
    shorter run's own hash. Runs may span two texts; callers leave those out."""
    return winnow(hashes, window, k) if size == window else grams(hashes, size)


def spell(lower: bytes, start: np.ndarray, stop: np.ndarray, at: int, size: int) -> bytes:
    """SHA-256 (first 16 bytes) of a run's words, with one space between them."""
    run = b" ".join([lower[s:e] for s, e in zip(start[at:at + size].tolist(), stop[at:at + size].tolist())])
    return hashlib.sha256(run).digest()[:16]


_RUNS = "item_id long, size int, print long, run binary"


def item_runs(items: DataFrame, window: int, k: int) -> DataFrame:
    """All windows of all items: item_id, its number of words, fingerprint, digest."""
    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id").to_pylist(), texts(batch.column("text"))):
                lower, start, stop, hashes, _ = words([text.encode()])
                size = min(window, len(hashes))
                if size:
                    prints = runs(hashes, size, window, k).view(np.int64).tolist()
                    out += [(item, size, p, spell(lower, start, stop, i, size)) for i, p in enumerate(prints)]
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int64(), pa.binary()])],
                names=["item_id", "size", "print", "run"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, _RUNS)


def bit_filter(prints: DataFrame, bits: int) -> np.ndarray:
    """Words of 64 bits, one bit set for each fingerprint: at most bits / 64 rows come back."""
    place = F.pmod(F.col("print"), F.lit(bits))
    rows = prints.groupBy(F.floor(place / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(pmod(print, {bits}) % 64))")).alias("set")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["set"].to_numpy(np.int64).view(np.uint64)
    return out


_FOUND = "doc_id long, n_words long, found array<struct<at:long,size:int,print:long,run:binary>>"


def marked(docs: DataFrame, sizes: list[int], bits: int, sent, window: int, k: int) -> DataFrame:
    """Per document its number of words and the runs whose fingerprint passes the filter."""
    struct = pa.struct([("at", pa.int64()), ("size", pa.int32()), ("print", pa.int64()), ("run", pa.binary())])

    def passing(block: list[str]) -> tuple[list[int], list[list]]:
        lower, start, stop, hashes, first = words([t.encode() for t in block])
        found: list[list] = [[] for _ in block]
        for size in sizes:
            prints = runs(hashes, size, window, k)
            place = prints & np.uint64(bits - 1)
            at = np.flatnonzero((sent.value[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
            doc = np.searchsorted(first, at, side="right") - 1
            inside = at + size <= first[doc + 1]
            for i, d, p in zip(at[inside].tolist(), doc[inside].tolist(), prints[at[inside]].view(np.int64).tolist()):
                found[d].append({"at": i - int(first[d]), "size": size, "print": p,
                                 "run": spell(lower, start, stop, i, size)})
        return np.diff(first).tolist(), found

    def run(batches):
        for batch in batches:
            counts, found = [], []
            for block in blocks(texts(batch.column("text")), BLOCK):
                n, f = passing(block)
                counts += n
                found += f
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(struct))],
                names=["doc_id", "n_words", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def decontaminate(docs: DataFrame, items: DataFrame, scratch: Scratch, *, window: int = WINDOW, gram: int = GRAM,
                  filter_bits: int = FILTER_BITS, salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (doc_id, text) its contamination by ``items`` (item_id, text):
    doc_id, n_words, n_hit, n_items, items_sha256, contaminated; and the spans hit: row_id,
    doc_id, first_word, end_word."""
    if filter_bits & (filter_bits - 1) or not 1 <= gram <= window:
        raise ValueError("filter_bits must be a power of two and gram at most window")
    spark = docs.sparkSession
    windows = scratch.put(item_runs(items, window, gram), "item_runs")
    sent = spark.sparkContext.broadcast(bit_filter(windows.select("print").distinct(), filter_bits))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``window`` numbers
    rows = scratch.put(marked(docs, sizes, filter_bits, sent, window, gram).select(
        F.monotonically_increasing_id().alias("row_id"), "*"), "marked")

    # Distinct runs, each with the set of items that hold it; equal sets are one.
    held = windows.groupBy("print", "run").agg(F.array_sort(F.collect_set(F.col("item_id"))).alias("items"))
    held = held.withColumn("set_id", F.sha2(F.concat_ws(",", "items"), 256))
    sets = scratch.put(held.groupBy("set_id").agg(F.first("items").alias("items")), "sets")
    # Items are few beside documents: their rows are repeated for the salts, documents' are dealt.
    keys = held.select("print", "run", "set_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    candidates = rows.where(F.size("found") > 0).select("row_id", "doc_id", F.explode("found").alias("f")).select(
        "row_id", "doc_id", F.col("f.at").alias("at"), F.col("f.size").alias("size"), F.col("f.print").alias("print"),
        F.col("f.run").alias("run"), F.pmod(F.xxhash64("row_id", "f.at"), F.lit(salts)).cast("int").alias("salt"))
    hits = scratch.put(candidates.join(keys, ["print", "run", "salt"]).select(
        "row_id", "doc_id", "at", (F.col("at") + F.col("size")).alias("stop"), "set_id"), "hits")

    # Spans: a run that begins after all runs before it have ended opens a new one.
    in_order = W.partitionBy("row_id").orderBy("at", "stop")
    before = F.max("stop").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    opened = hits.withColumn("opens", F.coalesce(F.col("at") > before, F.lit(True)).cast("int"))
    spans = opened.withColumn("span", F.sum("opens").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))).groupBy(
        "row_id", "span").agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("first_word"),
                              F.max("stop").alias("end_word")).drop("span")
    per_row = spans.groupBy("row_id").agg(F.sum(F.col("end_word") - F.col("first_word")).alias("n_hit"))

    # Items: documents with the same sets have the same items.
    of_row = hits.groupBy("row_id").agg(F.array_sort(F.collect_set("set_id")).alias("set_ids"))
    of_row = of_row.withColumn("class_id", F.sha2(F.concat_ws(",", "set_ids"), 256))
    classes = of_row.groupBy("class_id").agg(F.first("set_ids").alias("set_ids"))
    members = classes.select("class_id", F.explode("set_ids").alias("set_id")).join(sets, "set_id").select(
        "class_id", F.explode("items").alias("item_id"))
    listed = members.groupBy("class_id").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("names")).select(
        "class_id", F.size("names").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "names").cast("binary"), 256).alias("items_sha256"))

    hit_rows = per_row.join(of_row.select("row_id", "class_id"), "row_id").join(listed, "class_id", "left")
    # Rows without any candidate never reach a join.
    none = F.sha2(F.lit("").cast("binary"), 256)
    out = rows.where(F.size("found") > 0).drop("found").join(hit_rows, "row_id", "left").unionByName(
        rows.where(F.size("found") == 0).drop("found"), allowMissingColumns=True)
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items_sha256", none).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated")), spans
