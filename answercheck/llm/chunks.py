"""Substring dedup by content-defined chunks.

A gear rolling hash (one shift and one add per byte, here computed for all positions at
once by doubling) depends on the last 16 bytes only. A chunk ends after a white-space
byte whose hash is divisible by ``one_in``, about every fifth word; in long
stretches without white space any character may end one. So the cuts depend on nearby
content alone and come back in step right after an insertion. A chunk that would exceed
``max_chunk`` bytes, as where one word is repeated, is cut after the next word beyond half of
that: chunks of equal words are then equal wherever the first began.

Matching is by runs: from each chunk on, the fewest consecutive chunks that span ``min_run``
bytes, as a 64-bit digest of those bytes. A run is a repeat if a document with a smaller
doc_id holds it, as one stretch; its bytes are removed, overlapping runs together. Every
removed byte thus lies in ``min_run`` bytes or more that one earlier document holds, and a
stray common phrase is left alone (two of 10^12 runs that share a digest by chance: one text
in 10^8). The smallest doc_id keeps the passage.

Digests are grouped by partial minima, so a passage held by a third of all documents is
one row per task; the join back is one that AQE splits. A filter of fixed size keeps runs
that do not repeat, and then texts without a repeat, out of the shuffles.

Defined cases: a null text is empty; a null doc_id neither gives nor loses runs; rows
repeating a doc_id are one document, none a repeat of the other, and lose the same runs; a text under ``min_run``
bytes is left whole; repeats within one document stay; an empty table gives an empty
result; other columns are carried if asked for and not clashing with result columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Scratch, mix, sieve, sifted, slices, texts

ONE_IN, MAX_CHUNK, MIN_RUN = 5, 256, 100
# Without white space in so many bytes, any character may end a chunk, with this chance.
LONG_STRETCH, ONE_IN_CHARS = 64, 32

_GEAR = (mix(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


def gear(raw: np.ndarray) -> np.ndarray:
    """Gear hash of the last 16 bytes at every position."""
    h = _GEAR[raw] & np.uint32(0xFFFF)
    for width in (1, 2, 4, 8):
        earlier = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += earlier
    return h


def cuts(raw: np.ndarray, one_in: int = ONE_IN, max_chunk: int = MAX_CHUNK) -> np.ndarray:
    """End of each chunk of a text's bytes; the last is the text's length."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64)
    scaled = mix(gear(raw).astype(np.uint64)) >> np.uint64(32)
    white = _IS_WHITE[raw]
    at = np.arange(n)
    last_white = np.maximum.accumulate(np.where(white, at, -1))
    starts_char = np.empty(n, bool)  # the byte after this one begins a character
    starts_char[:-1] = (raw[1:] & 0xC0) != 0x80
    starts_char[-1] = True
    ends = white & (scaled % np.uint64(one_in) == 0)
    ends |= (at - last_white > LONG_STRETCH) & starts_char & (scaled % np.uint64(ONE_IN_CHARS) == 0)
    ends[-1] = True
    found = np.flatnonzero(ends) + 1
    sizes = np.diff(found, prepend=0)
    if sizes.max() <= max_chunk:
        return found
    out, start = [], 0
    blanks = np.flatnonzero(white)
    for end in found.tolist():
        while end - start > max_chunk:
            after = np.searchsorted(blanks, start + max_chunk // 2)
            stop = int(blanks[after]) + 1 if after < len(blanks) else n
            if stop > start + max_chunk:    # no word ends there: at a character
                stop = start + max_chunk
                while not starts_char[stop - 1]:
                    stop += 1
            if stop >= end:
                break
            out.append(stop)
            start = stop
        out.append(end)
        start = end
    return np.array(out, np.int64)


def runs(raw: bytes, one_in: int, max_chunk: int, min_run: int) -> tuple[list[tuple[int, int]], list[int], int]:
    """(start, end) and digest of the run that begins at each chunk, and the number of chunks."""
    import xxhash
    ends = cuts(np.frombuffer(raw, np.uint8), one_in, max_chunk)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    last = np.searchsorted(ends, starts + min_run)
    inside = last < len(ends)
    places = list(zip(starts[inside].tolist(), ends[last[inside]].tolist()))
    return places, [xxhash.xxh3_64_intdigest(raw[s:e]) - (1 << 63) for s, e in places], len(ends)


def run_rows(docs: DataFrame, one_in: int, max_chunk: int, min_run: int) -> DataFrame:
    """(digest, doc_id) of each distinct run of each row that has a doc_id."""
    def run(batches):
        for batch in slices(batches):
            ids, keys, counts = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                own = set(runs(text.encode("utf-8", "replace"), one_in, max_chunk, min_run)[1])
                ids.append(doc_id)
                counts.append(len(own))
                keys.extend(own)
                if len(keys) > 200_000:
                    yield _rows(ids, keys, counts)
                    ids, keys, counts = [], [], []
            yield _rows(ids, keys, counts)

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "digest long, doc_id long")


def _rows(ids: list, keys: list, counts: list) -> pa.RecordBatch:
    owner = np.repeat(np.array(ids, np.int64), np.array(counts, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(owner)], names=["digest", "doc_id"])


def merged(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches covered by (start, end) in order of start, overlapping and touching ones as one."""
    out: list[tuple[int, int]] = []
    for s, e in places:
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


RESULT = ("n_bytes long, n_chunks long, n_removed long, n_spans long, kept_sha256 string, removed_spans string, "
          "kept_text string")
INTERNAL = ("_id", "_text", "_repeats", "_rid", "_place", "_word", "_set", "_likely")


def deduplicate(docs: DataFrame, carry: list[str], *, one_in: int = ONE_IN, max_chunk: int = MAX_CHUNK,
                min_run: int = MIN_RUN) -> DataFrame:
    """``carry`` columns of each row of ``docs`` (doc_id, text), what was removed (spans as
    start:end in bytes, comma-joined), and the text that is left (null for a null text)."""
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    carry = [c for c in carry if c not in names and c not in INTERNAL]
    scratch = Scratch(docs.sparkSession, "chunks")
    rows = run_rows(docs, one_in, max_chunk, min_run)
    first = scratch.put(rows.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                        .where("lo < hi").select("digest", "lo"), "first")
    scratch.release()
    likely = sifted(rows, "digest", sieve(first, "digest")).where("_likely")
    repeats = scratch.put(likely.join(first, "digest").where("lo < doc_id").groupBy(F.col("doc_id").alias("_rid"))
                          .agg(F.collect_set("digest").alias("_repeats")), "repeats")
    scratch.clear("repeats")
    scratch.release()
    kept = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("doc_id").cast("long").alias("_id"),
                       F.col("text").alias("_text"))
    # Texts that hold no repeat are not moved.
    dealt = sifted(kept, "_id", sieve(repeats, "_rid"))
    joined = dealt.where("_likely").drop("_likely").join(repeats, F.col("_id") == F.col("_rid"), "left").drop("_rid")
    joined = joined.unionByName(dealt.where("not _likely").drop("_likely").withColumn(
        "_repeats", F.lit(None).cast("array<bigint>")))
    fields = [f for f in kept.schema.fields if f.name in carry]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), RESULT])

    def run(batches):
        for batch in slices(batches):
            cols: list[list] = [[] for _ in names]
            for text, own in zip(batch.column("_text").to_pylist(), batch.column("_repeats").to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                again = set(own or ())
                places, keys, n = runs(raw, one_in, max_chunk, min_run)
                spans = merged([p for p, k in zip(places, keys) if k in again]) if again else []
                left, at = [], 0
                for s, e in spans:
                    left.append(raw[at:s])
                    at = e
                rest = b"".join([*left, raw[at:]])
                values = (len(raw), n, len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
                          ",".join([f"{s}:{e}" for s, e in spans]), None if text is None else rest.decode("utf-8"))
                for col, v in zip(cols, values):
                    col.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=[*carry, *names])

    return joined.mapInArrow(run, ddl)
