"""Best-fit packing of tokenised documents into sequences, bulk-synchronously.

A document is its token ids and an end id. Only documents longer than a sequence are
cut: into whole sequences, the first piece taking what is left over. Whole pieces fill a
sequence each; the rest is packed best-fit decreasing:

1. Documents are range-sorted by length: every piece gets a global rank among the pieces
   of its length, from its place in its partition plus the counts of the partitions
   before (a distributed prefix sum; no piece is moved for it).
2. A superstep takes all pieces of one length, longest first. The gaps left in open
   sequences are held as sorted runs (gap, first sequence, number of sequences). A sweep
   from the successor of the length upwards hands each run as many pieces as it has
   sequences; pieces beyond all gaps open new sequences. Two pieces can never win the
   same gap: the piece of rank r in the step gets the r-th slot handed out.
3. Gaps shrink by the length, runs of equal gaps queue behind each other, and the next
   superstep follows until no length is left.

The supersteps need only how many pieces each length has, at most ``sequence_length``
numbers however large the corpus is; the slots they hand out are runs (length, first
rank, sequence, offset), bounded by the lengths and gaps there can be and not by the
documents. The runs are sent to all tasks, where a piece finds its slot by its rank. The
packing equals sequential best-fit decreasing on the same lengths.

Defined cases: a null or empty text is one piece holding only the end id; a null doc_id
is packed like any other; repeated rows are packed once each; an empty table gives an
empty result; other columns are ignored. With ``added_tokens`` a string of one of the
vocabulary file's added tokens (such as <|endoftext|>) is that token, as in ``tokenizers``
with add_special_tokens=False; without, it is ordinary text.
"""

from __future__ import annotations

import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, slices, texts

SEQUENCE_LENGTH = 1024
END_ID = 2

# GPT-style split pattern of the byte-level vocabularies (fixed value).
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of bytes in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        shown[chr(256 + i)] = b
    return shown


class Encoder:
    """Ids of texts, as bytes of little-endian unsigned 32-bit numbers, by the vocabulary
    file of a byte-level tokenizer. With ``added_tokens`` a text is split at the strings of
    the file's added tokens, which get their ids; else they are ordinary text.

    A space between two characters that are not white space always starts a token, so a
    text is cut there and each word is encoded once; words are remembered, in two generations
    of a fixed number: a full one becomes the old one, from which words met again come back.
    A text with other white space beside a space is encoded whole."""

    LIMIT = 300_000

    def __init__(self, path: str, added_tokens: bool = False):
        import re
        import tiktoken
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                 if piece not in special}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.unsafe = re.compile(r" \s|\s ")
        self.added: dict[str, bytes] = {}
        if added_tokens:
            if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
                raise ValueError(f"{path}: added tokens that depend on the text around them are not supported")
            self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None
        self.forget()

    def forget(self) -> None:
        """Drop all remembered words."""
        self.first, self.later, self.old = {}, {}, {}

    def raw(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not any(token in text for token in self.added):
            return self.ordinary(text)
        parts = self.at_added.split(text)
        return b"".join([self.added[p] if i % 2 else self.ordinary(p) for i, p in enumerate(parts)])

    def ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        if self.unsafe.search(text):
            return self.raw(text)
        head, *rest = text.split(" ")
        start = self.first.get(head)
        if start is None:
            if len(self.first) >= self.LIMIT:
                self.first.clear()
            start = self.first[head] = self.raw(head)
        later = self.later
        try:
            return start + b"".join([later[w] for w in rest])
        except KeyError:
            if len(later) >= self.LIMIT:
                self.old, self.later = later, {}
                later = self.later
            old = self.old
            for w in rest:
                if w not in later:
                    later[w] = old[w] if w in old else self.raw(" " + w)
            return start + b"".join([later[w] for w in rest])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    key = path, added_tokens
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, added_tokens)
    return _ENCODERS[key]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` ids: all but the first are ``size`` long."""
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def tokenised(docs: DataFrame, path: str, size: int, end_id: int, added_tokens: bool = False) -> DataFrame:
    """Pieces of every document, each with its partition and its place among that
    partition's pieces of the same length."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(path, added_tokens)
        places = [0] * (size + 1)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                ids = memoryview(enc.encode(text) + end)
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]),
                                 part, places[length]))
                    places[length] += 1
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=[f.split(" ")[0] for f in _PIECES.split(", ")])
        enc.forget()  # a worker may have other tasks from now on

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


class Gaps:
    """Open sequences as runs of equal gaps: for each gap a queue of (first sequence,
    number of sequences)."""

    def __init__(self):
        self.sorted: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def successor(self, length: int) -> int | None:
        at = bisect.bisect_left(self.sorted, length)
        return self.sorted[at] if at < len(self.sorted) else None

    def take(self, gap: int, most: int) -> tuple[int, int]:
        queue = self.runs[gap]
        first, count = queue.pop()
        taken = min(count, most)
        if taken < count:
            queue.append((first + taken, count - taken))
        elif not queue:
            del self.runs[gap]
            self.sorted.remove(gap)
        return first, taken

    def put(self, gap: int, first: int, count: int) -> None:
        if gap <= 0:
            return
        if gap not in self.runs:
            bisect.insort(self.sorted, gap)
            self.runs[gap] = []
        queue = self.runs[gap]
        if queue and queue[-1][0] + queue[-1][1] == first:
            first, count = queue[-1][0], queue.pop()[1] + count
        queue.append((first, count))


def supersteps(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int]]:
    """Slots (length, first rank, first sequence, offset) handed out to all pieces, given
    how many there are of each length. Consecutive ranks of a slot go to consecutive
    sequences at the same offset."""
    gaps, slots, opened = Gaps(), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            gap = gaps.successor(length)
            each = (gap or size) // length  # pieces of this length that fit one gap
            if gap is None:
                gap, first, count = size, opened, -(-left // each)
                opened += count
            else:
                first, count = gaps.take(gap, -(-left // each))
            placed = min(left, each * count)
            full, rest = divmod(placed, each)  # sequences filled, pieces in the last one
            for k in range(each):
                n = full + (k < rest)
                if n:
                    slots.append((length, rank, first, size - gap + k * length))
                    rank += n
            gaps.put(gap - each * length, first, full)
            if rest:
                gaps.put(gap - rest * length, first + full, 1)
            left -= placed
    return slots


def pack(docs: DataFrame, scratch: Scratch, *, sequence_length: int = SEQUENCE_LENGTH, end_id: int = END_ID,
         path: str | None = None, added_tokens: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    size = sequence_length
    spark = docs.sparkSession
    pieces = scratch.put(tokenised(docs, path or tokenizer_path(), size, end_id, added_tokens), "pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = per_part.withColumn("before", F.sum("n").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    before = before.select(F.col("part").alias("p"), F.col("length").alias("len"),
                           F.coalesce("before", F.lit(0)).alias("before"))
    # At most sequence_length rows: a count for each length there can be.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = supersteps(counts, size)
    table = np.array(slots, np.int64).reshape(-1, 4)
    order = np.lexsort((table[:, 1], -table[:, 0]))
    sent = spark.sparkContext.broadcast(table[order])

    def place(batches):
        slot = sent.value
        bounds = {}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                if n not in bounds:
                    lo, hi = np.searchsorted(-slot[:, 0], [-n, -n + 1])
                    bounds[n] = slot[lo:hi]
                own, rows = bounds[n], np.flatnonzero(length == n)
                at = np.searchsorted(own[:, 1], rank[rows], side="right") - 1
                sequence[rows] = own[at, 2] + rank[rows] - own[at, 1]
                offset[rows] = own[at, 3]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(before, (F.col("part") == F.col("p")) & (F.col("length") == F.col("len"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
