"""Alignment of two tokenizers over a corpus, each distinct text once.

1. Rows are shuffled by their full text and counted: a text and its multiplicity.
2. Each distinct text is tokenised by both vocabularies (space + text by A, a byte-level
   one; text by B, a SentencePiece model that adds the space itself). Byte offsets at
   which tokens of both end cut the tokens into groups; inside a group the tokens that
   overlap form a staircase, walked with two pointers. No token of either vocabulary spans
   a space that follows another character, so the units between such spaces are
   independent: a unit is aligned once and remembered (a bounded number of them).
3. Every overlapping pair of token occurrences is a link; a pair of ids counts its links
   over the corpus, each text's weighted by its multiplicity.
4. Counts go back to the texts: the pairs with the largest counts (a fixed number, so the
   table sent to the tasks is bounded and no pair that many texts hold is a join key) are
   looked up in place, the rest are joined by pair and added up per text.
5. Measures are joined to the rows by the text's SHA-256. A text that over one row in 1,024
   repeats is joined by broadcast: there are fewer than 1,024 of those.

Defined cases: null and empty texts, and texts that either vocabulary does not give back
byte for byte (such as those holding U+2581), have no tokens: all measures 0, the digest of
their groups empty. Repeated rows count once each in the pair counts and get equal
measures; a null doc_id is carried like any other; of pairs with equal counts all are best;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import packing, pieces
from .common import Scratch

# Pairs looked up in the tasks; texts that are joined by broadcast hold over 1 / HOT of all rows.
FREQUENT, HOT = 1 << 18, 1024
# Units remembered in each of two generations, the longest such unit, rows and units handled at once.
LIMIT, LONGEST, ROWS, UNITS = 160_000, 64, 512, 1 << 16

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = ("digest string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "codes array<long>, times array<long>")


def walk(a: list[int], b: list[int], one: "Vocabulary", two: "Vocabulary") -> tuple[list[int], list[str]]:
    """Links, as pair codes (id of A times the ids of B, plus id of B), and groups, as text, of
    two token sequences over the same bytes."""
    size_a, name_a, size_b, name_b, n_b = one.size, one.name, two.size, two.name, len(two.size)
    codes, groups = [], []
    i = j = 0
    x, y = a[0], b[0]
    left, right, ahead = name_a[x], name_b[y], size_a[x] - size_b[y]
    while True:
        codes.append(x * n_b + y)
        if ahead == 0:
            groups.append(f"{left}|{right}")
            i += 1
            j += 1
            if i == len(a):
                return codes, groups
            x, y = a[i], b[j]
            left, right, ahead = name_a[x], name_b[y], size_a[x] - size_b[y]
        elif ahead < 0:
            i += 1
            x = a[i]
            left = f"{left},{name_a[x]}"
            ahead += size_a[x]
        else:
            j += 1
            y = b[j]
            right = f"{right},{name_b[y]}"
            ahead -= size_b[y]


class Vocabulary:
    """Bytes of each id, their number, and the id in decimal."""

    def __init__(self, spelled: list[bytes]):
        self.bytes = spelled
        self.size = [len(x) for x in spelled]
        self.name = [str(i) for i in range(len(spelled))]


class Aligner:
    """Both vocabularies, and the units aligned lately."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = packing.encoder(path_a).bpe
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_b = sp.vocab_size()
        ranks = self.a._mergeable_ranks
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            spelled[i] = token
        self.one = Vocabulary(spelled)
        spelled = []
        for i in range(self.n_b):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                spelled.append(b"")
            else:
                if re.search(f"[^{pieces.BLANK}]{pieces.BLANK}", piece):
                    raise ValueError(f"piece {piece!r} spans a unit's end")
                spelled.append(piece.replace(pieces.BLANK, " ").encode())
        self.two = Vocabulary(spelled)
        self.lone_space = sp.encode("a ")[len(sp.encode("a")):]
        self.beside = re.compile(r" \s|\s |^\s|\s$")
        self.cut = re.compile(r"(?<=\S)(?= )")
        self.sizes: dict[tuple[int, int, int], bytes] = {}   # few: numbers of tokens of a unit
        self.met: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def units(self, text: str) -> list[str]:
        """The units of space + text, each without the space it begins with."""
        if not self.beside.search(text):
            return text.split(" ")
        return [u[1:] for u in self.cut.split(" " + text)]

    def align(self, unit: str, b: list[int]) -> tuple[bytes, bytes, str] | None:
        """Links as pair codes, numbers of tokens and groups, and groups as text; None where B
        does not give back the unit's bytes (A, being byte-level, always does)."""
        text, spelled = " " + unit, self.two.bytes
        b = b or self.lone_space
        if b"".join([spelled[i] for i in b]) != text.encode():
            return None
        a = self.a.encode_ordinary(text)
        codes, groups = walk(a, b, self.one, self.two)
        sizes = len(a), len(b), len(groups)
        if sizes not in self.sizes:
            self.sizes[sizes] = array("q", sizes).tobytes()
        return array("q", codes).tobytes(), self.sizes[sizes], ";".join(groups)

    def learn(self, units: set[str]) -> None:
        """Align units not met lately. Long ones are not remembered."""
        if len(self.met) > LIMIT:
            self.old, self.met = self.met, {}
        new = [u for u in units if u not in self.met and len(u) <= LONGEST]
        self.met.update((u, self.old[u]) for u in new if u in self.old)
        new = [u for u in new if u not in self.met]
        for unit, b in zip(new, self.b.encode(new, num_threads=1)):
            self.met[unit] = self.align(unit, b)

    def get(self, unit: str) -> tuple | None:
        return self.met[unit] if len(unit) <= LONGEST else self.align(unit, self.b.encode(unit))

    def measure(self, units: list[str]) -> tuple | None:
        """n_a, n_b, n_groups, n_links, SHA-256 of the groups, pair codes and how often the
        text holds each; None for a text without tokens. A run of units at a time."""
        digest = hashlib.sha256()
        total, codes, times = np.zeros(3, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(units), UNITS):
            found = [self.get(u) for u in units[start:start + UNITS]]
            if None in found:
                return None
            if len(self.sizes) > LIMIT:
                self.sizes.clear()
            if start:
                digest.update(b";")
            digest.update(";".join([f[2] for f in found]).encode())
            total += np.frombuffer(b"".join([f[1] for f in found]), "<i8").reshape(-1, 3).sum(axis=0)
            new, n = np.unique(np.frombuffer(b"".join([f[0] for f in found]), "<i8"), return_counts=True)
            if start:
                new, back = np.unique(np.concatenate([codes, new]), return_inverse=True)
                n = np.bincount(back, np.concatenate([times, n])).astype(np.int64)
            codes, times = new, n
        return *total.tolist(), int(times.sum()), digest.hexdigest(), codes, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    key = path_a, path_b
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def aligned(distinct: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Measures and pair codes of each distinct text (digest, copies, text)."""
    names = [f.split(" ")[0] for f in _ALIGNED.split(", ")]
    none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))

    def run(batches):
        both = aligner(path_a, path_b)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                units = [both.units(t) for t in part.column("text").to_pylist()]
                both.learn(set().union(*units))
                out = list(zip(*[both.measure(u) or none for u in units]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), part.column("copies"), *(pa.array(c, pa.int64()) for c in out[:4]),
                     pa.array(out[4], pa.string()), _lists(out[5]), _lists(out[6])], names=names)

    return distinct.select("digest", "copies", "text").mapInArrow(run, _ALIGNED)


def pair_counts(texts: DataFrame, n_b: int) -> DataFrame:
    """Links of each pair of ids over the corpus: code, a, b, n, best (n is the largest of
    the pairs with this id of B)."""
    each = texts.select("copies", F.explode(F.arrays_zip("codes", "times")).alias("p"))
    counted = each.groupBy(F.col("p.codes").alias("code")).agg(F.sum(F.col("copies") * F.col("p.times")).alias("n"))
    named = counted.select("code", F.floor(F.col("code") / n_b).cast("long").alias("a"),
                           (F.col("code") % n_b).alias("b"), "n")
    # Pairs of one id of B: at most as many as A has ids.
    return named.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy("b")))


def scored(texts: DataFrame, pairs: DataFrame, frequent: int) -> DataFrame:
    """Measures of each distinct text, n_best and count_sum included."""
    spark = texts.sparkSession
    # At most ``frequent`` rows, whatever the corpus.
    top = pairs.orderBy(F.desc("n"), "code").limit(frequent).select("code", "n", "best").toPandas().sort_values("code")
    sent = spark.sparkContext.broadcast((top["code"].to_numpy(np.int64), top["n"].to_numpy(np.int64),
                                         top["best"].to_numpy(bool)))
    ddl = ("digest string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "n_best long, count_sum long, codes array<long>, times array<long>")
    names = [f.split(" ")[0] for f in ddl.split(", ")]

    def look_up(batches):
        keys, counts, best = sent.value
        for batch in batches:
            n_best, count_sum, left, left_times = [], [], [], []
            offsets = batch.column("codes").offsets.to_numpy()
            all_codes = batch.column("codes").values.to_numpy()
            all_times = batch.column("times").values.to_numpy()
            base = batch.column("times").offsets.to_numpy()[0] - offsets[0]
            for lo, hi in zip(offsets[:-1], offsets[1:]):
                codes, times = all_codes[lo:hi], all_times[lo + base:hi + base]
                at = np.searchsorted(keys, codes)
                at[at == len(keys)] = 0
                known = keys[at] == codes if len(keys) else np.zeros(len(codes), bool)
                own = at[known]
                n_best.append(int((times[known] * best[own]).sum()))
                count_sum.append(int((times[known] * counts[own]).sum()))
                left.append(codes[~known])
                left_times.append(times[~known])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:7]), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                 _lists(left), _lists(left_times)], names=names)

    looked = texts.mapInArrow(look_up, ddl)
    rare = looked.select("digest", F.explode(F.arrays_zip("codes", "times")).alias("p")).select(
        "digest", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    joined = rare.join(pairs.select("code", "n", "best"), "code").select(
        "digest", *[F.lit(None).cast(t).alias(c) for c, t in [
            ("copies", "long"), *((m, "long") for m in MEASURES), ("groups_sha256", "string")]],
        F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    # One row per text carries its measures; rows of its rare pairs add to the two sums.
    return looked.drop("codes", "times").unionByName(joined).groupBy("digest").agg(
        *[F.max(c).alias(c) for c in ("copies", *MEASURES, "groups_sha256")],
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, scratch: Scratch, *, path_a: str | None = None, path_b: str | None = None,
          frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Measures of each row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256; and the corpus's pairs: code, a, b, n, best."""
    path_a, path_b = path_a or packing.tokenizer_path(), path_b or pieces.model_path()
    empty = F.col("text").isNull() | (F.col("text") == "")
    distinct = docs.where(~empty).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = scratch.put(aligned(distinct.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)),
                                path_a, path_b), "texts")
    import sentencepiece
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()
    pairs = scratch.put(pair_counts(texts, n_b), "pairs")
    measured = scratch.put(scored(texts, pairs, frequent), "measured")
    scratch.drop("texts")

    values = [*MEASURES, "n_best", "count_sum", "groups_sha256"]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.when(~empty, F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    total = measured.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(measured.where(F.col("copies") * HOT > total).select("digest", *values))
    rest = measured.where(F.col("copies") * HOT <= total).select("digest", *values)
    without = keyed.where("digest is null").select(
        "doc_id", *[F.lit("" if v == "groups_sha256" else 0).cast("string" if v == "groups_sha256" else "long").alias(v)
                    for v in values])
    present = keyed.where("digest is not null")
    some = present.join(hot.select("digest"), "digest", "left_anti").join(rest, "digest")
    out = present.join(hot, "digest").unionByName(some).select("doc_id", *values).unionByName(without)
    return out, pairs
