"""Near-duplicates of texts by BagMinHash.

A document is the multiset of its five-word shingles; similarity is weighted Jaccard, the
sum of smaller counts over the sum of larger ones.

Signatures. For every shingle the weight axis [0, count) is covered by dyadic blocks
[0,1), [1,2), [2,4), [4,8), ... Each block is a Poisson process of rate its width, seeded
by shingle and block. A point carries a signature position and, by bisecting its block
with one random bit per level, the unit of weight it falls in; points beyond the
shingle's count are passed over. A position keeps the earliest point over all shingles.
Points of a process come in order of time, so a process stops as soon as its next point
is later than the latest kept one: about n + m ln m points for n shingles and m
positions, instead of n * m. Two documents agree in a position with probability equal to
their weighted Jaccard similarity.

Bands. ``rows`` positions make a band key; ``bands`` keys per document. A pair at 0.8
shares a band with probability 1 - (1 - 0.8^6)^36 = 0.99998.

Sketches. Two bits of every position, packed in longs, tell pairs that cannot reach the
threshold from those that may: positions of a pair at 0.8 agree in 0.85 of their two-bit
values, and a pair is passed over below 0.75 (four standard deviations, 2e-5). Sizes alone
rule out others. Both tests are part of the joins, so such pairs never become rows.

Candidates. Texts with equal shingle multisets are one node from the start. A bucket of
up to ``small_bucket`` nodes gives its pairs. From a larger one every node meets the
bucket's centre, the node that shares most buckets with others and so is nearest to all.
In buckets that hold several components after that, nodes outside the bucket's largest one
meet all nodes of other components directly; there the join tests the multisets itself, so
that only links become rows, and a bucket's pairs are dealt to cells of a few hundred nodes. A
group of near copies thus costs a few rows per member, never its square, and no plausible
pair that shares a band goes unexamined unless both are already in one class.

Verification recomputes both multisets and keeps pairs of similarity >= ``threshold``: a
node's text travels to each of its candidates' centres, a centre's once per ``SALTS`` part of
its pairs, so no row carries two texts. Classes are the connected components of those links.

Defined cases: a text without words (null, empty, blank) is in a class of its own and
kept; a text of one to four words is one shingle; a null doc_id is a class of its own
with a null class id, kept; rows repeating a doc_id are one node if their multisets are
equal, else nodes of their own, each compared by its own text, and linked as one document;
an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, components, give_back, hashed_words, mix, shingle_hashes, sieve, sifted, texts

WORDS, THRESHOLD = 5, 0.8
ROWS, BANDS = 6, 36
SMALL_BUCKET = 16
# How far below its expectation the agreement of a link's sketches may be.
MARGIN = 0.10
# Parts that the pairs of one centre are dealt to.
SALTS = 32
# Members in a block, about: a bucket's pairs are dealt to cells of a block by a block.
CELL = 256

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# Shingles and points handled at once: bounds the memory of a task whatever its batches hold.
BLOCK, POINTS = 200_000, 1_000_000


def bag(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes of a text and their counts."""
    hashes, _ = hashed_words([text.encode("utf-8", "replace")])
    return np.unique(shingle_hashes(hashes, words), return_counts=True)


def bags(raws: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bags of several texts in one: owner, shingle and count, in order of owner and
    shingle."""
    flat, sizes = hashed_words(raws)
    many = np.maximum(sizes - words + 1, np.minimum(sizes, 1))  # shingles of each text
    ends = np.cumsum(many)
    begin = np.cumsum(sizes) - sizes
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    whole = np.flatnonzero(sizes >= words)
    if len(whole):
        runs = shingle_hashes(flat, words)
        for i in whole.tolist():
            own = out[ends[i] - many[i]:ends[i]]
            own[:] = runs[begin[i]:begin[i] + many[i]]
            own.sort()
    for i in np.flatnonzero((sizes > 0) & (sizes < words)).tolist():
        out[ends[i] - 1] = shingle_hashes(flat[begin[i]:begin[i] + sizes[i]], words)[0]
    owner = np.repeat(np.arange(len(raws)), many)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], out[at], np.diff(np.append(at, len(out)))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at], b[1][bt]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def bag_minhash(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, owners: int, m: int) -> np.ndarray:
    """Signatures (owners x m, times of the kept points) of weighted sets given as
    parallel arrays; an owner without elements keeps infinite times."""
    sig = np.full(owners * m, np.inf)
    # Dyadic blocks that begin below the count: block 0 is [0,1), block k is [2^(k-1), 2^k).
    parts, low, k = [], 0, 0
    while (inside := np.flatnonzero(count > low)).size:
        parts.append((inside, np.full(inside.size, k), np.full(inside.size, low)))
        k += 1
        low = 1 << (k - 1)
    if not parts:
        return sig.reshape(owners, m)
    of, block, start = (np.concatenate(c) for c in zip(*parts))
    doc, top = owner[of], count[of]
    rate = np.maximum(start, 1).astype(np.float64)
    inner = np.maximum(start, 1).astype(np.uint64) - np.uint64(1)  # mask of a place within the block
    seed = mix(shingle[of] ^ mix(block.astype(np.uint64) + _GOLDEN))
    time = np.zeros(len(doc))
    done, points = 0, 1
    latest = np.full(owners, np.inf)
    while len(doc):
        # The next points of every process still going: twice as many at each turn, as few
        # processes are left by then. Points later than needed change nothing.
        salt = np.arange(done + 1, done + points + 1, dtype=np.uint64) * _GOLDEN
        bits = mix(seed[:, None] + salt)  # 44 for the time, 20 for the position
        gaps = np.log(((bits >> np.uint64(20)).astype(np.float64) + 1.0) * 2.0 ** -44) / rate[:, None]
        gaps[:, 0] -= time
        times = -np.cumsum(gaps, axis=1)
        spot = doc[:, None] * m + ((bits & np.uint64(0xFFFFF)) % np.uint64(m)).astype(np.int64)
        ok = times < latest[doc][:, None]
        wide = np.flatnonzero(inner)  # blocks of several units: bisected by further bits
        place = start[wide, None] + (mix(bits[wide] ^ _GOLDEN) & inner[wide, None]).astype(np.int64)
        ok[wide] &= place < top[wide, None]
        np.minimum.at(sig, spot[ok], times[ok])
        time = times[:, -1]
        open_ = np.flatnonzero(np.bincount(doc, minlength=owners))
        latest[open_] = sig.reshape(owners, m)[open_].max(axis=1)
        go = time < latest[doc]
        doc, top, rate, inner, seed, time, start = (x[go] for x in (doc, top, rate, inner, seed, time, start))
        done += points
        points = max(1, min(2 * points, 64, POINTS // max(1, len(doc))))
    return sig.reshape(owners, m)


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + _GOLDEN, (len(sig), bands))
    for i in range(rows):
        key = mix(key * _GOLDEN + bits[:, :, i])
    return key.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits of every position: two bit planes of longs, one after the other."""
    bits = mix(sig.view(np.uint64))
    planes = [np.packbits((bits >> np.uint64(i)).astype(np.uint8) & 1, axis=1) for i in (0, 1)]
    width = -(-sig.shape[1] // 64) * 8
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in planes], axis=1).view(np.int64)


def plausible(m: int, threshold: float, x: str, y: str) -> Column:
    """Whether a pair may reach the threshold, by sizes (n) and sketches (s) of aliases x, y."""
    longs = -(-m // 64)
    at = lambda side, i: F.get(F.col(f"{side}.sk"), F.lit(i))
    unlike = None
    for i in range(longs):
        diff = at(x, i).bitwiseXOR(at(y, i)).bitwiseOR(at(x, i + longs).bitwiseXOR(at(y, i + longs)))
        unlike = F.bit_count(diff) if unlike is None else unlike + F.bit_count(diff)
    most = int(m * (1 - (threshold + (1 - threshold) / 4 - MARGIN)))
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (F.least(nx, ny) >= threshold * F.greatest(nx, ny)) & (unlike <= most)


def signatures(docs: DataFrame, words: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, h, digest, n, keys, sk) of every row, h being its text's hash; digest, keys and
    sketch are null without words. Rows with equal shingle multisets have equal digests."""
    m = rows * bands

    def block(ids: list, marks: list, raws: list[bytes]) -> pa.RecordBatch:
        owner, shingle, count = bags(raws, words)
        sig = bag_minhash(owner, shingle, count, len(raws), m)
        keys, small = band_keys(sig, rows, bands), sketch(sig)
        pairs = np.stack([shingle, count.astype(np.uint64)], axis=1)
        cut = np.searchsorted(owner, np.arange(len(raws) + 1))
        full = np.diff(cut) > 0
        digests = [hashlib.blake2b(pairs[x:y], digest_size=16).digest() if y > x else None for x, y in itertools.pairwise(cut.tolist())]
        n = np.bincount(owner, weights=count, minlength=len(raws)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(digests, pa.binary()), pa.array(n),
             *(pa.array([k if f else None for k, f in zip(c, full)], pa.list_(pa.int64())) for c in (keys, small))],
            names=["doc_id", "h", "digest", "n", "keys", "sk"])

    def run(batches):
        ids, marks, raws, held = [], [], [], 0
        for batch in batches:
            for doc_id, h, text in zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist(),
                                       texts(batch.column("text"))):
                ids.append(doc_id)
                marks.append(h)
                raws.append(text.encode("utf-8", "replace"))
                held += len(raws[-1]) // 6 + 1
                if held >= BLOCK:
                    yield block(ids, marks, raws)
                    ids, marks, raws, held = [], [], [], 0
        if ids:
            yield block(ids, marks, raws)
            ids, marks, raws = [], [], []
        give_back()

    return marked(docs).mapInArrow(run, "doc_id long, h long, digest binary, n long, keys array<long>, sk array<long>")


def marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def verified(pairs: DataFrame, bodies: DataFrame, words: int, threshold: float) -> DataFrame:
    """Those (a, b) of ``pairs`` whose texts reach ``threshold``. The text of a comes once
    before those of its partners, per part of them."""
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt")
    dealt = pairs.select("a", "b", salt)
    members = dealt.join(bodies.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "text")
    centres = dealt.select("a", "salt").distinct().join(bodies.withColumnRenamed("node", "a"), "a").select(
        "a", "salt", F.lit(None).cast("long").alias("b"), "text")

    def run(batches):
        centre = None
        for batch in batches:
            out = []
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text"))):
                if b is None:
                    centre = bag(text, words)
                elif weighted_jaccard(centre, bag(text, words)) >= threshold:
                    out.append((a, b))
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ordered = centres.unionByName(members).repartition("a", "salt").sortWithinPartitions(
        "a", "salt", F.col("b").asc_nulls_first())
    return ordered.select("a", "b", "text").mapInArrow(run, "a long, b long")


def multisets(bodies: DataFrame, words: int) -> DataFrame:
    """(doc, bag): a text's shingles as a set of longs; the k-th copy of a shingle is an
    element of its own, so sets share as much as the multisets do."""
    def run(batches):
        for batch in batches:
            out = []
            for text in texts(batch.column("text")):
                h, c = bag(text, words)
                copy = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                out.append((mix(np.repeat(h, c) + copy.astype(np.uint64) * _GOLDEN)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.list_(pa.int64()))],
                                             names=["node", "bag"])

    return bodies.select("node", "text").mapInArrow(run, "node long, bag array<long>")


def with_main(members: DataFrame) -> DataFrame:
    """Members (k, node, component) of buckets that hold several components, with the bucket's
    largest one as ``main``, and the numbers of blocks that the bucket's members outside it
    (``blocks_few``) and all of its members (``blocks_all``) are dealt to."""
    held = members.groupBy("k", "component").agg(F.count(F.lit(1)).alias("m"))
    several = held.groupBy("k").agg(F.max(F.struct("m", "component")).alias("most"), F.sum("m").alias("c"),
                                    F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return members.join(several.select(
        "k", F.col("most.component").alias("main"), F.ceil((F.col("c") - F.col("most.m")) / CELL).alias("blocks_few"),
        F.ceil(F.col("c") / CELL).alias("blocks_all")), "k")


def cells(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members outside their bucket's main component, and all members, each dealt to the
    cells (k, i, j) where it is held against others: a pair of the two meets in one cell, and no
    cell has many of either, however large its bucket. Dealt here, for the rows carry multisets
    and Spark would cut each side of a skewed key into small pieces, a task for every two."""
    block = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    few = members.where("component <> main").withColumn("i", block("blocks_few")).withColumn("j", every("blocks_all"))
    most = members.withColumn("j", block("blocks_all")).withColumn("i", every("blocks_few"))
    return few.repartition("k", "i", "j"), most.repartition("k", "i", "j")


def meet_main(members: DataFrame, condition: Column) -> DataFrame:
    """Pairs (a, b) of different components within each bucket. One of a pair is outside the
    bucket's ``main`` component, so only such members are held against the bucket: the join of
    a large group that is one component but for a few has few rows on one side."""
    few, most = cells(members)
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    cell = (F.col("x.k") == F.col("y.k")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    hit = cell & (F.col("x.component") != F.col("y.component")) & once & condition
    x, y = F.col("x.node"), F.col("y.node")
    return few.alias("x").join(most.alias("y"), hit).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def near_duplicates(docs: DataFrame, scratch: Scratch, *, words: int = WORDS, threshold: float = THRESHOLD,
                    rows: int = ROWS, bands: int = BANDS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, component_id (smallest doc_id of
    its class), kept (doc_id = component_id)."""
    sig = scratch.put(signatures(docs, words, rows, bands), "signatures")
    named = sig.where("doc_id is not null and digest is not null")
    # A node's text is that of one row: the smallest doc_id, and by hash if that has several.
    nodes = named.groupBy("digest").agg(F.min(F.struct("doc_id", "h")).alias("of"), *[
        F.first(c).alias(c) for c in ("n", "keys", "sk")])
    nodes = scratch.put(nodes.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("of.doc_id").alias("doc"),
                                     F.col("of.h").alias("h"), "n", "keys", "sk"), "nodes")
    entries = nodes.select(F.explode("keys").alias("k"), "node")
    shared = entries.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    buckets = entries.join(shared, "k")
    # How often a node meets others: the one nearest to all of a group has the most.
    degree = buckets.groupBy("node").agg(F.sum("c").alias("degree"))
    buckets = buckets.join(degree.join(nodes.select("node", "n", "sk"), "node"), "node")
    buckets = scratch.put(buckets.withColumn("component", F.col("node")), "buckets")
    met = scratch.put(nodes.join(buckets.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("doc").alias("doc_id"), "h"), "met")
    # Texts of nodes that meet no other are not moved.
    likely = sifted(marked(docs), "h", sieve(met, "h")).where("_likely")
    bodies = likely.join(met, ["doc_id", "h"]).select("node", "text")
    if not named.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        bodies = bodies.dropDuplicates(["node"])   # rows that are the same twice
    bodies = scratch.put(bodies, "bodies")
    likely = plausible(rows * bands, threshold, "x", "y")
    apart = F.col("x.component") != F.col("y.component")

    def meet(members: DataFrame, condition: Column) -> DataFrame:
        """Pairs of different components within each bucket."""
        hit = (F.col("x.k") == F.col("y.k")) & (F.col("x.node") < F.col("y.node")) & apart & condition
        return members.alias("x").join(members.alias("y"), hit).select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def star(members: DataFrame) -> DataFrame:
        """Plausible pairs of each bucket's centre with members of other components."""
        order = F.struct((-F.col("degree")).alias("d"), "node", "n", "sk", "component")
        centre = members.groupBy("k").agg(F.min(order).alias("m")).select("k", "m.*")
        hit = (F.col("x.k") == F.col("y.k")) & apart & likely
        return centre.alias("x").join(members.alias("y"), hit).select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def still_apart(members: DataFrame) -> DataFrame:
        """Buckets that hold several components, their members under their present ones."""
        at = members.select("k", "node", "n", "sk").join(comp.select("node", "component"), "node", "left")
        return with_main(at.withColumn("component", F.coalesce("component", "node")))

    members = buckets.where(F.col("c") > small_bucket)
    pairs = star(members).union(meet(buckets.where(F.col("c") <= small_bucket), likely)).distinct()
    edges = verified(pairs, bodies, words, threshold)
    twice = named.groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("d0 <> d1")
    if not twice.isEmpty():  # rows of one doc_id with different texts are one document
        own = named.join(twice.select("doc_id"), "doc_id").select("doc_id", "digest").distinct().join(
            nodes.select("digest", "node"), "digest")
        first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
        edges = edges.union(own.join(first, "doc_id").where("a <> node").select("a", F.col("node").alias("b")))
    edges = scratch.put(edges, "edges0")
    comp = components(edges, scratch, "cc0_")
    scratch.release()
    members = scratch.put(still_apart(members), "members")
    if not members.isEmpty():
        own = bodies.join(members.select("node").distinct(), "node", "left_semi")
        both = F.size(F.array_intersect("x.bag", "y.bag"))  # taken once per pair: |A n B| / |A u B| >= threshold
        close = both * (1 + threshold) >= threshold * (F.size("x.bag") + F.size("y.bag"))
        found = meet_main(members.join(multisets(own, words), "node"), likely & close).distinct()
        linked = scratch.put(found, "edges1")
        if not linked.isEmpty():
            comp = components(edges.union(linked), scratch, "cc1_")
    scratch.clear("signatures", "nodes", *[n for n in scratch.names if n.startswith("cc")])
    # A class is named by its smallest doc_id; nodes without a link are classes of their own.
    least = nodes.select("node", "doc").join(comp, "node").groupBy("component").agg(F.min("doc").alias("component_id"))
    of_node = comp.join(least, "component").select("node", "component_id")
    of_digest = nodes.select("digest", "doc", "node").join(of_node, "node", "left").select(
        "digest", F.coalesce("component_id", "doc").alias("component_id"))
    out = sig.select("doc_id", "digest").join(of_digest, "digest", "left").select(
        "doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, scratch: Scratch, **parameters) -> DataFrame:
    """One row of each class of near-duplicates, with its own columns: of the smallest
    doc_id, and of rows repeating that id the one that sorts first by text. Rows without a
    doc_id all stay."""
    classes = near_duplicates(docs, scratch, **parameters)
    kept = scratch.put(classes.where("kept and doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows")), "kept")
    del classes
    scratch.clear("kept")
    scratch.release()
    ids = kept.select(F.col("doc_id").alias("_id"))
    out = docs.join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    if not kept.where("rows > 1").isEmpty():
        order = W.partitionBy("doc_id").orderBy("text")
        out = out.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return out.unionByName(docs.where("doc_id is null"))
