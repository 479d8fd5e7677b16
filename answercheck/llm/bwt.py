"""Substring dedup by merging Burrows-Wheeler transforms.

Every byte that lies in a string of ``length`` = 50 bytes which also starts in a document
of smaller doc_id is removed; texts are UTF-8 bytes, matches never cross documents.

A suffix array of the whole corpus would move every suffix. Equal strings are brought
together first, so that each part of the order can be built apart:

1. Anchors. Of the 16-byte grams in a window of 50 bytes the one with the smallest hash
   is its anchor, so equal windows have equal anchors, and consecutive windows mostly
   share one. A window whose anchor occurs in one text only cannot repeat. Equal texts
   count once here: a copy repeats as a whole.
2. Strings. A run of windows with the same shared anchor is one string (50 bytes and one
   more for each further window). Equal strings become one, with the smallest doc_id: first
   those of some megabytes of text, of which one alone carries its bytes on, then those of a
   bucket; occurrences in other documents are removed whole. Strings are moved once, to
   buckets by anchor: a window's equals are all in its bucket. A string alone at its anchor
   has nothing left to be compared with.
3. Transforms. A bucket's strings are split into shards of at most ``shard`` bytes, the strings
   of an anchor in one shard if they fit. A shard's Burrows-Wheeler transform (to a context of
   50 bytes) holds for every suffix the bytes before it, and the step to the suffix that
   begins there.
4. Merge. The transforms of shards that an anchor spans are interleaved (others have no window
   in common): starting from one after the other, a pass visits the suffixes in the present
   order, steps back and distributes them stably by the bytes stepped over. After a pass the
   interleave is right to those bytes more: three or four, as many as 16 bits can number. When it
   is right to 50, or unchanged, the merge ends. No suffix is compared with another or sorted again.
5. Repeats. Neighbours of the merged order with a common prefix of 50 bytes or more form
   the repeated intervals; an interval's smallest doc_id decides which windows go.
6. Removed windows are joined back to their documents, and their union is cut out.

Skew: anchors, strings and copies held by a third of the documents are combined before they are
moved and the joins back are ones AQE splits. A bucket holds ``strings_per_bucket`` strings on average, and of one
anchor at most ``strings_per_anchor``. Where an anchor may have more (a template field or a phrase with ever
new text around it), its strings are not gathered: each of their windows finds its smallest doc_id by partial
aggregation on the window itself.

Defined cases: a null text is empty; a text under 50 bytes loses nothing; a null doc_id
neither gives nor loses; rows repeating a doc_id are one document: nothing in them
repeats the other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, mix, packed, slices, texts, unpacked

LENGTH, GRAM = 50, 16
SHARD, STRINGS_PER_BUCKET, STRINGS_PER_ANCHOR = 1 << 18, 65_536, 16_384
# Usual bytes of a string: an anchor is also crowded by longer ones.
STRING_BYTES = 100
# Bytes of text handled at once when looking for anchors.
BUFFER = 1 << 17
# Blocks whose equal strings become one before they are moved, and rows of a bucket that wait for it.
BLOCKS, WAITING = 16, 1 << 17
# A byte that UTF-8 never uses ends a string.
END = 0xFF

_BASE = 0x9E3779B97F4A7C15


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` (a power of two) bytes from every position on, by doubling."""
    h, size = raw.astype(np.uint64) + np.uint64(1), 1
    while size < gram:
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    return mix(h)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[:-(width - span)], a[width - span:]) if width > span else a


def window_runs(raws: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text number, first window, windows, anchor hash) of the runs of consecutive windows
    with equal anchors, as arrays."""
    buffer = np.frombuffer(b"".join(raws), np.uint8)
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    if len(buffer) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    anchor = sliding_min(gram_hashes(buffer, gram), length - gram + 1)
    of = np.repeat(np.arange(len(raws)), sizes)[:len(anchor)]
    at = np.arange(len(anchor))
    valid = at + length <= ends[of]
    first = valid.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1]) | ~valid[:-1]
    start = np.flatnonzero(first)
    # A run ends before the next one starts or where its text has no further window.
    stop = np.minimum(np.append(start[1:], len(anchor)), ends[of[start]] - length + 1)
    return of[start], start - (ends - sizes)[of[start]], stop - start, anchor[start]


def _blocks(rows: Iterator, size: int) -> Iterator[list]:
    """Rows whose last item is a text's bytes, in lists of about ``size`` bytes."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _grouped(key: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs sorted by key, and the size of each pair's key group."""
    order = np.lexsort((t, key))
    key, t = key[order], t[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (t[1:] != t[:-1])
    key, t = key[new], t[new]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(start, len(key)))
    return key, t, np.repeat(sizes, sizes)


def shared_anchors(docs: DataFrame) -> DataFrame:
    """(t, h): the anchors h of text t that some other text has too.

    Within a batch of texts, anchors held by several are known at once: their rows go on as
    they are, and one marker stands for all of them, so an anchor held by a third of all
    texts is one row per batch. Markers and the other rows meet by anchor, in one shuffle,
    and are read in order; of a group only its first text is remembered."""
    def gather(batches):
        for batch in batches:
            rows = zip(batch.column("t").to_pylist(), (x.encode("utf-8", "replace") for x in texts(batch.column("text"))))
            keys, names = [], []
            for block in _blocks(rows, BUFFER):
                of, _, _, h = window_runs([r for _, r in block])
                keys.append(h.view(np.int64))
                names.append(np.array([t for t, _ in block], np.int64)[of])
            if not keys:
                continue
            h, t, size = _grouped(np.concatenate(keys), np.concatenate(names))
            lone, known = size == 1, size > 1
            marker = known & np.append(True, h[1:] != h[:-1])[:len(h)]
            n0, n1, n2 = int(lone.sum()), int(marker.sum()), int(known.sum())
            key = np.concatenate([h[lone], h[marker], t[known]])
            text = np.concatenate([t[lone], np.zeros(n1, np.int64), t[known]])
            own = np.concatenate([np.zeros(n0 + n1, np.int64), h[known]])
            at = np.arange(n0 + n1 + n2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(text, mask=(at >= n0) & (at < n0 + n1)), pa.array(own, mask=at < n0 + n1)],
                names=["key", "t", "h"])

    def meet(batches):
        carried = None  # (key, its only text so far or None, whether it is shared)
        for batch in batches:
            direct = batch.column("h").is_valid().to_numpy(zero_copy_only=False)
            key = batch.column("key").to_numpy()
            marked = ~batch.column("t").is_valid().to_numpy(zero_copy_only=False)
            t = batch.column("t").fill_null(0).to_numpy()
            h = batch.column("h").fill_null(0).to_numpy()
            out_t, out_h = [t[direct]], [h[direct]]
            key, t, marked = key[~direct], t[~direct], marked[~direct]
            if len(key):
                start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                least = np.minimum.reduceat(np.where(marked, np.iinfo(np.int64).max, t), start)
                most = np.maximum.reduceat(np.where(marked, np.iinfo(np.int64).min, t), start)
                shared = np.logical_or.reduceat(marked, start) | (least < most)
                some = least <= most
                if carried and carried[0] == key[0]:
                    _, only, was = carried
                    shared[0] |= was or (only is not None and some[0] and (least[0] != only or most[0] != only))
                    if shared[0] and not was and only is not None:
                        out_t.append(np.array([only]))
                        out_h.append(key[:1])
                    if not shared[0] and only is not None:
                        least[0], some[0] = only, True
                size = np.diff(np.append(start, len(key)))
                keep = np.repeat(shared, size) & ~marked
                out_t.append(t[keep])
                out_h.append(key[keep])
                carried = (key[-1], int(least[-1]) if some[-1] else None, bool(shared[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_t)), pa.array(np.concatenate(out_h))],
                                             names=["t", "h"])

    rows = docs.select("t", "text").mapInArrow(gather, "key long, t long, h long")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "t long, h long")


_STRINGS = "h long, s binary, doc_id long, t long, pos int, lo long, n long"


def first_of_equals(bodies: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the first of equal strings their smallest id and their number, for others 0 as number."""
    seen: dict[bytes, int] = {}
    first = np.fromiter((seen.setdefault(body, i) for i, body in enumerate(bodies)), np.int64, len(bodies))
    lo = ids.copy()
    np.minimum.at(lo, first, ids)
    return lo, np.bincount(first, minlength=len(bodies))


def strings(docs: DataFrame) -> DataFrame:
    """Runs of windows whose anchor is among the row's ``shared`` ones, as strings; texts are
    ``packed``. Of equal strings of some blocks the first has the smallest doc_id ``lo`` and
    their number ``n``."""
    def told(held):
        h, ids, names, start = (np.concatenate([part[i] for part in held]) for i in (0, 2, 3, 4))
        body = [b for part in held for b in part[1]]
        lo, n = first_of_equals(body, ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(body, pa.binary()), pa.array(ids), pa.array(names), pa.array(start.astype(np.int32)),
             pa.array(lo, mask=n == 0), pa.array(n)], names=["h", "s", "doc_id", "t", "pos", "lo", "n"])

    def run(batches):
        held = []
        for batch in slices(batches):
            ids, names = batch.column("doc_id").to_numpy(), batch.column("t").to_numpy()
            anchors, upto = batch.column("shared").values.to_numpy(), batch.column("shared").offsets.to_numpy()
            begin = 0
            for block in _blocks(((r,) for r in unpacked(batch)), BUFFER):
                raws = [r for r, in block]
                end = begin + len(raws)
                of, start, count, h = window_runs(raws)
                h = h.view(np.int64)
                # An anchor that one text shares is shared by every text that has it.
                keep = np.isin(h, anchors[upto[begin]:upto[end]])
                of, start, count, h = of[keep], start[keep], count[keep], h[keep]
                body = [raws[i][s:e] for i, s, e in zip(of.tolist(), start.tolist(), (start + count + LENGTH - 1).tolist())]
                held.append((h, body, ids[begin:end][of], names[begin:end][of], start))
                if len(held) == BLOCKS:
                    yield told(held)
                    held = []
                begin = end
        if held:
            yield told(held)
            give_back()

    return docs.mapInArrow(run, _STRINGS)


def grams(text: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """A number of 16 bits for the bytes from every position on (the text is a circle), in
    their order, and how many bytes: as many as have no more different strings than that and
    can be counted in a table not much longer than the text."""
    used = np.zeros(256, bool)
    used[text] = True
    code = (np.cumsum(used, dtype=np.int32) - 1)[text]
    letters = size = int(used.sum())
    longer, width = code, 1
    while width < depth and size * letters <= max(1 << 18, 4 * len(text)):
        seen = np.zeros(size * letters, bool)
        following = longer * np.int32(letters) + np.roll(code, -width)
        seen[following] = True
        size = int(np.count_nonzero(seen))
        if size > 1 << 16:
            break
        longer, width = (np.cumsum(seen, dtype=np.int32) - 1)[following], width + 1
    return longer.astype(np.uint16), width


class Transform:
    """Burrows-Wheeler transform of a text: ``suffix`` lists the places of the text in order."""

    def __init__(self, text: np.ndarray, suffix: np.ndarray):
        self.text, self.suffix = text, suffix


def interleave(text: np.ndarray, suffix: np.ndarray, depth: int) -> np.ndarray:
    """Refine an order of suffixes until it is right to ``depth`` bytes: each pass steps a few
    bytes back from every suffix in the present order and distributes stably by them.
    ``suffix`` is the order to begin with. ``before`` holds for each of its places the bytes
    before that suffix, and ``step`` the place of the suffix that begins there."""
    n = len(text)
    gram, width = grams(text, depth)
    rank = np.empty(n, np.intp)  # indices of numpy's own width are not converted on use
    rank[suffix] = np.arange(n)
    back = suffix - width
    np.add(back, n, out=back, where=back < 0)
    before, step = gram[back], rank[back]
    order = np.arange(n)
    for _ in range(-(-depth // width)):
        dealt = before.take(order).argsort(kind="stable")
        following = step.take(order.take(dealt))
        if np.array_equal(following, order):
            break
        order = following
    return suffix[order]


def transform(text: np.ndarray, depth: int) -> Transform:
    """The transform of one shard, from the order of the text itself."""
    return Transform(text, interleave(text, np.arange(len(text)), depth))


def merge(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards' texts one after the other, and all their suffixes in merged order."""
    offsets = np.cumsum([0, *(len(s.text) for s in shards)])[:-1]
    text = np.concatenate([s.text for s in shards])
    suffix = np.concatenate([s.suffix + o for s, o in zip(shards, offsets)])
    return text, interleave(text, suffix, depth) if len(shards) > 1 else suffix


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` agree in their first ``length`` (8 or more)
    bytes; both must have that many."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(text)]
    words = np.ascontiguousarray(words).view("<u8").ravel()
    same = np.ones(len(a), bool)
    for i in [*range(0, length - 8, 8), length - 8]:
        same &= words[a + i] == words[b + i]
    return same


def merges(bodies: list[bytes], anchors: list[int], shard: int) -> Iterator[list[list[bytes]]]:
    """A bucket's strings, those of an anchor side by side, as shards of about ``shard`` bytes, in
    groups that have to be merged: an anchor is cut only if it does not fit one shard. Shards of
    different groups share no anchor and so no window."""
    group, size = [], 0
    for _, run in itertools.groupby(range(len(bodies)), key=anchors.__getitem__):
        own = [bodies[i] for i in run]
        total = sum(map(len, own)) + len(own)
        if group and (len(group) > 1 or size + total > shard):
            yield group
            group = []
        if group:
            group[0].extend(own)
            size += total
            continue
        group, size = [[]], 0
        for body in own:
            if size + len(body) + 1 > shard and group[-1]:
                group.append([])
                size = 0
            group[-1].append(body)
            size += len(body) + 1
    if group:
        yield group


def repeats(bodies: list[bytes], docs: np.ndarray, anchors: list[int], shard: int = SHARD,
            length: int = LENGTH) -> dict[int, list[int]]:
    """For strings of a bucket with their smallest doc_ids and anchors: the windows of each that
    also start in a string of smaller doc_id, as flat lists of (first, one past last). Strings
    without a partner get no place in the order."""
    out, done = {}, 0
    likely = [np.zeros(0, bool)] + [partners(group, length) for group in merges(bodies, anchors, shard)]
    kept = np.flatnonzero(np.concatenate(likely)).tolist()
    for group in merges([bodies[i] for i in kept], [anchors[i] for i in kept], shard):
        n = sum(map(len, group))
        found = merged_repeats(group, docs[kept[done:done + n]], length)
        out.update({kept[done + i]: windows for i, windows in found.items()})
        done += n
    return out


def partners(shards: list[list[bytes]], length: int) -> np.ndarray:
    """For each string of a group whether one of its windows may occur elsewhere in the group:
    false only if the hashes of all its windows are met once."""
    end = bytes([END])
    bodies = [body for s in shards for body in s]
    text = np.frombuffer(end.join(bodies) + end, np.uint8)
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    gram = 1 << (length.bit_length() - 1)
    if len(text) < length:
        return np.zeros(len(bodies), bool)
    h = gram_hashes(text, gram)
    # A window starts at most ``length`` bytes before the mark that ends its string.
    of = np.repeat(np.arange(len(bodies)), sizes)[:len(text) - length + 1]
    at = np.flatnonzero(np.arange(len(of)) + length < np.cumsum(sizes)[of])
    window = h[at] * np.uint64(_BASE) + h[at + length - gram]
    order = window.argsort()
    same = window[order[1:]] == window[order[:-1]]
    out = np.zeros(len(bodies), bool)
    out[of[at[order[1:][same]]]] = True
    out[of[at[order[:-1][same]]]] = True
    return out


def merged_repeats(shards: list[list[bytes]], docs: np.ndarray, length: int) -> dict[int, list[int]]:
    end = bytes([END])
    parts = [transform(np.frombuffer(end.join(s) + end, np.uint8), length) for s in shards]
    text, suffix = merge(parts, length)
    bodies = [body for s in shards for body in s]
    sizes = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    of = np.repeat(np.arange(len(bodies)), sizes + 1)
    window = suffix[suffix + length <= (begin + sizes)[of[suffix]]]
    new = np.ones(len(window), bool)
    new[1:] = ~common_prefix(text, window[:-1], window[1:], length)
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[of[window]], starts)
    gone = np.zeros(len(text) + 1, bool)
    gone[window] = least[np.cumsum(new) - 1] < docs[of[window]]
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0))
    out: dict[int, list[int]] = {}
    for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        i = int(of[a])
        out.setdefault(i, []).extend((a - int(begin[i]), b - int(begin[i])))
    return out


_MOVED = ["h", "s", "x", "lo", "n"]


def combined(rows: pa.Table) -> pa.Table:
    """Rows (h, s, x, lo, n) sorted by h, those of equal strings as one."""
    rows = pa.table({c: rows.column(c) for c in _MOVED}).combine_chunks()
    x = rows.column("x").to_numpy()
    order = x.argsort()
    same = x[order[1:]] == x[order[:-1]]
    again = np.zeros(len(x), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    if again.any():
        one = rows.filter(pa.array(again)).group_by(["h", "s"], use_threads=False).aggregate([("x", "min"), ("lo", "min"), ("n", "sum")])
        one = one.rename_columns({"x_min": "x", "lo_min": "lo", "n_sum": "n"}).select(rows.column_names)
        rows = pa.concat_tables([rows.filter(pa.array(~again)), one])
        rows = rows.take(pa.array(rows.column("h").to_numpy().argsort(kind="stable"))).combine_chunks()
    return rows


def bucket_repeats(some: DataFrame, buckets: int, shard: int) -> DataFrame:
    """(h, x, lo, windows) of the strings (h, s, x, lo, n), equal ones in one or several rows, that
    occur more than once or hold removed windows. A string that is alone at its anchor has no
    window in common with another and needs no place in the order."""
    def found_in(held):
        rows = combined(pa.Table.from_batches(held))
        h, lo, n = (rows.column(c).to_numpy() for c in ("h", "lo", "n"))
        start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        size = np.diff(np.append(start, len(h)))
        shared = np.flatnonzero(np.repeat(size, size) > 1)
        windows = repeats(rows.column("s").take(pa.array(shared)).to_pylist(), lo[shared], h[shared].tolist(), shard)
        keep = n > 1
        keep[shared[list(windows)]] = True
        by_row = {at: windows[i] for i, at in zip(windows, shared[list(windows)].tolist())}
        at = np.flatnonzero(keep)
        out = rows.select(["h", "x", "lo"]).take(pa.array(at))
        out = out.append_column("windows", pa.array([by_row.get(i) for i in at.tolist()], pa.list_(pa.int32())))
        return out.combine_chunks().to_batches()

    def run(batches):
        held, present = [], None  # what has come of the present bucket
        waiting, most = 0, WAITING  # its rows, and how many may wait until equal strings become one
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            batch = pa.RecordBatch.from_arrays([batch.column(c) for c in _MOVED], names=_MOVED)
            edges = [*np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist(), len(bucket)] if len(bucket) else []
            for a, b in itertools.pairwise(edges):
                if held and bucket[a] != present:
                    yield from found_in(held)
                    held, waiting, most = [], 0, WAITING
                present = bucket[a]
                held.append(batch.slice(a, b - a))
                waiting += b - a
                if waiting > most:
                    held = combined(pa.Table.from_batches(held)).to_batches()
                    waiting = sum(x.num_rows for x in held)
                    most = 2 * waiting + WAITING
        if held:
            yield from found_in(held)
        give_back()

    # xxhash64 of h is unlike h itself, of which anchors are the smallest values.
    bucket = F.pmod(F.xxhash64("h"), F.lit(buckets))
    dealt = some.select("h", "s", "lo", "n").repartition(bucket).select(
        bucket.alias("bucket"), "h", "s", F.xxhash64("s").alias("x"), "lo", "n").sortWithinPartitions("bucket", "h")
    return dealt.mapInArrow(run, "h long, x long, lo long, windows array<int>")


def crowded_anchors(rows: DataFrame, strings_per_anchor: int) -> DataFrame:
    """Anchors h with more strings, or more bytes of them, than one task should order."""
    held = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    return held.where((F.col("n") > strings_per_anchor) | (F.col("size") > STRING_BYTES * strings_per_anchor)).select("h")


def window_repeats(distinct: DataFrame) -> DataFrame:
    """What ``bucket_repeats`` gives, by one row per window of 50 bytes instead of an order:
    no string meets the others of its anchor in a task."""
    def run(batches):
        for batch in batches:
            for h, s, x, lo in zip(*(batch.column(c).to_pylist() for c in ("h", "s", "x", "lo"))):
                for a in range(0, len(s) - LENGTH + 1, 10_000):
                    at = range(a, min(a + 10_000, len(s) - LENGTH + 1))
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s[k:k + LENGTH] for k in at], pa.binary()), pa.array([h] * n, pa.int64()),
                         pa.array([x] * n, pa.int64()), pa.array([lo] * n, pa.int64()), pa.array(at, pa.int32())],
                        names=["w", "h", "x", "lo", "k"])

    cut = distinct.select("h", "s", "x", "lo").mapInArrow(run, "w binary, h long, x long, lo long, k int")
    least = (cut.groupBy("w").agg(F.min("lo").alias("least"), F.max("lo").alias("most"))
             .where("least < most").select("w", "least"))
    gone = cut.join(least, "w").where("least < lo").groupBy("h", "x").agg(F.collect_list("k").alias("ks"))
    pairs = F.flatten(F.transform(F.array_sort("ks"), lambda k: F.array(k, k + F.lit(1))))
    return (distinct.join(gone.select("h", "x", pairs.alias("windows")), ["h", "x"], "left")
            .where("n > 1 or windows is not null").select("h", "x", "lo", "windows"))


def union(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans [first, last), as many as there are gaps."""
    order = first.argsort()
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.flatnonzero(np.append(True, first[1:] > last[:-1]))
    return list(zip(first[new].tolist(), last[np.append(new[1:], len(first)) - 1].tolist()))


def remove(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the union of ``spans``, and how many maximal runs that union has."""
    left, at, runs, last = [], 0, 0, None
    for s, e in sorted(spans):
        if last is None or s > last:
            left.append(raw[at:s])
            runs += 1
            last = at = e
        elif e > last:
            last = at = e
    return b"".join([*left, raw[at:]]), runs


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def deduplicate(docs: DataFrame, scratch: Scratch, *, shard: int = SHARD,
                strings_per_bucket: int = STRINGS_PER_BUCKET,
                strings_per_anchor: int = STRINGS_PER_ANCHOR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): what was removed, and what is left."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("dg"))
    keyed = keyed.withColumn("t", F.xxhash64("dg"))
    named = keyed.where("doc_id is not null")

    firsts = scratch.put(named.groupBy("dg", "t").agg(F.min("doc_id").alias("first")), "firsts")
    wanted = shared_anchors(named).groupBy("t").agg(F.collect_set("h").alias("shared"))
    # Written before the texts are moved, so that the shuffle of all anchors is gone by then.
    owners = scratch.put(wanted.join(firsts, "t").select(F.col("first").alias("doc_id"), "t", "shared"), "owners")
    del wanted
    scratch.release()
    moved = packed(named.select("doc_id", "t", "text")).join(owners, ["doc_id", "t"])
    rows = strings(moved.select("doc_id", "t", "shared", "n_bytes", "z"))
    rows = rows.withColumn("x", F.xxhash64("s")).withColumn("size", F.octet_length("s"))
    rows = scratch.put(rows.withColumn("s", F.when(F.col("n") > 0, F.col("s"))), "strings", "zstd")
    del owners, moved
    scratch.drop("owners")
    scratch.release()

    buckets = max(1, rows.count() // strings_per_bucket)
    crowded = scratch.put(crowded_anchors(rows, strings_per_anchor), "anchors")
    firsts_of = rows.where("n > 0").select("h", "s", "x", "lo", "n")
    if crowded.isEmpty():
        found = bucket_repeats(firsts_of, buckets, shard)
    else:
        many = firsts_of.join(crowded, "h", "left_semi").groupBy("h", "s").agg(
            F.min("lo").alias("lo"), F.first("x").alias("x"), F.sum("n").alias("n"))
        found = bucket_repeats(firsts_of.join(crowded, "h", "left_anti"), buckets, shard).union(
            window_repeats(scratch.put(many, "crowded")))
    verdict = scratch.put(found, "windows")
    del found
    scratch.release()

    # The holder of a string loses the windows found; any larger doc_id loses all of them.
    whole = F.array(F.lit(0), F.col("size") - F.lit(LENGTH - 1))
    hit = rows.drop("s", "lo", "n").join(verdict, ["h", "x"]).withColumn(
        "windows", F.when(F.col("doc_id") > F.col("lo"), whole).otherwise(F.col("windows"))).where("windows is not null")
    placed = F.transform("windows", lambda w: w + F.col("pos"))
    spans = hit.groupBy("doc_id", "t").agg(F.flatten(F.collect_list(placed)).alias("cut"))
    info = scratch.put(
        named.select("doc_id", "dg", "t").distinct().join(firsts.select("dg", "first"), "dg")
        .join(spans, ["doc_id", "t"], "left")
        .select("doc_id", "t", (F.col("doc_id") > F.col("first")).alias("copy"), "cut")
        .where("copy or cut is not null"), "info")
    scratch.clear("info")
    scratch.release()

    def run(batches):
        for batch in slices(batches):
            cols: list[list] = [[] for _ in range(6)]
            cuts, upto = batch.column("cut").values.to_numpy(), batch.column("cut").offsets.to_pylist()
            for doc_id, copy, raw, (a, b) in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copy")),
                                                 unpacked(batch), itertools.pairwise(upto)):
                ranges = union(cuts[a:b:2], cuts[a + 1:b:2] + (LENGTH - 1)) if b > a else []
                if copy and len(raw) >= LENGTH:
                    ranges = [(0, len(raw))]
                rest, runs = remove(raw, ranges)
                values = (doc_id, len(raw), len(raw) - len(rest), runs, hashlib.sha256(rest).hexdigest(), rest)
                for col, v in zip(cols, values):
                    col.append(v)
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=[f.split(" ")[0] for f in RESULT.split(", ")])

    moved = packed(keyed.select("doc_id", "t", "text")).join(info, ["doc_id", "t"], "left")
    return moved.select("doc_id", "n_bytes", "z", "copy", "cut").mapInArrow(run, RESULT)
