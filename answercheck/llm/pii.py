"""Personal data: validated base kinds plus boosted-tree candidates.

Base kinds (email, ip, card, phone) are fixed patterns with validity tests, leftmost and
non-overlapping per kind; they are always kept. Beyond them, high-recall generators
propose spans that may overlap, of any length: numbers in groups, long mixed tokens, the
value assigned to a secret's name (also a short one or one without a digit), anything
around an at sign or its written-out forms. Gradient-boosted trees score each candidate by its
format and its context; a threshold calibrated on held-out rows selects which ones are
added. Kinds added: ``number`` (a national phone or identity number), ``secret`` (a key or
token) and ``contact`` (an address the base pattern does not cover).

Training: labels come from rules of high precision, as no labelled spans exist. Positive
are candidates that coincide with a validated base span, and tokens assigned to a secret's
name; negative are candidates that fail a checksum or range test and long tokens in plain
prose. Features leave out the very tests that made the labels. Every labelled candidate of
all documents takes part, those of equal surroundings once: two thirds fit the trees (Spark
ML, distributed), one third calibrates the threshold to ``precision``. They lie in a written
table; the driver gets the trees and a count per threshold. Without both labels no span is
added.

Scoring is one pass without a shuffle: the trees (a few hundred numbers) are sent to all
tasks.

Defined cases: a null text is empty and has no spans; whole texts are searched, in time
linear in their length; rows are judged each on its own, so nulls, ties and repeated rows
need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("number", "secret", "contact")
KINDS = BASE_KINDS + ADDED_KINDS

PRECISION = 0.98
THRESHOLDS = np.arange(0.5, 1.0, 0.01)

Span = tuple[int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits can only begin a match at its first digit; possessive repeats never give back.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NAMES = r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)"
# Every name of a secret holds one of these.
_STEMS = ("token", "secret", "passw", "key")
_ANY = re.compile(r"[0-9@]|\(at\)|\[at\]", re.I)


def emails(text: str) -> Iterator[Span]:
    """Matches of local@domain: a match can only start in the run before an at sign."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    total = sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        out += [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *s) for s in ips(text)]
        out += [("card", *s) for s in cards(text)]
    if "+" in text:
        out += [("phone", *s) for s in phones(text)]
    return out


# --- candidates ----------------------------------------------------------------------

_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])++(?![0-9A-Za-z])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{16,}+")
_CONTACT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:@|\(at\)|\[at\])\s?[A-Za-z0-9.()\[\]-]{2,}+", re.I)
_SECRET_NAME = re.compile(_NAMES + r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?\Z", re.I)
# A quoted value goes to its quote, another to white space.
_ASSIGNED = re.compile(_NAMES + r"[\"']?\s{0,3}[:=]\s{0,3}(?:\"([^\"\n]++)|'([^'\n]++)|([^\s\"']++))", re.I)
_CUES = re.compile(r"tel|phone|call|fax|mobile|card|account|ssn|iban|id|key|token|secret|password|mail|contact", re.I)

CONTEXT = 24
FEATURES = ("length", "digits", "letters", "capitals", "spaces", "dots", "dashes", "brackets", "groups",
            "longest_group", "shortest_group", "distinct", "entropy", "hex_share", "switches", "plus", "at",
            "cue_before", "assigned", "quoted", "prose_before", "digits_around", "is_number", "is_token")


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping (kind, start, end) proposals."""
    lower = text.lower()
    named = any(s in lower for s in _STEMS)
    if not named and not _ANY.search(text):
        return []
    out = [("number", *m.span()) for m in _NUMBER.finditer(text) if m.end() - m.start() >= 7]
    secrets = {m.span(): None for m in _TOKEN.finditer(text) if _DIGIT.search(m[0])}
    if named:
        secrets |= {m.span(m.lastindex): None for m in _ASSIGNED.finditer(text)}
    out += [("secret", *s) for s in secrets]
    out += [("contact", *m.span()) for m in _CONTACT.finditer(text)]
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span, before, after = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    groups = re.findall(r"[0-9]+", span) or [""]
    digits = sum(map(len, groups))
    letters = sum(c.isalpha() for c in span)
    n = len(span)
    shares = [span.count(c) / n for c in set(span)]
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    return [float(x) for x in (
        n, digits, letters, sum(c.isupper() for c in span), span.count(" "), span.count("."), span.count("-"),
        sum(span.count(c) for c in "()[]"), len(groups), max(map(len, groups)), min(map(len, groups)), len(shares),
        -sum(p * math.log2(p) for p in shares), sum(c in "0123456789abcdefABCDEF" for c in span) / n, switches,
        span.startswith("+"), "@" in span, bool(_CUES.search(before)), bool(re.search(r"[:=]\s{0,3}[\"']?\Z", before)),
        before[-1:] in "\"'" and after[:1] in "\"'" and before != "", sum(c.isalpha() for c in before),
        sum(c.isdigit() for c in before + after), kind == "number", kind == "secret")]


def weak_label(text: str, kind: str, start: int, end: int, base: list[tuple[str, int, int]]) -> int | None:
    """1 by a validated base span or an assigned secret, 0 by a failed test, else None."""
    overlaps = [(k, s, e) for k, s, e in base if s < end and start < e]
    if overlaps:
        inside = sum(min(e, end) - max(s, start) for k, s, e in overlaps)
        return 1 if inside >= 0.8 * (end - start) else None
    before = text[max(0, start - CONTEXT):start]
    if kind == "secret":
        if _SECRET_NAME.search(before):
            return 1
        return 0 if before[-1:].isspace() and not _CUES.search(before) else None
    if kind == "number":
        d = _digits(text[start:end])
        return 0 if len(d) < 7 or 13 <= len(d) <= 19 or text.count(".", start, end) >= 2 else None
    return None


# --- trees ---------------------------------------------------------------------------

class Trees:
    """Boosted regression trees as flat arrays, scored by numpy; a margin of all trees is
    turned into a probability."""

    def __init__(self, trees: list[tuple[list, float]], threshold: float):
        self.trees, self.threshold = trees, threshold

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for nodes, weight in self.trees:
            feature, cut, left, right, value = (np.array(c) for c in zip(*nodes))
            at = np.zeros(len(x), np.int64)
            while (inner := left[at] >= 0).any():
                go_left = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def _flat(node) -> list[tuple]:
    """(feature, threshold, left, right, value) of every node of a fitted Spark ML tree."""
    out: list = []

    def walk(n) -> int:
        at = len(out)
        out.append(None)
        if n.subtreeDepth() == 0:
            out[at] = (-1, 0.0, -1, -1, n.prediction())
        else:
            split = n.split()
            out[at] = (split.featureIndex(), split.threshold(), walk(n.leftChild()), walk(n.rightChild()), 0.0)
        return at

    walk(node)
    return out


def labelled(docs: DataFrame) -> DataFrame:
    """All labelled candidates (y, x, h), those of one label and equal surroundings once."""
    def run(batches):
        for batch in batches:
            rows = []
            for text in texts(batch.column("text")):
                found = candidates(text)
                base = base_spans(text) if found else []
                for kind, s, e in found:
                    y = weak_label(text, kind, s, e, base)
                    if y is not None:
                        rows.append((y, features(text, kind, s, e), text[max(0, s - CONTEXT):e + CONTEXT]))
            if rows:
                y, x, near = zip(*rows)
                order = [int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(),
                                        "little", signed=True) for t in near]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y, pa.int32()), pa.array(x, pa.list_(pa.float64())), pa.array(order, pa.int64())],
                    names=["y", "x", "h"])

    rows = docs.select("text").mapInArrow(run, "y int, x array<double>, h long")
    # Copies of a passage would outweigh the rest: a hash counts once.
    return rows.groupBy("h", "y").agg(F.max("x").alias("x"))


def train(docs: DataFrame, *, precision: float = PRECISION) -> Trees:
    """Fit on all weakly labelled candidates of ``docs`` (text) and calibrate."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    scratch = Scratch(docs.sparkSession, "pii")
    try:
        rows = scratch.put(labelled(docs).orderBy("h", "y"), "labelled").withColumn(
            "held", F.pmod("h", F.lit(3)) == 0)
        counts = {(r["held"], r["y"]): r["count"] for r in rows.groupBy("held", "y").count().collect()}
        if len(counts) < 4:
            return Trees([], 2.0)
        n = counts[False, 0] + counts[False, 1]
        # Spark ML looks for a feature's cuts in max(10,000, bins squared) rows: in all, here.
        bins = 32 if n <= 10_000 else math.isqrt(n) + 1
        frame = rows.where("not held").select(F.col("y").cast("double").alias("label"), array_to_vector("x").alias("features"))
        model = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, maxBins=bins, seed=7, checkpointInterval=-1).fit(frame)
        trees = Trees([(_flat(t._call_java("rootNode")), w) for t, w in zip(model.trees, model.treeWeights)], 2.0)
        trees.threshold = calibrated(rows.where("held"), trees, precision)
        return trees
    finally:
        scratch.clear()


def calibrated(held: DataFrame, trees: Trees, precision: float) -> float:
    """The least threshold whose choice of all held-out rows (y, x) has the precision asked
    for; 2, which nothing reaches, if none has."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                passed = np.searchsorted(THRESHOLDS, trees.probability(x), side="right")
                y = batch.column("y").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y, pa.int32()), pa.array(passed, pa.int64())], names=["y", "passed"])

    found = held.select("y", "x").mapInArrow(run, "y int, passed long").groupBy("y", "passed").count().collect()
    chosen = np.zeros((2, len(THRESHOLDS)), np.int64)
    for r in found:
        chosen[r["y"], :r["passed"]] += r["count"]
    for threshold, wrong, right in zip(THRESHOLDS, *chosen):
        if right and right / (wrong + right) >= precision:
            return float(threshold)
    return 2.0


# --- detection -----------------------------------------------------------------------

def added_spans(rows: list[tuple[str, list[tuple[str, int, int]]]], trees: Trees) -> list[list[tuple[str, int, int]]]:
    """Per (text, base spans): candidates over the threshold that touch no base span; of
    overlapping ones the highest score wins, then the longest, then the leftmost."""
    if not trees.trees:
        return [[] for _ in rows]
    found, x = [], []
    for i, (text, base) in enumerate(rows):
        for kind, s, e in candidates(text):
            if not any(bs < e and s < be for _, bs, be in base):
                found.append((i, kind, s, e))
                x.append(features(text, kind, s, e))
    out: list[list[tuple[str, int, int]]] = [[] for _ in rows]
    if found:
        p = trees.probability(np.array(x))
        order = sorted(range(len(found)), key=lambda j: (-p[j], found[j][2] - found[j][3], found[j][2]))
        for j in order:
            i, kind, s, e = found[j]
            if p[j] >= trees.threshold and not any(a < e and s < b for _, a, b in out[i]):
                out[i].append((kind, s, e))
    return [sorted(spans, key=lambda t: (KINDS.index(t[0]), t[1])) for spans in out]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Spans replaced by their kind in brackets; overlapping spans as one, by the first's kind."""
    out, at = [], 0
    merged: list[list] = []
    for kind, s, e in sorted(spans, key=lambda t: (t[1], -t[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"


def detect(docs: DataFrame, carry: list[str], trees: Trees) -> DataFrame:
    """``carry`` columns of each row of ``docs`` (text) with the counts of base spans, their
    digest, all spans, and the text with all spans replaced (null for a null text). A
    carried column that clashes with a result column is dropped."""
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    carry = [c for c in carry if c not in names and c != "_text"]
    kept = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"))
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), RESULT])
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in slices(batches):
            source = batch.column("_text").to_pylist()
            rows = [(t or "", base_spans(t or "")) for t in source]
            more = added_spans(rows, sent.value)
            cols: list[list] = [[] for _ in names]
            for original, (text, base), extra in zip(source, rows, more):
                kinds = [k for k, _, _ in base]
                values = [*(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(),
                          _joined(base + extra), None if original is None else redacted(text, base + extra)]
                for col, v in zip(cols, values):
                    col.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=[*carry, *names])

    return kept.mapInArrow(run, ddl)
