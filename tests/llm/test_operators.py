"""The operators against brute-force versions, and their defined edge cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from answercheck.llm import (bwt, chunks, embeddings, licenses, minhash, packing, pieces, pii, quality, queries, warc)
from answercheck.llm.common import Scratch, components, union_find

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def given(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def prose(n, seed, words=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(words)]
    return [r.choice(vocabulary) for _ in range(n)]


LONG = " ".join(prose(20_000, 99))
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two three four five six"),
         (6, LONG), (7, LONG), (8, "ä" * 300), (9, "été " * 40)]


# --- components ------------------------------------------------------------------------

def test_components_of_chains_hubs_and_pairs(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 130)] + [(500, i) for i in range(501, 560)] + [
        (r.randint(1000, 1100), r.randint(1000, 1100)) for _ in range(70)]
    got = {x["node"]: x["component"] for x in components(
        frame(spark, edges, "a long, b long"), Scratch(spark, "t")).collect()}
    want = union_find([(a, b) for a, b in edges if a != b])
    assert got == want


# --- 1 ---------------------------------------------------------------------------------

def links_by_force(rows, threshold=0.93):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        fine = i is not None and label is not None and v and all(
            x is not None and math.isfinite(x) for x in v) and any(v)
        if fine:
            u = np.array(v, np.float32).astype(np.float64)
            ok[k] = u / np.sqrt((u * u).sum())
    n = [0] * len(rows)
    pairs = []
    for a, b in itertools.combinations(ok, 2):
        if rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold:
            n[a] += 1
            n[b] += 1
            pairs.append((rows[a][0], rows[b][0]))
    comp = union_find([p for p in pairs if p[0] != p[1]])
    return sorted((i is None, i or 0, n[k], comp.get(i, i)) for k, (i, _, _) in enumerate(rows))


def vectors_near(seed, n, dim, groups, noise):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim))
    return [(centres[k % groups] + noise * r.normal(size=dim)).astype(np.float32).tolist() for k in range(n)]


@pytest.mark.parametrize("noise", [0.15, 0.25, 0.35])
def test_embeddings_equal_brute_force(spark, noise):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors_near(5, 240, 16, 12, noise))]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 3)]   # copies
    rows += [(2000, [x * 7 for x in rows[3][1]], rows[3][2])]              # scaled: cosine 1
    df = frame(spark, rows, "vec_id long, embedding array<float>, label int")
    out = embeddings.near_duplicates(df, Scratch(spark, "t"), block=16, leaf=4).collect()
    assert sorted((x["vec_id"] is None, x["vec_id"] or 0, x["n_links"], x["component_id"]) for x in out) == links_by_force(rows)
    assert any(x["n_links"] for x in out)
    assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in out)


def test_embeddings_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, v, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 3.0], 0),
            (8, [1.0, float("nan"), 3.0], 0), (9, [1.0, float("inf"), 0.0], 0), (None, v, 0), (10, [1.0, 2.0], 0),
            (11, [2.0, 4.0], 0), (12, v, 1)]
    df = frame(spark, [(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links string")
    out = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"])
           for x in embeddings.near_duplicates(df, Scratch(spark, "t")).collect()}
    assert out[1] == (1, 1, True) and out[2] == (1, 1, False) and out[11] == (1, 10, False)
    assert all(out[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12)) and out[None] == (0, None, True)
    assert embeddings.near_duplicates(df.limit(0), Scratch(spark, "t")).count() == 0


# --- 2 ---------------------------------------------------------------------------------

def classes_by_force(rows):
    bags = {i: minhash.bag(t or "") for i, t in rows if i is not None}
    pairs = [(a, b) for a, b in itertools.combinations(sorted(bags), 2)
             if minhash.weighted_jaccard(bags[a], bags[b]) >= 0.8]
    return union_find(pairs)


def edited(words, share, seed):
    r = random.Random(seed)
    return [r.choice(["new", "other", "word", "x"]) + str(seed) if r.random() < share else w for w in words]


def test_minhash_near_copies_and_large_groups(spark):
    rows = [(i, " ".join(prose(120, i))) for i in range(40)]
    rows += [(100 + i, " ".join(edited(prose(300, 7), 0.012, i))) for i in range(60)]   # a group, some links missing
    rows += [(300 + i, " ".join(edited(prose(150, 11), 0.004 * i, i))) for i in range(20)]
    passage = prose(80, 1234)
    rows += [(400 + i, " ".join(prose(60, 500 + i) + passage)) for i in range(40)]      # shared passage, no copies
    rows += [(900 + i, rows[0][1]) for i in range(30)]
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(
        frame(spark, rows), Scratch(spark, "t"), small_bucket=4).collect()}
    want = classes_by_force(rows)
    assert got == {i: want.get(i, i) for i, _ in rows}
    assert len({got[i] for i in range(400, 440)}) == 40


def test_minhash_agreement_estimates_weighted_jaccard():
    r = np.random.default_rng(0)
    a = r.integers(1, 2 ** 62, 300).astype(np.uint64)
    ca, cb = r.integers(0, 9, 300), r.integers(0, 9, 300)
    owner = np.concatenate([np.zeros(300, np.int64), np.ones(300, np.int64)])
    sig = minhash.bag_minhash(owner, np.concatenate([a, a]), np.concatenate([ca, cb]), 2, 4096)
    want = np.minimum(ca, cb).sum() / np.maximum(ca, cb).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * math.sqrt(want * (1 - want) / 4096)


def test_minhash_edges(spark):
    df = frame(spark, EDGES).withColumn("component_id", F.lit("x")).withColumn("kept", F.lit(0))
    out = sorted((x["doc_id"] or 0, x["component_id"], x["kept"]) for x in minhash.near_duplicates(df, Scratch(spark, "t")).collect())
    assert out == [(0, None, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (5, 4, False),
                   (6, 6, True), (7, 6, False), (8, 8, True), (9, 9, True)]
    assert minhash.near_duplicates(df.limit(0), Scratch(spark, "t")).count() == 0
    kept = minhash.keep_one(df.union(df.where("doc_id = 4")), Scratch(spark, "t"))
    assert sorted(x["doc_id"] or 0 for x in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 9] and kept.columns == df.columns


# --- 3 ---------------------------------------------------------------------------------

def removal_by_force(rows, length=50):
    seen: dict[bytes, int] = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        if i is not None:
            for k in range(len(raw) - length + 1):
                w = raw[k:k + length]
                seen[w] = min(seen.get(w, i), i)
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            if i is not None and seen[raw[k:k + length]] < i:
                gone[k:k + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out.append((i or 0, len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(spark, df, **parameters):
    out = bwt.deduplicate(df, Scratch(spark, "t"), **parameters).collect()
    return sorted((x["doc_id"] or 0, x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in out)


def test_bwt_equals_brute_force(spark):
    passage = " ".join(prose(60, 77))
    rows = [(i, " ".join(prose(60, i % 9))) for i in range(0, 40, 2)]
    rows += [(101 + i, " ".join(prose(20, 200 + i)) + " " + passage[i:] + " é" + passage[:90 + i]) for i in range(25)]
    rows += [(200, "ab" * 400), (199, "ab" * 300), (201, "x" + "ab" * 30), (3, passage), (300, "a" * 49), (301, "a" * 50), (302, "a" * 70)]
    assert removed(spark, frame(spark, rows), shard=512, strings_per_bucket=64) == removal_by_force(rows)


def test_bwt_edges(spark):
    rows = [*EDGES[:7], (6, LONG[:30_000]), (7, LONG[:30_000]), *EDGES[9:]]
    df = frame(spark, rows).withColumn("t", F.lit("x")).withColumn("shared", F.lit(1)).withColumn("copy", F.lit(True))
    assert removed(spark, df) == removal_by_force(rows)
    assert removed(spark, df.limit(0)) == []


def test_merged_transforms_order_suffixes_to_depth():
    r = random.Random(5)
    bodies = [bytes(r.choice(b"ab") for _ in range(r.randint(50, 90))) for _ in range(40)]
    shards = [bwt.transform(np.frombuffer(b"\xff".join(bodies[i:i + 10]) + b"\xff", np.uint8), 50) for i in range(0, 40, 10)]
    text, order = bwt.merge(shards, 50)
    raw = text.tobytes()
    prefixes = [raw[i:i + 50].partition(b"\xff") for i in order]  # a string's end ends the comparison
    prefixes = [head + mark for head, mark, _ in prefixes]
    assert prefixes == sorted(prefixes) and sorted(order) == list(range(len(text)))


# --- 4 ---------------------------------------------------------------------------------

def test_licenses_equal_exact_containment(spark):
    index = licenses.Index(licenses.TEMPLATES)
    r, rows = random.Random(1), []
    for i in range(120):
        words = prose(r.randint(0, 300), i)
        for _ in range(r.randint(0, 2)):
            notice = r.choice(licenses.TEMPLATES)[1].split()
            if r.random() < 0.4:
                notice[r.randrange(len(notice))] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = notice
        rows.append((i, " ".join(words)))
    want = []
    for i, t in rows:
        s = licenses.shingles(t)
        hits = [h for k in range(len(licenses.TEMPLATES)) for h in index.verify(s, k)]
        want.append((i, len(hits), ",".join(sorted({licenses.TEMPLATES[h[0]][0] for h in hits}))))
    got = licenses.scan(frame(spark, rows), ["doc_id"]).collect()
    assert sorted((x["doc_id"], x["n_matches"], x["licenses"]) for x in got) == want
    assert sum(n for _, n, _ in want) > 50


def test_licenses_edges(spark):
    notice = "### Released under the MIT License. ###"
    df = frame(spark, [*EDGES, (20, notice), (21, LONG + " " + notice.upper())]).withColumn("matches", F.lit("x"))
    out = {x["doc_id"]: x["licenses"] for x in licenses.scan(df, ["doc_id", "matches"]).collect()}
    assert out[20] == out[21] == "mit" and all(not v for k, v in out.items() if k not in (20, 21))
    assert licenses.scan(df.limit(0), ["doc_id"]).count() == 0


# --- 5 ---------------------------------------------------------------------------------

def counts_by_force(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set()
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_quality_base_counts(spark):
    rows = [(x["doc_id"], x["text"], x["lang"]) for x in given(spark, "documents").collect()]
    rows += [(10_000 + (i or 0) + k, t, None) for k, (i, t) in enumerate(EDGES) if t is None or len(t) < 5000]
    rows += [(20_000, "a b c a b c\x0bd\x85e f\ng h\ng h\n \n \n", "xx"), (20_001, "a b a b a b", "en")]
    df = frame(spark, rows, "doc_id long, text string, lang string").withColumn("kept", F.lit("x"))
    got = {x["doc_id"]: x for x in quality.judge(df, ["doc_id", "kept"], Scratch(spark, "t")).collect()}
    for i, t, _ in rows:
        want = counts_by_force(t)
        x = got[i]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == want
        assert x["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (x["kept"] and x["base_failed"])


def js_by_force(p, q):
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    half = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0) / 2
    return math.sqrt(max(0.0, half(p) + half(q)))


def test_quality_distances(spark):
    df = frame(spark, [([1, 2, 3], [3, 2, 1]), ([5, 0], [0, 5]), ([0, 0], [1, 1])], "p array<long>, q array<long>")
    got = [x[0] for x in df.select(quality.js_distance(F.col("p"), F.col("q"))).collect()]
    assert got[0] == pytest.approx(js_by_force([1, 2, 3], [3, 2, 1])) and got[1] == pytest.approx(1.0) and got[2] is None


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs, ["doc_id"], Scratch(spark, "t")).join(labels, "doc_id").where("not base_failed").collect()
    clean, junk = [x["kept"] for x in rows if x["quality"] == 1], [x["kept"] for x in rows if x["quality"] == 0]
    assert all(clean) and sum(junk) <= 0.2 * len(junk)


def test_quality_edges(spark):
    df = frame(spark, [(i, t, None, "s", 1) for i, t in EDGES], DOCS)
    assert quality.judge(df, ["doc_id"], Scratch(spark, "t")).count() == len(EDGES)
    kept = quality.keep(df, Scratch(spark, "t"))
    assert kept.columns == df.columns and {x["doc_id"] for x in kept.collect()} >= {6, 7}
    assert quality.judge(df.limit(0), ["doc_id"], Scratch(spark, "t")).count() == 0


# --- 6 ---------------------------------------------------------------------------------

def test_warc_round_trip_and_revisits(spark):
    big, other = "x\r\n\r\nWARC/1.1\r\n" * 30, "é" * 60
    rows = [(5, "http://a/ b\r\nX: y", big), (2, None, big), (9, "u", big), (9, "u", big), (2, "u", big), (7, "u", other),
            (8, "u", other), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (10, "u", ""), (None, "u", big)]
    df = frame(spark, [(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    path = Scratch(spark, "t").root
    out = warc.deduplicate(df, "page_id", "url", "html", path).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    first = {big: 2, other: 7}
    want = sorted((i or 0, len((t or "").encode()), sha(t), "revisit" if t in first and (i or 0) > first[t] else "response",
                   first[t] if t in first and (i or 0) > first[t] else 0) for i, _, t in rows)
    assert sorted((x["record_id"] or 0, x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"] or 0)
                  for x in out) == want
    held = warc.read_archive(spark, f"{path}/deduplicated", with_payload=True)
    assert sum(x["payload"] == big for x in held.collect()) == 3  # page 2 twice, and the page without an id
    assert warc.deduplicate(df.limit(0), "page_id", "url", "html", Scratch(spark, "t").root).count() == 0


# --- 7 ---------------------------------------------------------------------------------

def base_by_force(text):
    import re
    def luhn(d):
        s = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (2 if k % 2 else 1)
            s += v - 9 if v > 9 else v
        return s % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    return [(k, *m.span()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def test_pii_base_equals_the_patterns(spark):
    r = random.Random(4)
    parts = ["a@b.c", "a@b", "@", "x.y@z.w.v", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "7",
             "4111111111111111", "+1 (743) 555-3824", "+", "+12", " ", "é", "-", "0001.2.3.4", "a@b.c@d.e", "+1 2 3 4 5 6 7 8 9"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 14))) for _ in range(4000)]
    texts += [x["text"] for x in given(spark, "documents").collect()]
    for t in texts:
        assert pii.base_spans(t) == base_by_force(t), t


def test_pii_is_linear_on_long_runs():
    for unit in ("1", "a", "1.", "+1", "a@", "@", "1 ", "(at)"):
        text = unit * 60_000
        pii.base_spans(text)
        pii.candidates(text)


def test_pii_trees_equal_the_fitted_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trees = pii.train(docs)
    assert trees.trees and 0.5 <= trees.threshold < 1
    out = pii.detect(docs, ["doc_id"], trees).collect()
    assert sum("secret:" in x["spans"] for x in out) > 0
    for x in out:
        base = [s for s in x["spans"].split(",") if s and s.split(":")[0] in pii.BASE_KINDS]
        assert x["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()


def test_pii_edges(spark):
    df = frame(spark, [*EDGES, (30, "mail a@b.cd now")]).withColumn("spans", F.lit(1))
    out = {x["doc_id"]: x for x in pii.detect(df, ["doc_id", "spans"], pii.train(df)).collect()}
    assert out[30]["redacted"] == "mail [EMAIL] now" and out[30]["spans"] == "email:5:11" and out[1]["redacted"] is None
    assert out[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and out[6]["redacted"] == LONG
    assert pii.detect(df.limit(0), ["doc_id"], pii.train(df.limit(0))).count() == 0


# --- 8 ---------------------------------------------------------------------------------

def best_fit_decreasing(lengths, size):
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(size - n)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_supersteps_equal_best_fit_decreasing(seed):
    r = random.Random(seed)
    size = r.choice([10, 37, 100])
    lengths = [min(size, 1 + int(r.expovariate(3 / size))) for _ in range(r.randint(1, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    slots = packing.supersteps(counts, size)
    held: dict[int, list[tuple[int, int]]] = {}
    for n, total in counts.items():
        own = sorted(s[1:] for s in slots if s[0] == n)
        assert own[0][0] == 0
        for (rank, seq, offset), nxt in itertools.zip_longest(own, own[1:], fillvalue=None):
            for k in range((nxt[0] if nxt else total) - rank):
                held.setdefault(seq + k, []).append((offset, n))
    gaps = []
    for spots in held.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= size
        gaps.append(size - at)
    assert sorted(gaps) == best_fit_decreasing(lengths, size)


def test_packing_pieces_and_layout(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_path())
    t.encode_special_tokens = True
    rows = [(x["doc_id"], x["text"]) for x in given(spark, "documents").collect()]
    rows += [(5000 + k, s) for k, s in enumerate(["  two  blanks \n x", " lead", "trail ", "  x", "a <|endoftext|> b", "a\n\nb c"])]
    rows += [(None, "x y"), (7000, None), (7001, ""), (7002, "same"), (7002, "same"), (7003, "é" * 5000)]
    df = frame(spark, rows).withColumn("part", F.lit("x")).withColumn("rank", F.lit("x"))
    out = packing.pack(df, Scratch(spark, "t")).collect()
    want = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want.append((i or 0, k, s, n, zlib.crc32(ids[s:s + n].tobytes())))
    assert sorted((x["doc_id"] or 0, x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in out) == sorted(want)
    held: dict[int, list] = {}
    for x in out:
        held.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for spots in held.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(held) == len(best_fit_decreasing([w[3] for w in want], 1024))
    assert packing.pack(df.limit(0), Scratch(spark, "t")).count() == 0


# --- 9 ---------------------------------------------------------------------------------

def viterbi_by_force(p, text, scores):
    """The best segmentation, piece by piece, over the whole text."""
    s = pieces.BLANK + text.replace(" ", pieces.BLANK)
    best, back = [0.0] + [-math.inf] * len(s), [None] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - p.longest), end):
            piece = s[start:end]
            if piece in scores and best[start] + scores[piece][1] > best[end]:
                best[end], back[end] = best[start] + scores[piece][1], (start, [scores[piece][0]])
        if s[end - 1] not in scores and best[end - 1] + p.unknown > best[end]:
            best[end], back[end] = best[end - 1] + p.unknown, (end - 1, [p.byte_ids[b] for b in s[end - 1].encode()])
    out, at = [], len(s)
    while at:
        at, ids = back[at]
        out = ids + out
    return out


def test_pieces_equal_brute_force_and_round_trip(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    p = pieces.loaded(pieces.model_path())
    scores = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(sp.vocab_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    texts = [x["text"][:1500] for x in given(spark, "documents").limit(60).collect()]
    texts += ["  two  blanks \n x", " lead", "trail ", "日本語 𝛀 ☃ x\x00y", "a", " ", "w" * 400, LONG[:3000]]
    found = [np.frombuffer(x, "<i4").tolist() for x in p.encode(texts)]
    assert found == [viterbi_by_force(p, t, scores) for t in texts]
    assert [p.decode(i) for i in found] == texts
    assert [sp.decode(i) for i in found[:40]] == texts[:40]


def test_pieces_edges(spark):
    df = frame(spark, EDGES).withColumn("ids", F.lit("x"))
    ids = pieces.encode(df, ["doc_id", "text", "ids"])
    back = pieces.decode(ids, ["doc_id", "text"], text="decoded").collect()
    assert len(back) == len(EDGES) and all(x["decoded"] == x["text"] for x in back)
    assert ids.where("doc_id = 2").first()["ids"] == [] and ids.where("doc_id = 1").first()["ids"] is None
    assert pieces.encode(df.limit(0), ["doc_id"]).count() == 0


# --- 10 --------------------------------------------------------------------------------

def chunks_by_force(rows, min_run=chunks.MIN_RUN):
    """The rule on the bytes themselves: (doc_id, number of bytes, SHA-256 of what is left)."""
    cut, lowest = [], {}
    for i, t in rows:
        raw = (t or "").encode()
        ends = chunks.cuts(np.frombuffer(raw, np.uint8)).tolist()
        runs = []
        for start in [0, *ends[:-1]]:
            end = next((e for e in ends if e >= start + min_run), None)
            if end:
                runs.append((start, end))
                if i is not None:
                    lowest[raw[start:end]] = min(i, lowest.get(raw[start:end], i))
        cut.append((i, raw, runs))
    out = []
    for i, raw, runs in cut:
        gone = np.zeros(len(raw), bool)
        for s, e in runs:
            gone[s:e] |= i is not None and lowest[raw[s:e]] < i
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i or 0, len(raw), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_every_removed_byte_is_held_by_one_earlier_document_and_passages_are_caught(spark):
    """Independent of chunks: every removed byte lies in 100 bytes that one document of smaller
    id holds as one stretch; and shared passages, prose or one word repeated, are removed."""
    passage = " ".join(prose(55, 4242))
    stutter = "again " * 60
    rows = [(50 + i, " ".join(prose(150, i))) for i in range(30)] + [
        (100 + i, " ".join(prose(90, 300 + i) + [passage] + prose(40 + i, 600 + i))) for i in range(40)] + [
        (200 + i, " ".join(prose(30 + i, 900 + i)) + " " + stutter + " ".join(prose(30, 950 + i))) for i in range(20)] + [
        *EDGES[:6], (6, LONG[:20_000]), (7, LONG[:20_000]), *EDGES[9:]]
    rows += [(r["doc_id"], r["text"]) for r in given(spark, "documents").select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text").collect()]
    df = frame(spark, rows).withColumn("n_spans", F.lit("x"))
    out = chunks.deduplicate(df, ["doc_id", "n_spans"]).collect()
    assert sorted((x["doc_id"] or 0, x["n_bytes"], x["kept_sha256"]) for x in out) == chunks_by_force(rows)
    # The smallest doc_id that holds each string of 100 bytes.
    lowest: dict[int, int] = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for at in range(len(raw) - 99):
            lowest.setdefault(hash(raw[at:at + 100]), i)
    texts_of = {(i, hashlib.sha256((t or "").encode()).hexdigest()): (t or "").encode() for i, t in rows}
    removed = 0
    by: dict = {}
    for x in out:
        spans = [tuple(map(int, s.split(":"))) for s in x["removed_spans"].split(",")] if x["removed_spans"] else []
        by[x["doc_id"]] = x["n_removed"]
        assert sum(e - s for s, e in spans) == x["n_removed"] and len(spans) == x["n_spans"]
        own = [raw for (i, _), raw in texts_of.items() if i == x["doc_id"] and len(raw) == x["n_bytes"]]
        raw = next(r for r in own if hashlib.sha256(_without(r, spans)).hexdigest() == x["kept_sha256"])
        for s, e in spans:
            assert x["doc_id"] is not None
            held = [lowest[hash(raw[at:at + 100])] < x["doc_id"] for at in range(max(0, s - 99), min(e, len(raw) - 99))]
            first = max(0, s - 99)
            for byte in range(s, e):
                assert any(held[max(0, byte - 99 - first):byte - first + 1]), (x["doc_id"], s, e, byte)
            removed += e - s
    assert removed > 5000
    assert all(by[50 + i] == 0 for i in range(30)) and sum(by[100 + i] > 100 for i in range(40)) >= 38
    assert sum(by[200 + i] >= 100 for i in range(1, 20)) >= 18
    assert chunks.deduplicate(df.limit(0), ["doc_id"]).count() == 0


def _without(raw, spans):
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]])


def test_chunks_come_back_in_step_after_an_insertion():
    raw = LONG.encode()
    a = {raw[x:y] for x, y in itertools.pairwise([0, *chunks.cuts(np.frombuffer(raw, np.uint8)).tolist()])}
    new = raw[:5000] + b"inserted words " + raw[5000:]
    b = [new[x:y] for x, y in itertools.pairwise([0, *chunks.cuts(np.frombuffer(new, np.uint8)).tolist()])]
    assert sum(c not in a for c in b) <= 4


# --- queries ---------------------------------------------------------------------------

def test_queries_with_sql_equal_duckdb(spark):
    import duckdb
    con = duckdb.connect()
    for name in ("pages", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for key, sql in queries.ORACLES.items():
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        got = queries.QUERIES[key](spark, SF).select(*names)
        as_text = lambda rows: sorted(tuple(str(v) for v in row) for row in rows)
        assert as_text(map(tuple, got.collect())) == as_text(want.fetchall()), key


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
