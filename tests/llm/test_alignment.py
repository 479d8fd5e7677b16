"""Cross-tokenizer alignment against a byte-by-byte version with the libraries themselves."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from answercheck.llm import alignment, packing, pieces
from answercheck.llm.common import Scratch

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(packing.tokenizer_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    shown = packing._byte_alphabet()

    def bytes_a(i):
        return bytes(shown[c] for c in a.id_to_token(i))

    def bytes_b(i):
        if b.is_byte(i):
            return bytes([int(b.id_to_piece(i)[3:5], 16)])
        return b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        parts_a, parts_b = [bytes_a(i) for i in ids_a], [bytes_b(i) for i in ids_b]
        if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            return None
        return (ids_a, parts_a), (ids_b, parts_b)
    return tokens


def force(rows, tokens):
    """Per row its measures, by the owner of each byte."""
    per_text, counts = {}, Counter()
    for _, text in rows:
        if text not in per_text:
            both = tokens(text)
            if both is None:
                per_text[text] = None
                continue
            owners, ends = [], []
            for ids, parts in both:
                owner, end, at = [], set(), 0
                for k, p in enumerate(parts):
                    owner += [k] * len(p)
                    at += len(p)
                    end.add(at)
                owners.append(owner)
                ends.append(end)
            (a, _), (b, _) = both
            links = sorted({(i, j) for i, j in zip(*owners)})
            cuts, groups, first = sorted(ends[0] & ends[1]), [], 0
            for cut in cuts:
                own = [sorted({o[x] for x in range(first, cut)}) for o in owners]
                groups.append(",".join(str(a[i]) for i in own[0]) + "|" + ",".join(str(b[j]) for j in own[1]))
                first = cut
            per_text[text] = len(a), len(b), groups, [(a[i], b[j]) for i, j in links]
        if per_text[text]:
            counts.update(per_text[text][3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, text in rows:
        if per_text[text] is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = per_text[text]
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


EDGES = [(1, None), (2, ""), (3, " "), (4, "  "), (5, " a"), (6, "a "), (7, "a  b   c"), (8, "\t\n a \n b\n\n"),
         (9, "a▁b"), (10, "▁"), (11, "<|endoftext|> x <|endoftext|>"), (12, "</s> <s> <unk> <0x41>"), (13, "naïve café 北京 日本語 🙂👩‍👩‍👧"),
         (14, " x 　y  z\u0085"), (15, "\x00 \x1c a\x1cb \x1f"), (16, "é ́"), (17, "x" * 3000),
         (18, "1234567890" * 50), (19, "don't we'll I'm"), (20, "same text"), (20, "same text"), (None, "same text"),
         (21, "same text"), (22, "北京" * 700), (23, "\r\n"), (24, "word " * 500)]


def test_alignment_edges_equal_bytewise_version(spark, libraries):
    found, _ = alignment.align(spark.createDataFrame(EDGES, SCHEMA), Scratch(spark, "t"))
    assert got(found) == force(EDGES, libraries)


@pytest.mark.parametrize("frequent", [0, 50, 1 << 18])
def test_alignment_is_the_same_however_pairs_are_looked_up(spark, libraries, frequent):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows += rows[:5]
    found, _ = alignment.align(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t"), frequent=frequent)
    assert got(found) == force(rows, libraries)


def test_alignment_hot_text_and_forgotten_units(spark, libraries, monkeypatch):
    rows = [(i, "a text that most rows hold") for i in range(3000)] + [(5000 + i, f"row {i} alone") for i in range(40)]
    found, pairs = alignment.align(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t"))
    assert got(found) == force(rows, libraries)
    assert pairs.where("best").count() >= pairs.select("b").distinct().count()

    both = alignment.Aligner(packing.tokenizer_path(), pieces.model_path())
    monkeypatch.setattr(alignment, "LIMIT", 3)
    monkeypatch.setattr(alignment, "UNITS", 2)
    for text in ["one two three one four", "five one two", "one two three one four", "six  seven\n eight"]:
        units = both.units(text)
        both.learn(set(units))
        n_a, n_b, n_groups, n_links, digest, codes, times = both.measure(units)
        row = force([(1, text)], libraries)[0]
        assert (n_a, n_b, n_groups, n_links, digest) == (*row[1:5], row[7])
        assert times.sum() == n_links and len(set(codes.tolist())) == len(codes)


def test_alignment_of_empty_and_wider_tables(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"))[0].collect() == []
    wide = spark.createDataFrame([(1, "a b", "x", 3, "y"), (2, None, None, None, None)],
                                 "doc_id long, text string, digest string, copies int, code string")
    found, _ = alignment.align(wide, Scratch(spark, "t"))
    assert sorted(r["n_a"] for r in found.collect()) == [0, 2]
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
