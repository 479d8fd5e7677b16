"""Ids of texts that hold an added token's string."""

from __future__ import annotations

import zlib

import numpy as np

import corpus_pipeline
from answercheck.llm import packing, queries
from tests.llm.test_operators import frame

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a\n<|endoftext|>  b ", "<|endoftext|", "no", None,
         "é<|endoftext|>" * 700]


def test_packing_query_and_stage_equal_tokenizers(spark, monkeypatch):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_path())
    assert t.encode(TEXTS[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = []
    for i, text in enumerate(TEXTS):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want += [(i, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 1024))]
    df = frame(spark, list(enumerate(TEXTS)))
    monkeypatch.setattr(queries, "documents", lambda *_: df)
    for out in (queries.op8_packing(spark, ""), corpus_pipeline.packing_stage(spark, df, "")):
        assert sorted((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in out.collect()) == want
