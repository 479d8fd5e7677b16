"""What the stages of the pipeline write and move."""

from __future__ import annotations

from pyspark.sql import functions as F

from answercheck.llm import chunks, common, quality
from answercheck.llm.common import Scratch
from tests.llm.test_operators import frame, prose


def test_quality_stage_writes_no_text(spark):
    df = frame(spark, [(i, " ".join(prose(80, i))) for i in range(30)] + [(3, "x"), (None, None)]).withColumn("lang", F.lit("en"))
    scratch = Scratch(spark, "t")
    kept = quality.keep(df, scratch)
    judged = quality.judge(df, ["doc_id", "text"], Scratch(spark, "t")).where("kept")
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, judged.select("doc_id", "text").collect()))
    assert all("text" not in spark.read.parquet(scratch.path(n)).columns for n in scratch.names)
    assert scratch.names == ["references"]


def test_a_sieve_passes_all_that_have_an_equal_key_and_few_others(spark):
    keys = spark.range(0, 4000, 8)
    rows = spark.range(4000).selectExpr("id as k").union(spark.sql("select cast(null as long)"))
    for bits in (64, 1 << 16):
        out = common.sifted(rows, "k", common.sieve(keys, "id", bits), bits)
        assert out.columns == ["k", "_likely"] and out.count() == 4001
        assert out.where("k % 8 = 0 and not _likely").isEmpty()
    assert out.where("_likely").count() < 600
    assert common.sifted(rows, "k", common.sieve(keys.limit(0), "id")).where("_likely").isEmpty()


def test_only_texts_that_hold_repeats_are_joined(spark, monkeypatch):
    passage = " ".join(prose(60, 7))
    rows = [(i, " ".join(prose(50, 100 + i)) + (" " + passage if i % 10 == 0 else "")) for i in range(60)] + [(None, passage), (30, passage)]
    df = frame(spark, rows)

    def result():
        return sorted(map(str, chunks.deduplicate(df, ["doc_id"]).collect()))

    want = result()
    assert sum("n_removed=0" not in r for r in want) == 6   # all holders but the first, one of them twice
    likely = []

    def watched(rows, key, words, original=chunks.sifted):
        out = original(rows, key, words)
        likely.append((key, out.where("_likely").count()))
        return out

    monkeypatch.setattr(chunks, "sifted", watched)
    assert result() == want
    assert [k for k, _ in likely] == ["digest", "_id"] and likely[1][1] <= 8
    monkeypatch.setattr(chunks, "sieve", lambda keys, key: common.sieve(keys, key, 64))
    monkeypatch.setattr(chunks, "sifted", lambda rows, key, words: common.sifted(rows, key, words, 64))
    assert result() == want
