"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from answercheck.llm import minhash, pii, quality
from answercheck.llm.common import Scratch
from tests.llm.test_operators import DOCS, EDGES, SF, chunks_by_force, classes_by_force, frame


def stages(spark, docs):
    scratch, out = Scratch(spark, "t"), {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.put(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = stages(spark, docs)
    rows = {name: {r["doc_id"]: r for r in df.collect()} for name, df in out.items() if name != "packing"}
    judged = quality.judge(docs, ["doc_id"], Scratch(spark, "t")).where("kept").collect()
    assert set(rows["quality"]) == {r["doc_id"] for r in judged} and rows["quality"]
    before = [(i, r["text"]) for i, r in rows["quality"].items()]
    classes = classes_by_force(before)
    assert set(rows["near_duplicates"]) == {i for i, _ in before if classes.get(i, i) == i}
    assert all(r == rows[""][i] for i, r in rows["near_duplicates"].items())
    import hashlib
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = chunks_by_force([(i, r["text"]) for i, r in rows["near_duplicates"].items()])
    assert sorted((i, sha(r["text"])) for i, r in rows["substrings"].items()) == [(i, h) for i, _, h in want]
    for i, r in rows["personal_data"].items():
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    packed = out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"] for r in packed} == set(rows["personal_data"])
    for name in ("quality", "near_duplicates", "substrings", "personal_data"):
        assert out[name].columns == docs.columns and out[name].dtypes == docs.dtypes


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    drop = ["sequence_id", "offset"]
    a = sorted(map(tuple, stages(spark, docs)["packing"].drop(*drop).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop(*drop).collect())) == a


def test_edges_and_extra_columns_pass(spark):
    text = EDGES[7][1]
    rows = [(i, t, None, None, None) for i, t in EDGES] + [(None, text, None, "s", 1), (6, text, "en", "s", 1)]
    df = frame(spark, rows, DOCS).withColumn("kept", F.lit("x")).withColumn("redacted", F.lit(1)).withColumn("_extra", F.lit(2))
    out = stages(spark, df)
    assert sorted(r["doc_id"] or 0 for r in out["personal_data"].collect()) == [0, 6]
    empty = stages(spark, df.limit(0))
    assert all(x.count() == 0 for x in empty.values())
