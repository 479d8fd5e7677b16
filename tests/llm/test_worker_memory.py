"""What a task holds at once and what its worker keeps afterwards."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from answercheck.llm import common, packing, quality
from tests.llm.test_operators import frame, prose


def test_batches_are_handled_in_slices():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], names=["a"]) for n in (0, 3, 10)]
    out = list(common.slices(iter(batches), 4))
    assert [b.num_rows for b in out] == [3, 4, 4, 2]
    assert [x for b in out for x in b.column("a").to_pylist()] == [*range(3), *range(10)]


def test_words_are_not_remembered_beyond_a_task():
    enc = packing.Encoder(packing.tokenizer_path())
    want = enc.encode("some words of a text")
    assert enc.first and enc.later
    enc.forget()
    assert not enc.first and not enc.later and not enc.old and enc.encode("some words of a text") == want


def test_quality_stage_moves_a_text_once(spark, monkeypatch):
    moved = []

    def watched(rows, carry, original=quality.counted):
        moved.append((rows.columns, carry))
        return original(rows, carry)

    monkeypatch.setattr(quality, "counted", watched)
    df = frame(spark, [(i, " ".join(prose(80, i))) for i in range(30)]).withColumn("lang", F.lit("en")).withColumn("kept", F.lit(7))
    kept = quality.keep(df, common.Scratch(spark, "t"))
    assert kept.columns == df.columns and kept.select("kept").distinct().collect() == [(7,)]
    assert [len([c for c in columns if "text" in c]) for columns, _ in moved] == [1, 1]
    assert not any(f.dataType.typeName() == "struct" for f in df.schema.fields)
