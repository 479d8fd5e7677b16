"""Every language is judged against its own reference."""

from __future__ import annotations

import random

from answercheck.llm import quality
from answercheck.llm.common import Scratch
from tests.llm.test_operators import DOCS, frame, prose

CYRILLIC = str.maketrans("abcdefghijklmnop", "абвгдежзийклмноп")


def corpus():
    r = random.Random(8)
    rows = [(i, " ".join(prose(r.randint(300, 600), i)), "it", "s", 1) for i in range(90)]
    rows += [(100 + i, " ".join(prose(r.randint(300, 600), i)).translate(CYRILLIC), "ru", "s", 1) for i in range(30)]
    rows += [(200 + i, " ".join(prose(500, i)).translate(CYRILLIC), lang, "s", 1)
             for i, lang in enumerate([None, "", " ", "uk", "bg"])]
    return [*rows, (300, " ".join(prose(500, 1)).translate(CYRILLIC), "it", "s", 1)]


def test_quality_keeps_clean_documents_of_smaller_unlisted_languages(spark):
    df = frame(spark, corpus(), DOCS)
    got = {x["doc_id"]: x for x in quality.judge(df, ["doc_id"], Scratch(spark, "t")).collect()}
    assert len(got) == 126 and all(got[i]["kept"] for i in [*range(90), *range(100, 130)])
    assert all(got[100 + i]["class_distance"] < 0.1 for i in range(30))
    # Null, blank and too small languages have no reference and no distance.
    assert all(got[200 + i]["class_distance"] is None and got[200 + i]["kept"] for i in range(5))
    assert not got[300]["kept"] and got[300]["class_distance"] > 0.5


def test_quality_is_the_same_without_a_broadcast(spark):
    df = frame(spark, corpus(), DOCS)
    want = sorted(map(repr, quality.judge(df, ["doc_id"], Scratch(spark, "t")).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(repr, quality.judge(df, ["doc_id"], Scratch(spark, "t")).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
