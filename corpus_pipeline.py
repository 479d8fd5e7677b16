"""A document pipeline of five stages: quality rules, MinHash near-dedup, substring dedup,
personal data, best-fit packing.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``
(the last returns the packed pieces). Stages are written as Parquet and read again, so a
lost executor costs at most one stage's tasks.

Defined cases follow the operators': a null or blank text fails the quality rules; of
rows that repeat a doc_id the near-dedup stage keeps one; a row without a doc_id is no
copy of anything; a text may become empty in the substring stage and is then packed as its
end id alone; ``n_chars`` follows the text; further columns are carried along; an empty
table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answercheck.llm import chunks, minhash, packing, pii, quality
from answercheck.llm.common import Scratch, documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the divergence test."""
    return quality.keep(docs, Scratch(spark, "quality"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return minhash.keep_one(docs, Scratch(spark, "near"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of smaller doc_id holds."""
    out = chunks.deduplicate(docs, [c for c in docs.columns if c != "text"])
    return with_text(out, "kept_text", docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every detected span replaced by its kind."""
    out = pii.detect(docs, [c for c in docs.columns if c != "text"], pii.train(docs))
    return with_text(out, "redacted", docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack(docs, Scratch(spark, "pack"), added_tokens=True)


def with_text(rows: DataFrame, column: str, columns: list[str]) -> DataFrame:
    """``columns`` with the text taken from ``column`` and its length brought up to date."""
    out = rows.withColumn("text", F.col(column))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in columns if c in out.columns])


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

# Weighted MinHash, boosted trees and tokenisers are beyond SQL; tests compare the stages
# with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each but the last through Parquet."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
