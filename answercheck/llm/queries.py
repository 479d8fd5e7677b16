"""The thin ``opN_<name>`` queries: each applies an operator to its whole table with
production parameters and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answercheck.sources.tables import table

from . import (alignment, bwt, chunks, embeddings, licenses, minhash, negatives, packing, pieces, pii, quality, warc,
               winnowing)
from .common import Scratch, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn
    return wrap


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), ["doc_id"], Scratch(spark, "op5"))


OP6_SQL = """
WITH r AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM r WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT r.page_id, r.payload_bytes, r.payload_digest,
       CASE WHEN r.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.page_id > f.first_id THEN f.first_id END AS refers_to
FROM r LEFT JOIN f ON f.payload_digest = r.payload_digest AND r.payload_bytes >= 100
"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.deduplicate(table(spark, sf_dir, "pages"), "page_id", "url", "html", Scratch(spark, "op6").root)
    return out.select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to").withColumnRenamed(
        "record_id", "page_id")


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), Scratch(spark, "op8"), added_tokens=True)


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.detect(docs, ["doc_id"], pii.train(docs)).drop("redacted")


@query("op2_minhash")
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), Scratch(spark, "op2"))


@query("op10_chunks")
def op10_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.deduplicate(documents(spark, sf_dir), ["doc_id"]).drop("kept_text")


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN c ON c.a = v.vec_id
"""


@query("op1_embeddings", OP1_SQL)
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "op1"))


@query("op4_licenses")
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir), ["doc_id"])


@query("op9_pieces")
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count, a digest of the ids, digest and correctness of the text
    decoded from them."""
    docs = documents(spark, sf_dir)
    back = pieces.encode_and_decode(docs, ["doc_id", "text"])
    return back.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op3_bwt")
def op3_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt.deduplicate(documents(spark, sf_dir), Scratch(spark, "op3")).drop("kept_bytes")


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), Scratch(spark, "op11"))[0]


OP12_SQL = r"""
WITH words AS (
  SELECT k, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS k, doc_id, text FROM documents)),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
runs AS (
  SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT words.*, s.n, unnest(range(1, len(w) - s.n + 2)) AS i
        FROM words JOIN (SELECT DISTINCT n FROM windows) s ON len(w) >= s.n)),
hits AS (SELECT k, i, windows.n, item_id FROM runs JOIN windows USING (n, run)),
hit_words AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM hits) GROUP BY k),
hit_items AS (SELECT k, count(DISTINCT item_id) AS n_items,
                     sha256(array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',')) AS items_sha256
              FROM hits GROUP BY k)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN hit_words USING (k) LEFT JOIN hit_items USING (k)
"""


@query("op12_winnowing", OP12_SQL)
def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), Scratch(spark, "op12"))[0]


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


@query("op13_negatives", OP13_SQL)
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, Scratch(spark, "op13"))
