"""Registered text keys over the driver's text tables.

Whole texts are processed; results that would echo a whole document back carry its
length and an MD5 of the processed text instead, which both engines compute.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .ws import squash_sql, strip_ws_sql, tokens_sql
from ..registry import query
from ..sources.tables import cents, table
from .text import (abstained, date_column_used, lower, squash, strip_fences, token_overlap,
                   upper, usd)

def _strip_sql(x: str) -> str:
    return strip_ws_sql(x)


@query("text_case", oracle="""
    SELECT c_custkey AS id, upper(c_name) AS name_upper, lower(c_mktsegment) AS segment_lower FROM customer""")
def text_case(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), upper(F.col("c_name")).alias("name_upper"),
                    lower(F.col("c_mktsegment")).alias("segment_lower"))


@query("usd_format", oracle="""
    SELECT o_orderkey AS id,
           '$' || format('{:,.2f}', CAST(ROUND(o_totalprice * 100) AS BIGINT) / 100.0) AS total_usd,
           '$' || format('{:,.2f}', -CAST(ROUND(o_totalprice * 100) AS BIGINT) / 100.0) AS negated_usd
    FROM orders""")
def usd_format(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = cents(F.col("o_totalprice"))
    return o.select(F.col("o_orderkey").alias("id"), usd(c).alias("total_usd"), usd(-c).alias("negated_usd"))


@query("text_squash", oracle=f"""
    SELECT doc_id, length(s) AS squashed_chars, md5(s) AS squashed_md5
    FROM (SELECT doc_id, {squash_sql("text")} AS s FROM documents) t""")
def text_squash(spark, sf_dir):
    """H5 over every document, whole."""
    d = table(spark, sf_dir, "documents").select("doc_id", squash(F.col("text")).alias("s"))
    return d.select("doc_id", F.length("s").alias("squashed_chars"), F.md5("s").alias("squashed_md5"))


_FENCED_SQL = ("(CASE turn % 3 WHEN 0 THEN '```sql' || chr(10) || text || chr(10) || '```' "
               "WHEN 1 THEN ' ' || chr(10) || ' ```' || chr(10) || text || chr(10) || '  ```' || chr(10) || ' ' ELSE text END)")


@query("strip_fences", oracle=f"""
    SELECT conv_id, turn, length(r) AS stripped_chars, md5(r) AS stripped_md5
    FROM (SELECT conv_id, turn,
                 {_strip_sql(f"CASE WHEN starts_with(t, '```') THEN array_to_string(list_filter(string_split(t, chr(10)), "
                             f"lambda ln: NOT starts_with({_strip_sql('ln')}, '```')), chr(10)) ELSE t END")} AS r
          FROM (SELECT conv_id, turn, {_strip_sql(_FENCED_SQL)} AS t FROM conversations) a) b""")
def strip_fences_q(spark, sf_dir):
    """H6 over every conversation turn; two turns in three are fenced as a model fences
    SQL, with a language mark or indented, the others stand as they are."""
    t = F.col("text")
    fenced = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit("```sql\n"), t, F.lit("\n```")))
              .when(F.col("turn") % 3 == 1, F.concat(F.lit(" \n ```\n"), t, F.lit("\n  ```\n "))).otherwise(t))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", strip_fences(fenced).alias("r"))
    return c.select("conv_id", "turn", F.length("r").alias("stripped_chars"), F.md5("r").alias("stripped_md5"))


@query("date_column_used", oracle="""
    SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'shipped_at' WHEN 3 THEN '?' ELSE 'ordered_at' END AS date_column
    FROM conversations""")
def date_column_used_q(spark, sf_dir):
    """H7 over every turn, with a statement that names one of the period columns, both or
    neither put after it."""
    tails = F.array(F.lit(" WHERE shipped_at >= 1"), F.lit(" WHERE ordered_at >= 1"),
                    F.lit(" WHERE shipped_at > ordered_at"), F.lit(" WHERE status = 1"))
    c = table(spark, sf_dir, "conversations")
    said = F.concat("text", F.get(tails, (F.col("turn") % 4).cast("int")))
    return c.select("conv_id", "turn", date_column_used(said).alias("date_column"))


@query("abstention_flag", oracle="""
    SELECT conv_id, turn, turn % 2 = 0 AS abstained FROM conversations""")
def abstention_flag(spark, sf_dir):
    """H8 / O2 on every turn of every conversation, every other one given as a refusal."""
    c = table(spark, sf_dir, "conversations")
    said = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Cannot answer: "), F.col("text"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", abstained(said).alias("abstained"))


def _turn_pairs(spark, sf_dir):
    """Each turn with the next turn of the same conversation (a 1:1 equi-join)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    nxt = c.select(F.col("conv_id").alias("n_conv"), (F.col("turn") - 1).alias("n_turn"),
                   F.col("text").alias("reply"))
    return c.join(nxt, (c.conv_id == nxt.n_conv) & (c.turn == nxt.n_turn)).select("conv_id", "turn", "text", "reply")


def _tok(x: str) -> str:
    return tokens_sql(x)


@query("token_overlap", oracle=f"""
    WITH p AS (SELECT a.conv_id, a.turn, a.text, b.text AS reply FROM conversations a
               JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
    ta AS (SELECT conv_id, turn, t, COUNT(*) AS na FROM (SELECT conv_id, turn, unnest({_tok('text')}) AS t FROM p)
           GROUP BY conv_id, turn, t),
    tb AS (SELECT conv_id, turn, t, COUNT(*) AS nb FROM (SELECT conv_id, turn, unnest({_tok('reply')}) AS t FROM p)
           GROUP BY conv_id, turn, t),
    m AS (SELECT conv_id, turn, SUM(LEAST(na, nb)) AS matched FROM ta JOIN tb USING (conv_id, turn, t)
          GROUP BY conv_id, turn),
    s AS (SELECT conv_id, turn, len({_tok('text')}) + len({_tok('reply')}) AS total FROM p)
    SELECT s.conv_id, s.turn, s.total AS tokens, COALESCE(m.matched, 0) AS matched,
           CASE WHEN s.total = 0 THEN 1.0 ELSE ROUND(2.0 * COALESCE(m.matched, 0) / s.total, 6) END AS overlap
    FROM s LEFT JOIN m USING (conv_id, turn)""")
def token_overlap_q(spark, sf_dir):
    """P1 in SQL terms: how much of a reply repeats the turn before it, as a
    multiset token overlap, for every consecutive pair of turns."""
    return token_overlap(_turn_pairs(spark, sf_dir), ["conv_id", "turn"], "text", "reply")
