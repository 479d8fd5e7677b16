"""Column functions over text.

All are built-in Spark expressions (JVM-side, inside whole-stage codegen). Text similarity
is the multiset token overlap: explode + groupBy (``token_overlap``) for long texts, array
functions (``token_dice``) for short ones such as SQL statements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ws import squash as _squash
from .ws import strip_ws, tokens, tokens_sql

# The fence marker, and the two date columns the period rulings name.
FENCE = "```"
DATE_COLUMNS = ("ordered_at", "shipped_at")


def upper(c: Column) -> Column:
    return F.upper(c)


def lower(c: Column) -> Column:
    return F.lower(c)


def usd(cents: Column) -> Column:
    """H4: cents as dollars, ``$1,234.56``; negative as ``$-5.00``."""
    return F.concat(F.lit("$"), F.format_number(cents / F.lit(100), 2))


def squash(c: Column, width: int | None = None) -> Column:
    """H5: collapse every whitespace run to one space, strip the ends; optionally cut
    to ``width`` characters for display (the whole text is processed either way)."""
    out = _squash(c)
    return out if width is None else F.substring(out, 1, width)


def strip_fences(c: Column) -> Column:
    """H6: if the stripped text starts with a fence, drop every line whose stripped
    form starts with one; strip the result."""
    t = strip_ws(c)
    kept = F.array_join(F.filter(F.split(t, "\n"), lambda ln: ~strip_ws(ln).startswith(FENCE)), "\n")
    return strip_ws(F.when(t.startswith(FENCE), kept).otherwise(t))


def date_column_used(c: Column) -> Column:
    """H7: which period column a statement names (first match wins), else '?'."""
    out = F.lit("?")
    for name in reversed(DATE_COLUMNS):
        out = F.when(c.contains(name), F.lit(name)).otherwise(out)
    return out


def abstained(c: Column) -> Column:
    """H8: the text declines to answer."""
    from ..sources.suite import ABSTAIN
    return F.upper(c).startswith(ABSTAIN)


def token_dice(a: Column, b: Column) -> Column:
    """Multiset token overlap 2*M/T of two short texts, rounded to 6 places; 1.0 for
    two empty texts. Quadratic in tokens per row: for statements, not documents."""
    ta, tb = tokens(a), tokens(b)
    m = F.aggregate(F.array_distinct(ta), F.lit(0),
                    lambda acc, t: acc + F.least(F.size(F.filter(ta, lambda x: x == t)),
                                                 F.size(F.filter(tb, lambda x: x == t))))
    total = F.size(ta) + F.size(tb)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.round(F.lit(2.0) * m / total, 6))


def token_dice_sql(a: str, b: str) -> str:
    """``token_dice`` for DuckDB (oracle)."""
    m = (f"(SELECT COALESCE(SUM(LEAST(x.n, y.n)), 0) FROM "
         f"(SELECT t, COUNT(*) AS n FROM (SELECT unnest({tokens_sql(a)}) AS t) GROUP BY t) x JOIN "
         f"(SELECT t, COUNT(*) AS n FROM (SELECT unnest({tokens_sql(b)}) AS t) GROUP BY t) y USING (t))")
    total = f"(len({tokens_sql(a)}) + len({tokens_sql(b)}))"
    return f"CASE WHEN {total} = 0 THEN 1.0 ELSE ROUND(2.0 * {m} / {total}, 6) END"


def token_overlap(pairs: DataFrame, key: list[str], left: str, right: str) -> DataFrame:
    """P1 for texts of any length: per pair key, the multiset token overlap 2*M/T.

    Each text is tokenized once; both sides' tokens are exploded together, tagged by
    side, and counted per (pair, token) in one aggregation (no join), then summed per
    pair. A pair holding one enormous text is spread over tasks by token, never held
    in one row. ``explode_outer`` keeps pairs whose texts have no tokens (overlap 1.0)."""
    tagged = F.concat(F.transform(tokens(F.col(left)), lambda t: F.struct(F.lit(0).alias("s"), t.alias("t"))),
                      F.transform(tokens(F.col(right)), lambda t: F.struct(F.lit(1).alias("s"), t.alias("t"))))
    per_token = (pairs.select(*key, F.explode_outer(tagged).alias("x"))
                 .groupBy(*key, F.col("x.t").alias("token"))
                 .agg(F.count_if(F.col("x.s") == 0).alias("na"), F.count_if(F.col("x.s") == 1).alias("nb")))
    per_pair = per_token.groupBy(*key).agg(
        F.sum(F.col("na") + F.col("nb")).alias("total"),
        F.sum(F.when(F.col("token").isNotNull(), F.least("na", "nb"))).alias("matched"))
    m = F.coalesce(F.col("matched"), F.lit(0)).cast("long")
    return per_pair.select(*key, F.col("total").cast("int").alias("tokens"), m.alias("matched"),
                           F.when(F.col("total") == 0, F.lit(1.0))
                           .otherwise(F.round(F.lit(2.0) * m / F.col("total"), 6)).alias("overlap"))
