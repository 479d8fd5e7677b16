"""Prompt rows for batch inference (P3), re-aimed from a per-call prompt builder.

One row per (question, level): the system text is a base instruction, the schema the
candidate may use (DDL of the governed views, from their own schemas), and the
guidance blocks of every level up to this one. Candidates then arrive as a table
(``run_id, level, question_id, sql_text``) and are scored by ``operators.scoring``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The guidance added at each level (written for the shop views).
BASE = ("Write one Spark SQL query for the analytics warehouse below, and nothing else: "
        "no prose, no code fences.")
BLOCKS = (
    ("annotated", "Notes: shop_orders.total_cents is the order total; never sum it across a join to "
                  "shop_order_items. Only status 'completed' is a sale. Money is integer cents. If the "
                  "schema cannot answer, reply exactly: CANNOT ANSWER: <reason>."),
    ("defined", "Definitions: revenue is SUM(total_cents) over completed orders, booked on ordered_at; "
                "net revenue subtracts SUM(shop_refunds.amount_cents); a month is [first day, first day "
                "of the next month)."),
)


def schema_ddl(session: SparkSession, views: list[str]) -> str:
    """CREATE TABLE text for each governed view, columns in order."""
    parts = []
    for v in views:
        cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in session.table(v).schema.fields)
        parts.append(f"CREATE TABLE {v} ({cols});")
    return "\n".join(parts)


def prompt_dataset(spark: SparkSession, suite: DataFrame, levels: DataFrame, ddl: str,
                   blocks=BLOCKS) -> DataFrame:
    """(question_id, level, system_prompt, user_prompt, prompt_chars, growth_chars)."""
    ranks = {name: i for i, name in enumerate(r.level for r in levels.orderBy("level_rank").collect())}
    b = spark.createDataFrame([(ranks[lv], text) for lv, text in blocks], "block_rank int, text string")
    top = max(ranks.values())
    applied = b.withColumn("level_rank", F.explode(F.sequence(F.col("block_rank"), F.lit(top))))
    per_level = (levels.join(applied, "level_rank", "left").groupBy("level", "level_rank")
                 .agg(F.array_sort(F.collect_list(F.struct("block_rank", "text"))).alias("b")))
    system = F.concat_ws("\n\n", F.lit(BASE), F.lit("SCHEMA\n" + ddl), F.transform("b", lambda x: x.getField("text")))
    per_level = per_level.select("level", "level_rank", system.alias("system_prompt"))
    # The suite is one small array per level: every level gets every question without a join.
    asked = [(r.question_id, r.text) for r in suite.select("question_id", "text").collect()]
    questions = F.array(*[F.struct(F.lit(q).alias("question_id"), F.lit(t).alias("user_prompt")) for q, t in asked])
    grid = per_level.withColumn("q", F.explode(questions)).select("q.*", "level", "level_rank", "system_prompt")
    chars = F.length("system_prompt") + F.length("user_prompt")
    # The first level's prompt length follows from the inputs alone.
    first_len = len("\n\n".join([BASE, "SCHEMA\n" + ddl] + [t for lv, t in blocks if ranks[lv] == 0]))
    return (grid.withColumn("prompt_chars", chars)
            .withColumn("growth_chars", F.length("system_prompt") - F.lit(first_len)).drop("level_rank"))
