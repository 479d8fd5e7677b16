"""The question suite, candidate layers and access policy, as DataFrames.

Questions carry trusted SQL written in the shop vocabulary (see ``sources.tables``),
so the same text runs on Spark through the shop views and on DuckDB through the same
views given as a WITH prefix. Each gold query writes down a ruling: completed means
status 'completed', a month is half-open on ``ordered_at``, net subtracts all
refunds, and "sold" means sold on a completed order.

Candidates are layered: each prompt level inherits the level below and replaces some
answers. Layers are rows; the text a level uses is the one from the highest layer at
or below it (``max_by``), and a question no layer answers gets a default abstention.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The abstention marker and the default text for a missing answer.
ABSTAIN = "CANNOT ANSWER"
DEFAULT_ABSTENTION = f"{ABSTAIN}: no candidate was given for this question."
# The prompt levels, in order.
LEVELS = ("bare", "annotated", "defined")
MONTH_FROM, MONTH_TO = "1998-03-01", "1998-04-01"
LOOKUP_NATION = "NATION_7"


@dataclass(frozen=True)
class Question:
    question_id: str
    text: str
    gold_sql: str
    category: str
    ordered: bool = False
    answerable: bool = True
    kinds: tuple[str, ...] = ("exact",)       # result column comparison types (oracle)
    order_by: str = ""                         # positional order the gold promises (oracle)


def build_questions(month_from: str = MONTH_FROM, month_to: str = MONTH_TO,
                    nation: str = LOOKUP_NATION, month_name: str = "March 1998") -> tuple[Question, ...]:
    """The suite, re-expressed on the shop views. The ruling values (the month asked
    about, the nation looked up) are parameters; the defaults fit the driver's data."""
    # The questions and their gold SQL.
    MONTH_FROM, MONTH_TO, LOOKUP_NATION = month_from, month_to, nation  # noqa: N806
    return (
        Question("total_revenue", "What is our total completed revenue?",
                 "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed'",
                 "aggregate"),
        Question("revenue_by_country", "What is completed revenue by country?",
                 "SELECT c.country, SUM(o.total_cents) FROM shop_orders o "
                 "JOIN shop_customers c ON c.id = o.customer_id WHERE o.status = 'completed' GROUP BY c.country",
                 "join", kinds=("text", "exact")),
        Question("top_products", "What are the top 3 products by units sold?",
                 "SELECT i.product, SUM(i.qty) AS units FROM shop_order_items i "
                 "JOIN shop_orders o ON o.id = i.order_id WHERE o.status = 'completed' "
                 "GROUP BY i.product ORDER BY units DESC, i.product ASC LIMIT 3",
                 "ranking", ordered=True,
                 kinds=("text", "exact"), order_by="c1 DESC, c0 ASC"),
        Question("march_revenue", f"How much revenue did we book in {month_name}?",
                 "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed' "
                 f"AND ordered_at >= '{MONTH_FROM}' AND ordered_at < '{MONTH_TO}'",
                 "definition"),
        Question("net_revenue", "What is our completed revenue after refunds?",
                 "SELECT (SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed') "
                 "- (SELECT COALESCE(SUM(amount_cents), 0) FROM shop_refunds)",
                 "definition"),
        Question("avg_order_value", "What is the average value of a completed order?",
                 "SELECT AVG(total_cents) FROM shop_orders WHERE status = 'completed'",
                 "aggregate", kinds=("float",)),
        Question("nation_customers", f"How many customers do we have in {LOOKUP_NATION}?",
                 f"SELECT COUNT(*) FROM shop_customers WHERE country = '{LOOKUP_NATION}'",
                 "lookup"),
        Question("pending_orders", "How many orders are currently pending?",
                 "SELECT COUNT(*) FROM shop_orders WHERE status = 'pending'", "lookup"),
        Question("customer_emails", "List every customer's email address.",
                 "SELECT email FROM shop_customers", "permissions", kinds=("text",)),
        Question("best_channel", "Which marketing channel drove the most revenue last quarter?", "",
                 "abstention", answerable=False),
        Question("satisfaction_by_country", "What is the average customer satisfaction score by country?", "",
                 "abstention", answerable=False),
        Question("support_tickets", "How many support tickets did we close in March?", "",
                 "abstention", answerable=False),
    )


QUESTIONS = build_questions()
BY_ID = {q.question_id: q for q in QUESTIONS}

def build_layers(month_from: str = MONTH_FROM, month_to: str = MONTH_TO,
                 nation: str = LOOKUP_NATION) -> dict[str, dict[str, str]]:
    """Candidate answers by layer. A layer replaces the answers of the layers below
    it; level n uses layers 0..n."""
    MONTH_FROM, MONTH_TO, LOOKUP_NATION = month_from, month_to, nation  # noqa: N806
    # The candidate texts, each reproducing a known mistake or its fix.
    return {
        "bare": {
            "total_revenue": "SELECT SUM(o.total_cents) FROM shop_orders o "
                             "JOIN shop_order_items i ON i.order_id = o.id WHERE o.status = 'completed'",
            "revenue_by_country": "SELECT c.country, SUM(o.total_cents) FROM shop_orders o "
                                  "JOIN shop_customers c ON c.id = o.customer_id WHERE o.status = 'completed' "
                                  "GROUP BY c.country",
            "top_products": "SELECT product, SUM(qty) AS units FROM shop_order_items "
                            "GROUP BY product ORDER BY units DESC, product ASC LIMIT 3",
            "march_revenue": "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed' "
                             f"AND shipped_at >= '{MONTH_FROM}' AND shipped_at < '{MONTH_TO}'",
            "net_revenue": "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed'",
            "avg_order_value": "SELECT AVG(total_cents) FROM shop_orders",
            "nation_customers": f"SELECT COUNT(*) FROM shop_customers WHERE country = '{LOOKUP_NATION}'",
            "pending_orders": "SELECT COUNT(*) FROM shop_orders WHERE status = 'pending'",
            "customer_emails": "SELECT email FROM shop_customers",
            "best_channel": "SELECT ch.name, SUM(o.total_cents) FROM shop_orders o "
                            "JOIN marketing_channels ch ON ch.id = o.channel_id GROUP BY ch.name ORDER BY 2 DESC LIMIT 1",
            "satisfaction_by_country": "SELECT c.country, AVG(c.satisfaction_score) FROM shop_customers c "
                                       "GROUP BY c.country",
            "support_tickets": "SELECT COUNT(*) AS tickets_closed FROM shop_orders "
                               f"WHERE ordered_at >= '{MONTH_FROM}' AND ordered_at < '{MONTH_TO}'",
        },
        "annotated": {
            "total_revenue": "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed'",
            "top_products": "SELECT i.product, SUM(i.qty) AS units FROM shop_order_items i "
                            "JOIN shop_orders o ON o.id = i.order_id WHERE o.status = 'completed' "
                            "GROUP BY i.product ORDER BY units DESC, i.product ASC LIMIT 3",
            "avg_order_value": "SELECT AVG(total_cents) FROM shop_orders WHERE status = 'completed'",
            "best_channel": "CANNOT ANSWER: no table in this schema records marketing channels.",
            "satisfaction_by_country": "CANNOT ANSWER: no satisfaction or survey data in this schema.",
            "support_tickets": "CANNOT ANSWER: this schema has orders, not support tickets.",
        },
        "defined": {
            "march_revenue": "SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed' "
                             f"AND ordered_at >= '{MONTH_FROM}' AND ordered_at < '{MONTH_TO}'",
            "net_revenue": "SELECT (SELECT SUM(total_cents) FROM shop_orders WHERE status = 'completed') "
                           "- (SELECT COALESCE(SUM(amount_cents), 0) FROM shop_refunds)",
        },
    }


CANDIDATE_LAYERS = build_layers()

# Columns the analyst role may not read (the reference protects one).
DENIED_COLUMNS = (("shop_customers", "email"),)
# Concepts the unanswerable questions turn on, and ones that exist.
CONCEPTS = (("best_channel", "channel"), ("satisfaction_by_country", "satisfaction"),
            ("support_tickets", "ticket"), (None, "campaign"),
            (None, "order"), (None, "price"), (None, "nation"))

SUITE_SCHEMA = T.StructType([
    T.StructField("question_id", T.StringType(), False), T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("text", T.StringType(), False), T.StructField("gold_sql", T.StringType(), False),
    T.StructField("category", T.StringType(), False), T.StructField("ordered", T.BooleanType(), False),
    T.StructField("answerable", T.BooleanType(), False),
])


def suite_df(spark: SparkSession, questions=QUESTIONS) -> DataFrame:
    rows = [(q.question_id, i, q.text, q.gold_sql, q.category, q.ordered, q.answerable)
            for i, q in enumerate(questions)]
    return spark.createDataFrame(rows, SUITE_SCHEMA)


def layers_df(spark: SparkSession, layers=CANDIDATE_LAYERS) -> DataFrame:
    """One row per (layer, question) override: (layer_name, layer_rank, question_id, sql_text)."""
    rows = [(name, rank, qid, sql) for rank, (name, answers) in enumerate(layers.items())
            for qid, sql in answers.items()]
    return spark.createDataFrame(rows, "layer_name string, layer_rank int, question_id string, sql_text string")


def levels_df(spark: SparkSession, levels=LEVELS) -> DataFrame:
    return spark.createDataFrame([(lv, i) for i, lv in enumerate(levels)], "level string, level_rank int")


def layered_candidates(spark: SparkSession, run_id: str = "mock", layers=CANDIDATE_LAYERS) -> DataFrame:
    """A5: the text each level uses, from the highest layer at or below the level."""
    lv = levels_df(spark, tuple(layers))
    ly = layers_df(spark, layers)
    # A layer applies to its own level and every level above: expand each override
    # to those level ranks (an equi-join follows, not a range join).
    top = len(layers) - 1
    applied = ly.withColumn("level_rank", F.explode(F.sequence(F.col("layer_rank"), F.lit(top))))
    joined = lv.join(applied, "level_rank")
    return (joined.groupBy("level", "question_id")
            .agg(F.max_by("sql_text", "layer_rank").alias("sql_text"))
            .select(F.lit(run_id).alias("run_id"), "level", "question_id", "sql_text"))


def fill_candidates(suite: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every (run, level) gets a row for every question of the suite; a missing answer
    is the default abstention, so the scorer never sees a hole. The suite's question ids
    are one small array, exploded per (run, level): no join makes the grid."""
    ids = [r.question_id for r in suite.select("question_id").collect()]
    grid = candidates.select("run_id", "level").distinct().withColumn(
        "question_id", F.explode(F.array(*[F.lit(q) for q in ids])))
    return (grid.join(candidates, ["run_id", "level", "question_id"], "left")
            .select("run_id", "level", "question_id",
                    F.coalesce(F.col("sql_text"), F.lit(DEFAULT_ABSTENTION)).alias("sql_text")))


def suite_profile(suite: DataFrame) -> DataFrame:
    """A4: how the suite is made up: questions per category, ranking and
    answerability."""
    return suite.groupBy("category", "ordered", "answerable").agg(F.count(F.lit(1)).alias("questions"))
