"""Registered scoring reports (K1-K10, T3, P2) and their DuckDB oracles.

Every report scores the suite's layered candidates by executing them over the whole
driver tables. The oracle is generated from the same suite data: candidate layering
with ``arg_max`` over the layers, one EXCEPT ALL comparison per runnable pair on the
shop views given as a WITH prefix, and the same verdict chain as a CASE. For the
analyst role the oracle marks a statement as refused when its text names the
protected column; the Spark side finds it by walking the analyzed plan.
"""

from __future__ import annotations

import uuid
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.governed import REFUSED
from ..registry import query
from ..session import ensure_checkpoint_dir
from ..sources.suite import ABSTAIN, CANDIDATE_LAYERS, DEFAULT_ABSTENTION, QUESTIONS, layered_candidates, levels_df
from ..sources.tables import SHOP_VIEWS_SQL
from ..functions.text import date_column_used, token_dice_sql
from . import scoring
from .diff_queries import Pair, _oracle_pair
from .explain import explain_sql


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Later runs of the same questions, in which the protected column is no longer
# asked for from the second level on, and then from the first.
_HARMLESS = {"customer_emails": "SELECT id, country FROM shop_customers"}
RUNS = {"mock": CANDIDATE_LAYERS,
        "next": {name: answers | (_HARMLESS if name == "annotated" else {}) for name, answers in CANDIDATE_LAYERS.items()},
        "last": {name: answers | (_HARMLESS if name == "bare" else {}) for name, answers in CANDIDATE_LAYERS.items()}}
RUN_TIMES = {"mock": "2025-03-01 08:00:00", "next": "2025-03-08 08:00:00", "last": "2025-03-15 08:00:00"}


def _effective_candidates(layer_set: dict) -> dict[tuple[str, str], str]:
    """Python form of the layering rule, used only to pick which pairs the oracle
    embeds (the oracle recomputes the layering itself in SQL)."""
    out: dict[tuple[str, str], str] = {}
    names = list(layer_set)
    for rank, level in enumerate(names):
        for layer in names[: rank + 1]:
            for qid, sql in layer_set[layer].items():
                out[(level, qid)] = sql
    return out


@lru_cache(maxsize=None)
def outcomes_oracle(role: str = "owner", run_id: str = "mock") -> str:
    """A SELECT producing the outcomes table, columns as ``scoring.score``."""
    layer_set = RUNS[run_id]
    views = ",\n".join(f"{n} AS ({b})" for n, b in SHOP_VIEWS_SQL.items())
    levels = ", ".join(f"({_q(lv)}, {i})" for i, lv in enumerate(layer_set))
    layers = ", ".join(f"({r}, {_q(qid)}, {_q(sql)})" for r, (name, answers) in enumerate(layer_set.items())
                       for qid, sql in answers.items())
    suite = ", ".join(
        f"({_q(q.question_id)}, {i}, {_q(q.category)}, {str(q.answerable).upper()}, {str(q.ordered).upper()}, "
        f"{_q(q.gold_sql)})" for i, q in enumerate(QUESTIONS))
    by_id = {q.question_id: q for q in QUESTIONS}
    facts = []
    seen = set()
    for (level, qid), sql in _effective_candidates(layer_set).items():
        q = by_id[qid]
        if not q.answerable or sql.upper().startswith(ABSTAIN) or (q.gold_sql, sql) in seen:
            continue
        seen.add((q.gold_sql, sql))
        p = Pair("", q.gold_sql, sql, q.kinds, q.ordered, q.order_by, q.order_by)
        facts.append(f"SELECT {_q(q.gold_sql)} AS gold_sql, {_q(sql)} AS sql_text, f.* FROM ({_oracle_pair(p)}) f")
    denied = "lower({}) LIKE '%email%'" if role == "analyst" else "FALSE"
    refusal = f"AccessDenied: {REFUSED}: column shop_customers.email"
    return f"""WITH {views},
    levels(level, level_rank) AS (VALUES {levels}),
    layers(layer_rank, question_id, sql_text) AS (VALUES {layers}),
    suite(question_id, ordinal, category, answerable, q_ordered, gold_sql) AS (VALUES {suite}),
    cands AS (SELECT v.level, l.question_id, arg_max(l.sql_text, l.layer_rank) AS sql_text
              FROM levels v JOIN layers l ON l.layer_rank <= v.level_rank GROUP BY v.level, l.question_id),
    grid AS (SELECT '{run_id}' AS run_id, v.level, s.*, COALESCE(c.sql_text, {_q(DEFAULT_ABSTENTION)}) AS sql_text
             FROM levels v CROSS JOIN suite s LEFT JOIN cands c ON c.level = v.level AND c.question_id = s.question_id),
    facts AS ({" UNION ALL ".join(facts)}),
    j AS (SELECT g.*, upper(g.sql_text) LIKE '{ABSTAIN}%' AS abstained,
                 {denied.format('g.sql_text')} AS cand_denied, {denied.format('g.gold_sql')} AS gold_denied,
                 f.gold_rows, f.cand_rows, f.bag_equal, f.equal, f.ordered, f.single_cell,
                 f.gold_value, f.cand_value, f.gold_number, f.cand_number
          FROM grid g LEFT JOIN facts f ON f.gold_sql = g.gold_sql AND f.sql_text = g.sql_text),
    k AS (SELECT *, NOT cand_denied AS cand_ok, NOT gold_denied AS gold_ok,
                 CASE WHEN cand_denied THEN '{refusal}' END AS cand_error,
                 CASE WHEN gold_denied THEN '{refusal}' END AS gold_error FROM j)
    SELECT run_id, level, question_id, ordinal, category, answerable, abstained, sql_text,
           CASE WHEN NOT answerable AND abstained THEN 'CORRECT'
                WHEN NOT answerable THEN 'OVERREACHED'
                WHEN abstained THEN 'ABSTAINED'
                WHEN cand_denied THEN 'BLOCKED'
                WHEN NOT cand_ok THEN 'ERROR'
                WHEN equal THEN 'CORRECT' ELSE 'WRONG' END AS verdict,
           (answerable AND NOT abstained AND cand_ok AND NOT gold_ok) AS gold_broken,
           CASE WHEN NOT answerable AND abstained THEN '{scoring.DETAIL_REFUSED_OK}'
                WHEN NOT answerable THEN '{scoring.DETAIL_OVERREACH}'
                WHEN abstained THEN '{scoring.DETAIL_ABSTAINED}'
                WHEN cand_denied OR NOT cand_ok THEN COALESCE(cand_error, 'failed')
                WHEN equal THEN '{scoring.DETAIL_MATCH}'
                ELSE {explain_sql()} END AS detail,
           '{role}' AS role, cand_value, gold_number, cand_number
    FROM k"""


def _outcomes(spark: SparkSession, sf_dir: str, role: str = "owner") -> DataFrame:
    return scoring.layered_outcomes(spark, sf_dir, role)


_OUT_COLS = "run_id, level, question_id, category, verdict, gold_broken, detail"


@query("suite_outcomes", oracle=f"SELECT {_OUT_COLS} FROM ({outcomes_oracle('owner')}) o")
def suite_outcomes(spark, sf_dir):
    """K1 + K2 end to end on the owner role: every level, every question."""
    return _outcomes(spark, sf_dir).select(*[c.strip() for c in _OUT_COLS.split(",")])


@query("score_verdicts", oracle=f"SELECT run_id, level, question_id, verdict, detail "
                                f"FROM ({outcomes_oracle('analyst')}) o")
def score_verdicts(spark, sf_dir):
    """K1 through the governed session: the boundary turns one answer into BLOCKED."""
    return _outcomes(spark, sf_dir, "analyst").select("run_id", "level", "question_id", "verdict", "detail")


def _summary_sql(role: str) -> str:
    return f"""SELECT run_id, level, COUNT(*) AS total,
        ROUND(COUNT(*) FILTER (WHERE verdict = 'CORRECT') / COUNT(*), 6) AS accuracy,
        {", ".join(f"COUNT(*) FILTER (WHERE verdict = '{v}') AS {v.lower()}" for v in scoring.VERDICTS)}
    FROM ({outcomes_oracle(role)}) o GROUP BY run_id, level"""


@query("verdict_summary", oracle=_summary_sql("owner"))
def verdict_summary(spark, sf_dir):
    """Total, accuracy and every verdict's count per level."""
    return scoring.summarize(_outcomes(spark, sf_dir))


@query("failure_listing", oracle=f"""
    SELECT run_id, level, question_id, verdict, detail, ordinal FROM ({outcomes_oracle('owner')}) o
    WHERE verdict <> 'CORRECT' ORDER BY run_id, level, ordinal""")
def failure_listing(spark, sf_dir):
    """K4: the answers that were not correct, with why, in suite order."""
    return scoring.failures(_outcomes(spark, sf_dir))


@query("category_summary", oracle=f"""
    SELECT run_id, level, category, COUNT(*) FILTER (WHERE verdict = 'CORRECT') AS correct, COUNT(*) AS total,
           COALESCE(array_to_string(list_sort(list_distinct(list(lower(verdict)) FILTER (WHERE verdict <> 'CORRECT'))),
                    ', '), '') AS notes
    FROM ({outcomes_oracle('owner')}) o GROUP BY run_id, level, category""")
def category_summary(spark, sf_dir):
    """Per category, correct of total and the sorted other verdicts."""
    return scoring.by_category(_outcomes(spark, sf_dir))


def _progress_sql(role: str) -> str:
    levels = ", ".join(f"({_q(lv)}, {i})" for i, lv in enumerate(CANDIDATE_LAYERS))
    return f"""WITH s AS ({_summary_sql(role)}), lv(level, level_rank) AS (VALUES {levels})
    SELECT run_id, arg_min(level, level_rank) AS first_level, arg_min(accuracy, level_rank) AS first_accuracy,
           arg_max(level, level_rank) AS last_level, arg_max(accuracy, level_rank) AS last_accuracy,
           COUNT(*) AS levels, arg_max(accuracy, level_rank) > arg_min(accuracy, level_rank) AS improved
    FROM s JOIN lv USING (level) GROUP BY run_id"""


@query("level_progress", oracle=_progress_sql("owner"))
def level_progress(spark, sf_dir):
    """K6: first level against last."""
    return scoring.level_progress(scoring.summarize(_outcomes(spark, sf_dir)), levels_df(spark))


@query("gate", oracle=f"""
    SELECT run_id, last_level, last_accuracy, CAST(0.9 AS DOUBLE) AS threshold, last_accuracy >= 0.9 AS passed
    FROM ({_progress_sql('analyst')}) p""")
def gate(spark, sf_dir):
    """K7: the last level scored through the governed session, against 0.90."""
    p = scoring.level_progress(scoring.summarize(_outcomes(spark, sf_dir, "analyst")), levels_df(spark))
    return scoring.gate(p)


@query("abstention_balance", oracle=f"""
    SELECT run_id, level, answerable, COUNT(*) AS questions,
           COUNT(*) FILTER (WHERE verdict = 'ABSTAINED') AS wrongly_refused,
           COUNT(*) FILTER (WHERE verdict = 'OVERREACHED') AS wrongly_answered
    FROM ({outcomes_oracle('owner')}) o GROUP BY run_id, level, answerable""")
def abstention_balance(spark, sf_dir):
    """K8: both sides of the abstention dial, per level."""
    return scoring.abstention_balance(_outcomes(spark, sf_dir))


@query("privilege_gap", oracle=f"""
    SELECT o.level, o.question_id, o.verdict AS owner_verdict, a.verdict AS analyst_verdict,
           o.verdict <> a.verdict AS differs
    FROM ({outcomes_oracle('owner')}) o JOIN ({outcomes_oracle('analyst')}) a
      ON a.level = o.level AND a.question_id = o.question_id""")
def privilege_gap(spark, sf_dir):
    """K9: the same suite under both roles, side by side."""
    o = _outcomes(spark, sf_dir).select("level", "question_id", F.col("verdict").alias("owner_verdict"))
    a = _outcomes(spark, sf_dir, "analyst").select("level", "question_id", F.col("verdict").alias("analyst_verdict"))
    return (o.join(a, ["level", "question_id"])
            .withColumn("differs", F.col("owner_verdict") != F.col("analyst_verdict")))


@query("question_by_level", oracle=f"""
    SELECT level, verdict,
           CASE WHEN sql_text LIKE '%ordered_at%' THEN 'ordered_at'
                WHEN sql_text LIKE '%shipped_at%' THEN 'shipped_at' ELSE '?' END AS date_column,
           CAST(cand_value AS BIGINT) AS answer_cents, ROUND(cand_number / gold_number, 6) AS ratio_to_gold
    FROM ({outcomes_oracle('owner')}) o WHERE question_id = 'march_revenue'""")
def question_by_level(spark, sf_dir):
    """One definition question across levels: the date column used, the answer,
    and its ratio to the gold answer."""
    from ..sources.suite import suite_df
    suite = suite_df(spark)
    facts = (scoring.candidate_facts(suite, layered_candidates(spark))
             .where(F.col("question_id") == "march_revenue"))
    executed = scoring.FactStore.of_application(spark).update(sf_dir, facts, "owner")
    j = facts.join(executed, ["gold_sql", "sql_text", "ordered"], "left")
    return j.select("level", scoring.verdict_col().alias("verdict"),
                    date_column_used(F.col("sql_text")).alias("date_column"),
                    F.col("cand_value").cast("bigint").alias("answer_cents"),
                    F.round(F.col("cand_number") / F.col("gold_number"), 6).alias("ratio_to_gold"))


def run_candidates(spark: SparkSession, *run_ids: str) -> DataFrame:
    """The candidates of some runs, with the time of each."""
    cands = [layered_candidates(spark, r, RUNS[r]).withColumn("run_at", F.lit(RUN_TIMES[r]).cast("timestamp_ntz"))
             for r in run_ids]
    return reduce(DataFrame.unionByName, cands)


def run_history(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """A report that grew by three scorings: the first run, that run again with the next, and
    the last."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    scoring.score_table(spark, sf_dir, run_candidates(spark, "mock"), path, role)
    scoring.score_table(spark, sf_dir, run_candidates(spark, "mock", "next"), path, role)
    return scoring.score_table(spark, sf_dir, run_candidates(spark, "last"), path, role)


_RUNS_SQL = " UNION ALL ".join(
    f"SELECT TIMESTAMP '{RUN_TIMES[r]}' AS run_at, run_id, level, question_id, verdict FROM ({{{r}}}) {r}" for r in RUNS)


def _runs_sql(role: str) -> str:
    return _RUNS_SQL.format(**{r: outcomes_oracle(role, r) for r in RUNS})


@query("scored_runs", oracle=f"""
    SELECT run_id, level, COUNT(*) AS outcomes, COUNT(DISTINCT question_id) AS questions,
           COUNT(*) FILTER (WHERE verdict = 'CORRECT') AS correct
    FROM ({_runs_sql('owner')}) o GROUP BY run_id, level""")
def scored_runs(spark, sf_dir):
    """K2 + A10: a report over several runs, one of them scored twice: every run holds each
    question once per level."""
    return run_history(spark, sf_dir, "owner").groupBy("run_id", "level").agg(
        F.count(F.lit(1)).alias("outcomes"), F.countDistinct("question_id").alias("questions"),
        F.count_if(F.col("verdict") == "CORRECT").alias("correct"))


@query("blocked_trend", oracle=f"""
    WITH s AS (SELECT run_at, run_id, level, COUNT(*) AS total, COUNT(*) FILTER (WHERE verdict = 'BLOCKED') AS blocked
               FROM ({_runs_sql('analyst')}) o GROUP BY ALL)
    SELECT run_id, level, blocked, ROUND(blocked / total, 6) AS blocked_rate,
           blocked - LAG(blocked) OVER (PARTITION BY level ORDER BY run_at) AS change FROM s""")
def blocked_trend(spark, sf_dir):
    """The BLOCKED count of each level over the runs of a report, in the order of their
    times, with its change from the run before."""
    return scoring.blocked_by_run(run_history(spark, sf_dir, "analyst").where("role = 'analyst'"))


# Statements a run may hold besides answers, and how each question then ends.
HOSTILE = {"bare": {
    "total_revenue": "WITH j AS (SELECT o.total_cents FROM shop_orders o JOIN shop_order_items i ON i.order_id = o.id "
                     "WHERE o.status = 'completed') SELECT SUM(total_cents) FROM j",
    "revenue_by_country": CANDIDATE_LAYERS["bare"]["revenue_by_country"],
    "march_revenue": "DROP VIEW shop_orders",
    "net_revenue": "SET spark.sql.ansi.enabled = false",
    "avg_order_value": "SELECT AVG(total_cents / (id - id)) FROM shop_orders",
    "nation_customers": "INSERT INTO shop_customers SELECT * FROM shop_customers",
    "pending_orders": CANDIDATE_LAYERS["bare"]["pending_orders"],
    "customer_emails": "CREATE OR REPLACE TEMP VIEW shop_customers AS SELECT 1 AS email",
}}
_HOSTILE_ENDS = {"total_revenue": "WRONG", "revenue_by_country": "CORRECT", "march_revenue": "ERROR", "net_revenue": "ERROR",
                 "avg_order_value": "ERROR", "nation_customers": "ERROR", "pending_orders": "CORRECT",
                 "customer_emails": "ERROR", "top_products": "ABSTAINED"}


@query("isolated_outcomes", oracle=f"""
    SELECT question_id, verdict, FALSE AS gold_broken, question_id = 'total_revenue' AS fanout_suspected
    FROM (VALUES {", ".join(f"({_q(q.question_id)}, {_q(_HOSTILE_ENDS.get(q.question_id, 'CORRECT'))})" for q in QUESTIONS)})
         t(question_id, verdict)""")
def isolated_outcomes(spark, sf_dir):
    """K1/K2 with commands, a failing statement and a WITH body among the candidates: each
    is judged alone, no other verdict moves and no trusted query breaks."""
    cands = layered_candidates(spark, "hostile", HOSTILE)
    return scoring.score(spark, sf_dir, cands).select("question_id", "verdict", "gold_broken", "fanout_suspected")


@query("similarity_inversions", oracle=f"""
    WITH o AS (SELECT * FROM ({outcomes_oracle('owner')}) x WHERE verdict IN ('CORRECT', 'WRONG')
               AND NOT abstained AND answerable),
         g AS (SELECT question_id, gold_sql FROM (VALUES {", ".join(f"({_q(q.question_id)}, {_q(q.gold_sql)})" for q in QUESTIONS if q.answerable)}) t(question_id, gold_sql)),
         s AS (SELECT o.question_id, o.verdict, {token_dice_sql('o.sql_text', 'g.gold_sql')} AS similarity
               FROM o JOIN g USING (question_id))
    SELECT question_id, MAX(similarity) FILTER (WHERE verdict = 'WRONG') AS best_wrong_similarity,
           MIN(similarity) FILTER (WHERE verdict = 'CORRECT') AS worst_correct_similarity,
           MAX(similarity) FILTER (WHERE verdict = 'WRONG') > MIN(similarity) FILTER (WHERE verdict = 'CORRECT')
             AS inverted
    FROM s GROUP BY question_id""")
def similarity_inversions(spark, sf_dir):
    """Per question, is some wrong answer textually closer to the gold query than
    some correct one? Compared as the best wrong against the worst correct, so no
    pairs are formed."""
    from ..functions.text import token_dice
    o = _outcomes(spark, sf_dir).where(F.col("verdict").isin("CORRECT", "WRONG") & ~F.col("abstained")
                                       & F.col("answerable"))
    gold = spark.createDataFrame([(q.question_id, q.gold_sql) for q in QUESTIONS if q.answerable],
                                 "question_id string, gold_sql string")
    s = o.join(gold, "question_id").select(
        "question_id", "verdict", token_dice(F.col("sql_text"), F.col("gold_sql")).alias("similarity"))
    best_wrong = F.max(F.when(F.col("verdict") == "WRONG", F.col("similarity")))
    worst_right = F.min(F.when(F.col("verdict") == "CORRECT", F.col("similarity")))
    return s.groupBy("question_id").agg(best_wrong.alias("best_wrong_similarity"),
                                        worst_right.alias("worst_correct_similarity"),
                                        (best_wrong > worst_right).alias("inverted"))
