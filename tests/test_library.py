"""Library pieces without a registered query: suite, layering, fill, prompts, sink,
text helpers, the capped fetch and the plan check for a missing sort."""

from __future__ import annotations


from pyspark.sql import functions as F

from answercheck.functions import text as T
from answercheck.operators import scoring
from answercheck.operators.prompts import prompt_dataset, schema_ddl
from answercheck.plans.execute import capped, has_global_sort, scalar
from answercheck.sources.suite import (DEFAULT_ABSTENTION, fill_candidates, layered_candidates, levels_df,
                                       suite_df, suite_profile)

from .conftest import FIXTURE_LAYERS, FIXTURE_QUESTIONS


def test_suite_profile(spark):
    prof = {(r.category, r.answerable): r.questions for r in suite_profile(suite_df(spark)).collect()}
    assert prof[("abstention", False)] == 3 and prof[("aggregate", True)] == 2
    assert sum(prof.values()) == 12


def test_layers_inherit_and_override(spark):
    c = {(r.level, r.question_id): r.sql_text for r in layered_candidates(spark, layers=FIXTURE_LAYERS).collect()}
    assert len(c) == 36
    assert c[("annotated", "revenue_by_country")] == c[("bare", "revenue_by_country")]
    assert c[("annotated", "best_channel")].startswith("CANNOT ANSWER")
    assert c[("defined", "best_channel")] == c[("annotated", "best_channel")]
    assert "ordered_at" in c[("defined", "march_revenue")] and "shipped_at" in c[("annotated", "march_revenue")]


def test_fill_gives_every_question_a_row(spark):
    cands = spark.createDataFrame([("r", "l", "total_revenue", "SELECT 1")],
                                  "run_id string, level string, question_id string, sql_text string")
    got = {r.question_id: r.sql_text for r in fill_candidates(suite_df(spark), cands).collect()}
    assert len(got) == 12 and got["total_revenue"] == "SELECT 1" and got["best_channel"] == DEFAULT_ABSTENTION


def test_prompt_dataset_grows_by_level(spark, owner):
    s, _ = owner
    ddl = schema_ddl(s, ["shop_customers", "shop_orders"])
    p = prompt_dataset(spark, suite_df(spark, FIXTURE_QUESTIONS), levels_df(spark), ddl)
    rows = {(r.question_id, r.level): r for r in p.collect()}
    assert len(rows) == 36
    g = [rows[("total_revenue", lv)].growth_chars for lv in ("bare", "annotated", "defined")]
    assert g[0] == 0 < g[1] < g[2]
    assert "CREATE TABLE shop_orders" in rows[("total_revenue", "bare")].system_prompt
    assert "CANNOT ANSWER" not in rows[("total_revenue", "bare")].system_prompt


def test_outcomes_sink_partitions_by_run(spark, owner, tmp_path):
    cands = spark.createDataFrame([("r1", "x", "pending_orders", "SELECT COUNT(*) FROM shop_orders "
                                   "WHERE status = 'pending'")],
                                  "run_id string, level string, question_id string, sql_text string")
    out = scoring.score(spark, "", cands, "owner", FIXTURE_QUESTIONS, runner=owner)
    path = str(tmp_path / "outcomes")
    scoring.write_outcomes(out, path)
    back = spark.read.parquet(path)
    assert back.where("run_id = 'r1'").count() == 12
    assert (tmp_path / "outcomes" / "run_id=r1").exists()


def test_text_helpers(spark):
    df = spark.createDataFrame([("```sql\nSELECT 1\n```", "  a\t b\n　c  ", "cents")],
                               "t string, w string, x string")
    r = df.select(T.strip_fences(F.col("t")).alias("f"), T.squash(F.col("w")).alias("s"),
                  T.usd(F.lit(297994)).alias("u"), T.usd(F.lit(-500)).alias("n"),
                  T.date_column_used(F.lit("x shipped_at y")).alias("d"),
                  T.abstained(F.lit("cannot answer: no")).alias("a")).first()
    assert r.f == "SELECT 1" and r.s == "a b c" and r.u == "$2,979.94" and r.n == "$-5.00"
    assert r.d == "shipped_at" and r.a


def test_text_closeness_misleads(spark):
    gold = "SELECT SUM(total_cents) FROM orders WHERE status = 'completed'"
    cands = ["SELECT SUM(total_cents) FROM orders",
             "SELECT SUM(o.total_cents) FROM orders AS o WHERE NOT (o.status = 'cancelled' OR o.status = 'pending')"]
    df = spark.createDataFrame([(gold, c) for c in cands], "g string, c string")
    missing, equivalent = [r[0] for r in df.select(T.token_dice(F.col("g"), F.col("c"))).collect()]
    assert 0 < equivalent < missing < 1  # the wrong statement is the closer text


def test_scalar_capped_and_sort_detection(spark):
    df = spark.range(5000).toDF("a")
    assert scalar(df.agg(F.sum("a"))) == sum(range(5000))
    assert scalar(df) is None
    preview, flag = capped(df.orderBy("a"))
    assert preview.count() == 1000 and flag.first().truncated
    assert has_global_sort(df.orderBy("a").limit(3)) and not has_global_sort(df.limit(3))


def test_ddl_export_and_catalog(spark):
    from answercheck.plans.catalog import catalog, ddl
    from .conftest import SF001
    d = {r.table_name: r.ddl for r in ddl(catalog(spark, SF001)).collect()}
    assert d["nation"] == "CREATE TABLE nation (n_nationkey INT, n_name STRING, n_regionkey INT)"
    assert len(d) == 14
