"""Score candidate SQL against trusted SQL, at scale in the data (group K).

Outcomes: CORRECT, WRONG, ERROR, ABSTAINED, OVERREACHED, BLOCKED. The order of tests
is the reference's: an unanswerable question is judged on abstention alone, without
running anything; then abstention; then a refused candidate (BLOCKED); then a failed
one (ERROR); then row equality. A broken gold query with a working candidate is WRONG,
flagged ``gold_broken``.

Shape of the job: candidates and suite are tables. Every *distinct* (gold, candidate)
text pair is compared once per role and state of the data, whoever asks: the facts of a
comparison lie in a table keyed by a hash of all that (``FactStore``), a scoring compares
only the pairs the table lacks, a batch in one Spark job, and the verdict on every
candidate is a ``when`` chain over a join with it. Scoring a run again replaces its
outcomes and compares nothing twice.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.governed import GovernedSession
from ..session import SharedTables, ensure_checkpoint_dir
from ..sources.suite import ABSTAIN, QUESTIONS, fill_candidates, layered_candidates, suite_df
from ..sources.tables import TABLE_NAMES, sql_session
from .diff_queries import FACT_SCHEMA, compare_sql_many
from .explain import explain_col

# The verdicts, in report order, and their fixed details.
CORRECT, WRONG, ERROR, ABSTAINED, OVERREACHED, BLOCKED = (
    "CORRECT", "WRONG", "ERROR", "ABSTAINED", "OVERREACHED", "BLOCKED")
VERDICTS = (CORRECT, WRONG, ERROR, ABSTAINED, OVERREACHED, BLOCKED)
DETAIL_REFUSED_OK = "no answer exists and none was given"
DETAIL_OVERREACH = "an answer was given where the tables hold none"
DETAIL_ABSTAINED = "no answer was given although the tables hold one"
DETAIL_MATCH = "same rows as the trusted query"


def abstained(sql_text: Column) -> Column:
    """H8 / O2: the candidate declined (prefix test on the upper-cased text)."""
    return F.upper(sql_text).startswith(ABSTAIN)


def candidate_facts(suite: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every (run, level, question) with its gold SQL and the static facts. A run's time
    (``run_at``) is the latest of its candidates', NULL where they carry none."""
    filled = fill_candidates(suite, candidates).join(suite, "question_id")
    if "run_at" in candidates.columns:
        times = candidates.groupBy("run_id").agg(F.max("run_at").cast("timestamp_ntz").alias("run_at"))
        filled = filled.join(times, "run_id")
    else:
        filled = filled.withColumn("run_at", F.lit(None).cast("timestamp_ntz"))
    return filled.withColumn("abstained", abstained(F.col("sql_text")))


def _runner(spark: SparkSession, sf_dir: str, role: str):
    if role == "owner":
        s = sql_session(spark, sf_dir)
        from ..plans.execute import run_sql
        return s, (lambda text: run_sql(s, text))
    if role == "analyst":
        g = GovernedSession(spark, sf_dir)
        return g.session, g.run
    raise ValueError(f"unknown role {role}")


FACTS = T.StructType(FACT_SCHEMA.fields + [T.StructField("gold_sql", T.StringType()),
                                           T.StructField("sql_text", T.StringType())])
STORED = T.StructType(FACTS.fields + [T.StructField("fact_id", T.StringType()), T.StructField("batch", T.StringType())])
# Comparisons run and written at a time.
BATCH = 64


def execution_facts(spark: SparkSession, sf_dir: str, pairs: list[tuple[str, str, bool]],
                    role: str = "owner", runner=None) -> DataFrame:
    """One fact row per distinct (gold_sql, sql_text, ordered), all compared in one
    Spark job. ``runner`` is a (session, run) pair; by default built for ``role``
    over the tables at ``sf_dir``."""
    session, run = runner or _runner(spark, sf_dir, role)
    specs = [(str(i), gold, cand, ordered) for i, (gold, cand, ordered) in enumerate(pairs)]
    rows = compare_sql_many(session, specs, runner=run, audit_joins=True)
    for r, (gold, cand, _) in zip(rows, pairs):
        r.update(gold_sql=gold, sql_text=cand)
    return spark.createDataFrame([{k: r.get(k) for k in FACTS.fieldNames()} for r in rows], FACTS)


def verdict_col() -> Column:
    c = F.col
    return (F.when(~c("answerable") & c("abstained"), F.lit(CORRECT))
            .when(~c("answerable"), F.lit(OVERREACHED))
            .when(c("abstained"), F.lit(ABSTAINED))
            .when(c("cand_denied"), F.lit(BLOCKED))
            .when(~c("cand_ok"), F.lit(ERROR))
            .when(c("equal"), F.lit(CORRECT))
            .otherwise(F.lit(WRONG)))


def detail_col() -> Column:
    c = F.col
    return (F.when(~c("answerable") & c("abstained"), F.lit(DETAIL_REFUSED_OK))
            .when(~c("answerable"), F.lit(DETAIL_OVERREACH))
            .when(c("abstained"), F.lit(DETAIL_ABSTAINED))
            .when(c("cand_denied") | ~c("cand_ok"), F.coalesce(c("cand_error"), F.lit("failed")))
            .when(c("equal"), F.lit(DETAIL_MATCH))
            .otherwise(explain_col()))


def data_version(spark: SparkSession, sf_dir: str) -> str:
    """Names what the tables hold now: number, bytes and time of each one's files."""
    if not sf_dir:
        return ""
    conf, parts = spark._jsc.hadoopConfiguration(), [sf_dir.rstrip("/")]
    for name in TABLE_NAMES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            held = fs.getContentSummary(path)
            parts.append(f"{name}:{held.getFileCount()}:{held.getLength()}:{fs.getFileStatus(path).getModificationTime()}")
    return "|".join(parts)


class FactStore:
    """Facts about comparisons, written once each under ``path``.

    A fact's key is a hash of role, gold text, candidate text, ordered and the state of the
    data. ``update`` compares the pairs that have none yet. Each batch is a partition of its
    own, named by the keys in it: a batch that is written again, say after a failure,
    replaces itself, so no fact is ever there twice."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def of_application(cls, spark: SparkSession) -> "FactStore":
        """The store that all scorings of this application share, in the shared folder."""
        return cls(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/facts-{spark.sparkContext.applicationId}")

    @classmethod
    def private(cls, spark: SparkSession) -> "FactStore":
        return cls(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/facts-{uuid.uuid4().hex}")

    def read(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(self.path)

    @staticmethod
    def key(role: str, version: str) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(role), F.sha2(F.lit(version), 256), F.sha2("gold_sql", 256),
                                  F.sha2("sql_text", 256), F.col("ordered").cast("string")), 256)

    def update(self, sf_dir: str, asked: DataFrame, role: str, runner=None, batch: int = BATCH) -> DataFrame:
        """Facts for every (gold_sql, sql_text, ordered) of ``asked``; the new ones stream to
        the driver a batch at a time, those of one gold query together."""
        version = data_version(self.spark, sf_dir)
        asked = asked.select("gold_sql", "sql_text", "ordered").distinct().withColumn("fact_id", self.key(role, version))
        with SharedTables(self.spark) as tables:
            new = tables.put(asked.join(self.read().select("fact_id"), "fact_id", "left_anti"))
            rows = new.orderBy("gold_sql", "sql_text").toLocalIterator()
            for part in _batches(rows, batch):
                runner = runner or _runner(self.spark, sf_dir, role)
                self._write(part, execution_facts(self.spark, sf_dir, [(r.gold_sql, r.sql_text, r.ordered) for r in part],
                                                  role, runner))
        return self.read().join(asked.select("fact_id"), "fact_id", "left_semi").drop("fact_id", "batch")

    def _write(self, part: list, facts: DataFrame) -> None:
        names = self.spark.createDataFrame([(str(i), r.fact_id) for i, r in enumerate(part)], "pair_id string, fact_id string")
        batch = hashlib.sha256("".join(sorted(r.fact_id for r in part)).encode()).hexdigest()[:32]
        (facts.join(F.broadcast(names), "pair_id").withColumn("batch", F.lit(batch)).select(*STORED.fieldNames())
         .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path))


def _batches(rows: Iterator, size: int) -> Iterator[list]:
    held: list = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _runnable(facts: DataFrame) -> DataFrame:
    """The comparisons that have to be run."""
    return facts.where(F.col("answerable") & ~F.col("abstained")).select("gold_sql", "sql_text", "ordered")


def outcomes_of(facts: DataFrame, executed: DataFrame, role: str) -> DataFrame:
    """The verdict on every (run, level, question) from the facts about its comparison."""
    joined = facts.join(executed, ["gold_sql", "sql_text", "ordered"], "left")
    return joined.select(
        "run_id", "run_at", "level", "question_id", "ordinal", "category", "answerable", "abstained", "sql_text",
        verdict_col().alias("verdict"),
        (F.col("answerable") & ~F.col("abstained") & F.coalesce(F.col("cand_ok"), F.lit(False))
         & (F.col("gold_ok") == F.lit(False))).alias("gold_broken"),
        detail_col().alias("detail"),
        F.col("cand_unsorted"),
        (F.coalesce(F.col("fanout_joins"), F.lit(0)) > 0).alias("fanout_suspected"),
        F.col("fanout_factor"),
        F.lit(role).alias("role"),
    )


def score(spark: SparkSession, sf_dir: str, candidates: DataFrame, role: str = "owner",
          questions=QUESTIONS, runner=None, store: FactStore | None = None, batch: int = BATCH) -> DataFrame:
    """Outcomes, one row per (run, level, question), of a candidate table of any size. Facts
    come from ``store``: by default the application's, or one of its own for a ``runner`` of
    the caller's, whose tables no key can name."""
    store = store or (FactStore.private(spark) if runner else FactStore.of_application(spark))
    facts = candidate_facts(suite_df(spark, questions), candidates)
    return outcomes_of(facts, store.update(sf_dir, _runnable(facts), role, runner, batch), role)


def score_table(spark: SparkSession, sf_dir: str, candidates: DataFrame, path: str, role: str = "owner",
                questions=QUESTIONS, runner=None, batch: int = BATCH) -> DataFrame:
    """Score candidates into the report under ``path`` (A10): its facts serve every later
    scoring into it, and the outcomes of the scored runs replace what the report held of
    them under this role. Returns the whole report as written."""
    outcomes = score(spark, sf_dir, candidates, role, questions, runner, FactStore(spark, f"{path}/facts"), batch)
    write_outcomes(outcomes, f"{path}/outcomes")
    return read_outcomes(spark, f"{path}/outcomes")


def layered_outcomes(spark: SparkSession, sf_dir: str, role: str = "owner", questions=QUESTIONS,
                  layers=None, runner=None) -> DataFrame:
    """The suite scored with the layered candidates at every level."""
    cands = layered_candidates(spark, layers=layers) if layers else layered_candidates(spark)
    return score(spark, sf_dir, cands, role, questions, runner)


# --- reports (K3-K8, T3) ---------------------------------------------------------------------

def summarize(outcomes: DataFrame) -> DataFrame:
    """K3: per (run, level): total, accuracy, and a count for every verdict, zeros
    included."""
    v = F.col("verdict")
    return outcomes.groupBy("run_id", "level").agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.count_if(v == CORRECT) / F.count(F.lit(1)), 6).alias("accuracy"),
        *[F.count_if(v == x).alias(x.lower()) for x in VERDICTS])


def failures(outcomes: DataFrame) -> DataFrame:
    """K4: everything not CORRECT, in suite order."""
    return (outcomes.where(F.col("verdict") != CORRECT)
            .select("run_id", "level", "question_id", "verdict", "detail", "ordinal")
            .orderBy("run_id", "level", "ordinal"))


def by_category(outcomes: DataFrame) -> DataFrame:
    """K5: correct of total per category, and the sorted other verdicts."""
    v = F.col("verdict")
    return outcomes.groupBy("run_id", "level", "category").agg(
        F.count_if(v == CORRECT).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.array_join(F.array_sort(F.collect_set(F.when(v != CORRECT, F.lower(v)))), ", ").alias("notes"))


def level_progress(summary: DataFrame, levels_df: DataFrame) -> DataFrame:
    """K6: first against last level of each run, by level order."""
    s = summary.join(levels_df, "level")
    return s.groupBy("run_id").agg(
        F.min_by("level", "level_rank").alias("first_level"),
        F.min_by("accuracy", "level_rank").alias("first_accuracy"),
        F.max_by("level", "level_rank").alias("last_level"),
        F.max_by("accuracy", "level_rank").alias("last_accuracy"),
        F.count(F.lit(1)).alias("levels"),
    ).withColumn("improved", F.col("last_accuracy") > F.col("first_accuracy"))


def gate(progress: DataFrame, threshold: float = 0.90) -> DataFrame:
    """K7: the last level's accuracy against a threshold (0.90 by default)."""
    return progress.select("run_id", "last_level", "last_accuracy", F.lit(threshold).alias("threshold"),
                           (F.col("last_accuracy") >= F.lit(threshold)).alias("passed"))


def abstention_balance(outcomes: DataFrame) -> DataFrame:
    """K8: both sides of the dial: answerable but refused, unanswerable but answered."""
    v = F.col("verdict")
    return outcomes.groupBy("run_id", "level", "answerable").agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if(v == ABSTAINED).alias("wrongly_refused"),
        F.count_if(v == OVERREACHED).alias("wrongly_answered"))


OUTCOMES = T.StructType([T.StructField(n, t) for n, t in [
    ("run_at", T.TimestampNTZType()), ("level", T.StringType()), ("question_id", T.StringType()), ("ordinal", T.IntegerType()),
    ("category", T.StringType()), ("answerable", T.BooleanType()), ("abstained", T.BooleanType()), ("sql_text", T.StringType()),
    ("verdict", T.StringType()), ("gold_broken", T.BooleanType()), ("detail", T.StringType()),
    ("cand_unsorted", T.BooleanType()), ("fanout_suspected", T.BooleanType()), ("fanout_factor", T.DoubleType()),
    ("role", T.StringType()), ("run_id", T.StringType())]])


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """A10: the report as a table, partitioned by run and role; scoring a run again replaces
    its partition under that role and no other."""
    (outcomes.select(*OUTCOMES.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "role").parquet(path))


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The report; filters on role and run_id read only their partitions."""
    return spark.read.schema(OUTCOMES).parquet(path)


def blocked_by_run(outcomes: DataFrame) -> DataFrame:
    """The BLOCKED count of each level over successive runs, in the order of their times,
    with its change from the run before."""
    from pyspark.sql import Window
    per_run = outcomes.groupBy("run_id", "level").agg(
        F.max("run_at").alias("run_at"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("verdict") == BLOCKED).alias("blocked"))
    before = Window.partitionBy("level").orderBy("run_at", "run_id")
    return per_run.select("run_id", "level", "blocked", F.round(F.col("blocked") / F.col("total"), 6).alias("blocked_rate"),
                          (F.col("blocked") - F.lag("blocked").over(before)).alias("change"))
