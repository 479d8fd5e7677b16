"""Session construction and the shared checkpoint folder.

Everything in the library takes a ``SparkSession`` from the caller; this module only
builds one for tests, the bench and the command line, with the settings the library
relies on (UTC session time zone so dates agree with DuckDB, AQE on, no UI).
"""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "answercheck") -> SparkSession:
    master = master or os.environ.get("ANSWERCHECK_MASTER", "local[8]")
    cores = _cores(master)
    parts = shuffle_partitions or max(cores * 2, 8)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ANSWERCHECK_DRIVER_MEMORY", "16g"))
        # Untrusted SQL must not reach files past the governed views (see plans.governed).
        .config("spark.sql.runSQLOnFiles", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("FATAL")
    ensure_checkpoint_dir(spark)
    return spark


def _cores(master: str) -> int:
    inside = master[master.find("[") + 1: master.find("]")] if "[" in master else "1"
    if inside == "*":
        return os.cpu_count() or 8
    try:
        return int(inside.split(",")[0])
    except ValueError:
        return 8


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taken from ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster's own
    configuration; a missing setting there is an error. Only a local master (tests,
    the bench) gets a private scratch folder when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
        configured = tempfile.mkdtemp(prefix="answercheck-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


class SharedTables:
    """Tables written to the shared checkpoint folder and deleted on leaving the block.
    Unlike checkpoint() they are columns in Parquet, and nothing of them stays behind."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
        self.numbers = itertools.count(1)   # tables may be put from several threads

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{next(self.numbers)}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "SharedTables":
        return self

    def __exit__(self, *exc) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
