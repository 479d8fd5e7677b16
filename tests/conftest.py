"""Shared fixtures: one local Spark session, and the reference's 29-row shop fixture
retyped as DataFrames (dates as DATE), served as the shop views to an owner session
and to a governed analyst session."""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from answercheck.plans.execute import run_sql  # noqa: E402
from answercheck.plans.governed import GovernedSession  # noqa: E402
from answercheck.sources.suite import build_layers, build_questions  # noqa: E402

D = dt.date.fromisoformat

# The reference fixture (customers, orders, order_items, refunds).
CUSTOMERS = [
    (1, "Ada Okafor", "Nigeria", "ada@example.com", D("2024-11-02")),
    (2, "Bruno Salgado", "Brazil", "bruno@example.com", D("2024-12-14")),
    (3, "Chen Wei", "Singapore", "chen@example.com", D("2025-01-08")),
    (4, "Dara Nilsson", "Sweden", "dara@example.com", D("2025-01-21")),
    (5, "Emeka Balogun", "Nigeria", "emeka@example.com", D("2025-02-03")),
]
ORDERS = [
    (1001, 1, "completed", D("2025-03-04"), D("2025-03-06"), 49999),
    (1002, 2, "completed", D("2025-03-11"), D("2025-03-13"), 64999),
    (1003, 3, "completed", D("2025-03-15"), D("2025-03-17"), 52999),
    (1004, 4, "completed", D("2025-03-31"), D("2025-04-01"), 45000),
    (1005, 1, "completed", D("2025-03-22"), D("2025-03-25"), 38999),
    (1006, 5, "completed", D("2025-04-02"), D("2025-04-04"), 29999),
    (1007, 2, "cancelled", D("2025-03-19"), None, 89999),
    (1008, 3, "completed", D("2025-04-09"), D("2025-04-11"), 15999),
    (1009, 4, "pending", D("2025-04-28"), None, 72999),
]
ORDER_ITEMS = [
    (1, 1001, "Standing desk", 1, 49999),
    (2, 1002, "Mechanical keyboard", 1, 14999),
    (3, 1002, "27-inch monitor", 1, 39999),
    (4, 1002, "Monitor arm", 1, 10001),
    (5, 1003, "Ergonomic chair", 1, 52999),
    (6, 1004, "Desk lamp", 2, 9000),
    (7, 1004, "Cable tray", 1, 27000),
    (8, 1005, "Laptop stand", 1, 12999),
    (9, 1005, "Docking station", 1, 26000),
    (10, 1006, "Webcam", 1, 29999),
    (11, 1007, "Conference speaker", 1, 89999),
    (12, 1008, "USB-C hub", 1, 15999),
    (13, 1009, "Standing desk", 1, 72999),
]
REFUNDS = [
    (1, 1003, 52999, D("2025-03-24")),
    (2, 1005, 29998, D("2025-04-02")),
]
SCHEMAS = {
    "shop_customers": ("id long, name string, country string, email string, created_at date", CUSTOMERS),
    "shop_orders": ("id long, customer_id long, status string, ordered_at date, shipped_at date, "
                    "total_cents long", ORDERS),
    "shop_order_items": ("id long, order_id long, product string, qty long, unit_cents long", ORDER_ITEMS),
    "shop_refunds": ("id long, order_id long, amount_cents long, refunded_at date", REFUNDS),
}
FIXTURE_QUESTIONS = build_questions("2025-03-01", "2025-04-01", "Nigeria", "March 2025")
FIXTURE_LAYERS = build_layers("2025-03-01", "2025-04-01", "Nigeria")
BY_ID = {q.question_id: q for q in FIXTURE_QUESTIONS}
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("answercheck-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="answercheck-test-ckpt-", dir="/tmp"))
         .getOrCreate())
    s.sparkContext.setLogLevel("FATAL")
    from answercheck.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s


def fixture_views(session) -> list[str]:
    """Register the fixture as the four shop views of ``session``."""
    for name, (schema, rows) in SCHEMAS.items():
        session.createDataFrame(rows, schema).createOrReplaceTempView(name)
    return list(SCHEMAS)


@pytest.fixture(scope="session")
def owner(spark):
    """(session, run) with unrestricted access to the fixture."""
    s = spark.newSession()
    fixture_views(s)
    return s, (lambda text: run_sql(s, text))


@pytest.fixture(scope="session")
def analyst(spark):
    g = GovernedSession(spark, views=fixture_views)
    return g
