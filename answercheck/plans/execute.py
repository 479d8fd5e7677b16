"""Run SQL text and keep whatever happens as data.

A query that fails to parse, names a missing table, or trips an ANSI check at run
time is an outcome to record, not an exception. Analysis errors surface when
``spark.sql`` is called; run-time errors only at an action, and may arrive wrapped
as ``Py4JJavaError``. Both become a ``QueryOutcome`` with an error condition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

MAX_ROWS = 1000   # fixed value: the display cap of the reference


@dataclass
class QueryOutcome:
    sql: str
    df: DataFrame | None = None
    error: str | None = None
    condition: str | None = None
    denied: bool = False          # refused by a governed session, not broken

    @property
    def ok(self) -> bool:
        return self.error is None


def error_facts(exc: BaseException) -> tuple[str, str]:
    """(condition, message) for any error Spark can raise through Python."""
    condition = None
    if isinstance(exc, PySparkException):
        try:
            condition = exc.getCondition()
        except Exception:  # noqa: BLE001
            condition = None
    name = type(exc).__name__
    message = str(exc).strip().splitlines()[0] if str(exc).strip() else name
    if condition is None:
        # Errors wrapped at action time still carry their condition in the text.
        import re
        found = re.search(r"\[([A-Z][A-Z0-9_]+(?:\.[A-Z0-9_]+)*)\]", str(exc))
        condition = found.group(1) if found else None
    if condition is None:
        # Py4J wraps JVM errors that escape at action time: keep the JVM class name.
        java = getattr(exc, "java_exception", None)
        if java is not None:
            try:
                condition = java.getClass().getSimpleName()
            except Exception:  # noqa: BLE001
                condition = name
        else:
            condition = name
    return condition, f"{name}: {message}"


# Parsed-plan nodes a read-only query may consist of.
ALLOWED_PARSED = frozenset({
    "Project", "Filter", "Aggregate", "Join", "Sort", "GlobalLimit", "LocalLimit", "Offset",
    "SubqueryAlias", "Union", "Intersect", "Except", "Distinct", "Deduplicate", "UnresolvedWith",
    "UnresolvedRelation", "UnresolvedInlineTable", "LocalRelation", "OneRowRelation",
    "UnresolvedHaving", "Generate", "Sample", "UnresolvedSubqueryColumnAliases", "WithWindowDefinition",
    "UnresolvedTableValuedFunction", "Pivot", "Unpivot", "RepartitionByExpression", "Window",
    "LateralJoin", "UnresolvedTVFAliases", "Tail", "CTERelationRef", "PipeOperator", "UnresolvedHint",
})


class NotAQuery(Exception):
    """A statement that is not a read-only query."""

    condition = "NOT_A_QUERY"


def seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def node_name(node) -> str:
    return node.getClass().getSimpleName()


def parsed_nodes(session: SparkSession, sql: str):
    """Every node of the parsed plan, subqueries included. Refuses at the first one that a
    read-only query does not consist of: Spark runs commands as soon as it gets them, so
    this has to come before ``session.sql``."""
    stack = [session._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while stack:
        node = stack.pop()
        kind = node_name(node)
        if kind not in ALLOWED_PARSED:
            raise NotAQuery(f"{kind} is not part of a read-only query")
        yield node
        stack.extend(seq(node.children()))
        stack.extend(seq(node.innerChildren()))
        stack.extend(seq(node.subqueries()))


def run_sql(spark: SparkSession, sql: str) -> QueryOutcome:
    """Analyse SQL text; never raises, and never executes a command: statements of one
    session cannot change what the next one sees. The returned DataFrame is lazy."""
    try:
        for _ in parsed_nodes(spark, sql):
            pass
        return QueryOutcome(sql, df=spark.sql(sql))
    except NotAQuery as exc:
        return QueryOutcome(sql, error=f"NotAQuery: {exc}", condition=exc.condition)
    except Exception as exc:  # noqa: BLE001  everything is an outcome here
        condition, message = error_facts(exc)
        return QueryOutcome(sql, error=message, condition=condition)


def scalar(df: DataFrame):
    """The single value of a 1x1 result, else None. Reads at most two rows."""
    if len(df.columns) != 1:
        return None
    rows = df.limit(2).collect()
    return rows[0][0] if len(rows) == 1 else None


def capped(df: DataFrame, max_rows: int = MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """(preview of at most ``max_rows`` rows, one-row truncation flag).

    The cap is for display only; comparisons always use the whole result."""
    preview = df.limit(max_rows)
    flag = df.limit(max_rows + 1).groupBy().count().selectExpr(f"count > {max_rows} AS truncated")
    return preview, flag


def has_global_sort(df: DataFrame) -> bool:
    """Does the analyzed plan order its output? A Sort may sit under a limit or an
    outer projection; a result without one has no defined order in Spark."""
    node = df._jdf.queryExecution().analyzed()
    while True:
        name = node.nodeName()
        if name == "Sort":
            return bool(getattr(node, "global")())   # Sort.global: a total order, not per partition
        if name in ("GlobalLimit", "LocalLimit", "Project", "SubqueryAlias", "Offset", "Filter"):
            node = node.children().apply(0)
            continue
        return False
