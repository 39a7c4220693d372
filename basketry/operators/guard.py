"""Ad-hoc SELECTs over the gold tables, checked before they run.

Spark parses the text; the parsed plan is inspected before anything is analysed
or executed, since `spark.sql` runs commands at once.  What passes is a plain SELECT, whose
joins are then looked at with their names resolved.  It runs as an ordinary Spark
query, capped at `max_rows`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from basketry.schema import GOLD_TABLES

MAX_ROWS = 100

# Parsed-plan nodes a plain SELECT is made of.  All else is refused: commands,
# writes, scripts, hints, samples, table functions, lateral views and joins.
_SELECT_ROOTS = {
    "Aggregate",
    "Distinct",
    "Filter",
    "GlobalLimit",
    "LocalLimit",
    "Offset",
    "Project",
    "Sort",
    "UnresolvedHaving",
    "UnresolvedWith",
    "WithWindowDefinition",
}
_SET_OPERATIONS = {"Except", "Intersect", "Union"}
_SOURCES = {
    "Join",
    "OneRowRelation",
    "SubqueryAlias",
    "UnresolvedInlineTable",
    "UnresolvedRelation",
    "UnresolvedSubqueryColumnAliases",
}
_ALLOWED_NODES = _SELECT_ROOTS | _SET_OPERATIONS | _SOURCES

# Nodes that only wrap the SELECT whose kind decides rule G2.
_WRAPPERS = {"Distinct", "GlobalLimit", "LocalLimit", "Offset", "Sort", "UnresolvedWith"}

# Built-in functions that call arbitrary JVM code.
_DENIED_FUNCTIONS = {"java_method", "reflect", "try_reflect"}

# Expressions that compare for equality, and those that may stand between a join's
# condition and its equalities.
_EQUALITIES = {"EqualTo", "EqualNullSafe"}


class QueryDenied(ValueError):
    """A query broke a rule; `rule` is one of G1 to G5."""

    def __init__(self, rule: str, detail: str):
        super().__init__(f"{rule}: {detail}")
        self.rule = rule
        self.detail = detail


@dataclass(frozen=True)
class Guard:
    """A session of its own for guarded queries, leaving the caller's settings alone."""

    session: SparkSession
    allowed: frozenset[str]
    max_rows: int
    theta_joins: bool = False

    def query(self, sql: str) -> DataFrame:
        """The result of a permitted SELECT, never more than `max_rows` rows."""
        check(self.session, sql, self.allowed, self.theta_joins)
        return self.session.sql(sql).limit(self.max_rows)

    def catalogue(self) -> DataFrame:
        """table_name, column_name, data_type of the tables a query may read; no data is read."""
        rows = [
            (name, field.name, field.dataType.simpleString())
            for name in sorted(self.allowed)
            if self.session.catalog.tableExists(name)
            for field in self.session.table(name).schema
        ]
        return self.session.createDataFrame(
            rows, "table_name string, column_name string, data_type string"
        )

    def query_or_error(self, sql: str) -> DataFrame | str:
        """As `query`, with a refusal, a failed analysis or a failed run as text.

        The result is computed here, so that its errors are met; `max_rows` bounds it.
        """
        try:
            result = self.query(sql)
            return self.session.createDataFrame(result.collect(), result.schema)
        except (QueryDenied, PySparkException) as error:
            return f"Error: {error}"


def open_guard(
    spark: SparkSession,
    register: Callable[[SparkSession], None] | None = None,
    allowed: Iterable[str] = GOLD_TABLES,
    max_rows: int = MAX_ROWS,
    theta_joins: bool = False,
) -> Guard:
    """A guard over the current database, or over views that `register` creates.

    A join needs an equality between its sides unless `theta_joins` are permitted.

    The settings must hold until a result is computed, hence a session that
    nothing else uses: no cartesian products, no files read as tables.
    """
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    session.conf.set("spark.sql.crossJoin.enabled", "false")
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    if register is not None:
        register(session)
    return Guard(session, frozenset(name.lower() for name in allowed), max_rows, theta_joins)


def check(
    spark: SparkSession, sql: str, allowed: frozenset[str], theta_joins: bool = False
) -> None:
    """Raise QueryDenied unless the text is one plain SELECT over allowed tables."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        plan = parser.parsePlan(sql)
    except PySparkException as error:
        raise QueryDenied("G1", f"not a single readable statement: {error}") from error
    _check_root(plan)
    _check_nodes(plan, _Rules(allowed, _built_in(spark)), frozenset())
    if not theta_joins:
        # A plain SELECT by now, which is analysed here and not run.
        _check_joins(spark.sql(sql)._jdf.queryExecution().analyzed())


@dataclass(frozen=True)
class _Rules:
    allowed: frozenset[str]
    functions: frozenset[str]


def _built_in(spark: SparkSession) -> frozenset[str]:
    """Names of the functions that Spark itself brings, less the denied ones."""
    registry = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    names = registry.listFunction()
    return frozenset(
        names.apply(at).funcName().lower() for at in range(names.size())
    ) - _DENIED_FUNCTIONS


def _kind(plan) -> str:
    return plan.getClass().getSimpleName().rstrip("$")


def _each(scala_seq) -> Iterator:
    for position in range(scala_seq.size()):
        yield scala_seq.apply(position)


def _check_root(plan) -> None:
    kind = _kind(plan)
    while kind in _WRAPPERS:
        plan = plan.child()
        kind = _kind(plan)
    if kind not in _SELECT_ROOTS:
        raise QueryDenied("G2", f"only SELECT is permitted, not {kind}")


def _check_nodes(plan, rules: _Rules, ctes: frozenset[str]) -> None:
    """Check a node and all below it; `ctes` are the names in scope here."""
    kind = _kind(plan)
    if kind == "UnresolvedWith":
        if plan.allowRecursion():
            raise QueryDenied("G3", "recursive queries are forbidden")
        for relation in _each(plan.cteRelations()):
            # A definition sees the names defined before it.
            _check_nodes(relation._2(), rules, ctes)
            ctes = ctes | {relation._1().lower()}
        _check_nodes(plan.child(), rules, ctes)
        return
    if kind == "UnresolvedTableValuedFunction":
        raise QueryDenied("G4", "table functions are not tables")
    if kind not in _ALLOWED_NODES:
        raise QueryDenied("G2", f"{kind} is not part of a plain SELECT")
    if kind == "UnresolvedRelation":
        name = ".".join(_each(plan.multipartIdentifier())).lower()
        if name not in rules.allowed and name not in ctes:
            raise QueryDenied("G4", f"access to table '{name}' is denied")
    if kind == "Join" and plan.condition().isEmpty() and _kind(plan.joinType()) != "UsingJoin":
        raise QueryDenied("G5", "a join needs ON or USING")
    _check_functions(plan, rules.functions)
    for below in (plan.children(), plan.subqueries()):
        for child in _each(below):
            _check_nodes(child, rules, ctes)


def _check_joins(plan) -> None:
    """Every join of the query's own text equates its two sides; views may join as they like."""
    if _kind(plan) == "View":
        return
    if _kind(plan) == "Join" and plan.condition().isDefined():
        if not _has_equality(plan.condition().get(), plan.left().outputSet(), plan.right().outputSet()):
            raise QueryDenied("G5", "a join needs an equality between its sides")
    for below in (plan.children(), plan.subqueries()):
        for child in _each(below):
            _check_joins(child)


def _has_equality(condition, left, right) -> bool:
    """Whether one of the conditions joined by AND equates columns of the two sides."""
    if _kind(condition) == "And":
        return any(_has_equality(part, left, right) for part in _each(condition.children()))
    if _kind(condition) not in _EQUALITIES:
        return False
    one, other = (part.references() for part in _each(condition.children()))
    if one.isEmpty() or other.isEmpty():
        return False
    return (one.subsetOf(left) and other.subsetOf(right)) or (one.subsetOf(right) and other.subsetOf(left))


def _check_functions(plan, functions: frozenset[str]) -> None:
    """Built-in functions only: others may read tables or run code that no rule sees."""
    pending = list(_each(plan.expressions()))
    while pending:
        expression = pending.pop()
        if _kind(expression) == "UnresolvedFunction":
            parts = list(_each(expression.nameParts()))
            if len(parts) > 1 or parts[0].lower() not in functions:
                raise QueryDenied("G2", f"function {'.'.join(parts)} is not permitted")
        pending.extend(_each(expression.children()))


def guarded_query(
    spark: SparkSession,
    sql: str,
    allowed: Iterable[str] = GOLD_TABLES,
    max_rows: int = MAX_ROWS,
    register: Callable[[SparkSession], None] | None = None,
) -> DataFrame:
    """One guarded query in a session of its own."""
    return open_guard(spark, register, allowed, max_rows).query(sql)
