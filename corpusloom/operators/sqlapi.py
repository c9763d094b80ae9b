"""SQL over chunk and table views: scoped views, read-only statements, JSON helpers, display cleaning, strategies."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusloom.operators import chunking as C

# Text between semicolons: quoted text, quoted names and comments are taken whole.
STATEMENT = re.compile(r"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|[^;])+""", re.DOTALL)
# What a query may be made of, by the class names of its parsed plan. Everything else is refused: commands, scripts, writes, table functions.
QUERY_NODES = frozenset({
    "Aggregate", "Deduplicate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation",
    "Pivot", "Project", "Sort", "SubqueryAlias", "Union", "Unpivot", "UnresolvedHaving", "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases", "UnresolvedWith",
    "UnresolvedOrderBy", "WithWindowDefinition"})
# Functions that call code by its name.
REFLECTION = frozenset({"java_method", "reflect", "try_reflect"})


class RefusedStatement(ValueError):
    """A statement that is not a query over the session's views."""


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


@dataclass
class SqlSession:
    """Views visible to user statements. Scope and names are part of the views, never edits of the statement text."""

    spark: SparkSession
    row_limit: int | None = None
    views: list[str] = field(default_factory=list)

    def view(self, name: str, df: DataFrame, scope: Column | None = None, names: dict[str, str] | None = None) -> None:
        """Register a view, optionally filtered to a scope and with logical column names."""
        if scope is not None:
            df = df.filter(scope)
        if names:
            df = df.select(*[F.col(stored).alias(logical) for logical, stored in names.items()])
        df.createOrReplaceTempView(name)
        self.views.append(name)

    def functions(self) -> None:
        """SQL functions for JSON columns and text matching; they expand to built-in expressions."""
        run = self.spark.sql
        run("create or replace temporary function json_extract_string(doc string, path string) returns string return get_json_object(doc, path)")
        run("create or replace temporary function json_extract_isnull(doc string, path string) returns boolean return get_json_object(doc, path) is null")
        run(
            "create or replace temporary function match_share(tks array<string>, q string) returns double return "
            r"try_divide(size(array_intersect(tks, regexp_extract_all(lower(q), '[\\p{L}\\p{N}]+', 0))), size(array_distinct(regexp_extract_all(lower(q), '[\\p{L}\\p{N}]+', 0))))")

    def run(self, statement: str, args: dict | None = None) -> DataFrame:
        """One query. Anything that is not one is refused before it runs; with a row limit, no result has more rows."""
        text = statement.replace("```", "").strip().rstrip(";")
        if not self.is_query(text):
            raise RefusedStatement("Only queries are supported.")
        df = self.spark.sql(text, args=args) if args else self.spark.sql(text)
        return df if self.row_limit is None else df.limit(self.row_limit)

    def is_query(self, statement: str) -> bool:
        """Whether the parsed statement only reads this session's views, through the plan nodes and functions that a query may have."""
        return self._reads(self.spark._jsparkSession.sessionState().sqlParser().parsePlan(statement), frozenset(v.lower() for v in self.views))

    def _reads(self, plan, known: frozenset[str]) -> bool:
        kind = plan.getClass().getSimpleName()
        if kind not in QUERY_NODES:
            return False
        if kind == "UnresolvedRelation":
            parts = _items(plan.multipartIdentifier())
            return len(parts) == 1 and parts[0].lower() in known
        if kind == "UnresolvedWith":
            # A named query sees those before it; only the statement below sees them all. A recursive one sees itself.
            for named in _items(plan.cteRelations()):
                name = named._1().lower()
                if not self._reads(named._2(), known | {name} if plan.allowRecursion() else known):
                    return False
                known |= {name}
        return all(self._reads(c, known) for c in _items(plan.children())) and all(self._calls(e, known) for e in _items(plan.expressions()))

    def _calls(self, expression, known: frozenset[str]) -> bool:
        kind = expression.getClass().getSimpleName()
        if kind.startswith("ExpressionWithUnresolved"):  # a name that is only known when it runs
            return False
        if kind == "UnresolvedFunction" and _items(expression.nameParts())[-1].lower() in REFLECTION:
            return False
        subquery = self.spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.PlanExpression")
        if subquery.isInstance(expression) and not self._reads(expression.plan(), known):
            return False
        return all(self._calls(c, known) for c in _items(expression.children()))

    def run_all(self, statements: str) -> list[DataFrame]:
        """Statements separated by semicolons; refused ones are skipped."""
        parts = [s.strip() for s in STATEMENT.findall(statements.replace("```", ""))]
        return [self.run(s) for s in parts if s and self.is_query(s)]


def source_rows(filtered: DataFrame, key: str, name: str, n: int | None = None) -> DataFrame:
    """Documents behind an aggregate: the distinct ids and names of its filtered rows, the first ``n`` if asked."""
    rows = filtered.select(key, name).distinct()
    return rows if n is None else rows.orderBy(key).limit(n)


def display(df: DataFrame) -> DataFrame:
    """Decimals as doubles, NaN and infinity as null, times as dates."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- strategies by name -------------------------------------------------------------------------------------

Strategy = Callable[..., DataFrame]
CHUNKERS: dict[str, Strategy] = {
    "naive": C.merge_sections,
    "plain": C.merge_plain,
    "one": lambda df, doc, text, **o: C.whole_document(df, doc, F.split(text, "\n"), **o),
    "custom": C.split_custom,
    "markdown": lambda df, doc, text, **o: C.merge_markdown(df, doc, F.split(text, "\n"), **o),
}


def register_chunker(name: str, strategy: Strategy) -> None:
    CHUNKERS[name] = strategy


def chunk_by_strategy(df: DataFrame, doc: str, text: str, strategy: str, options: dict[str, dict] | None = None) -> DataFrame:
    """Chunk every row with the strategy its dataset names; one plan per strategy, united."""
    options = options or {}
    parts = []
    for name, run in CHUNKERS.items():
        if name in options:
            parts.append(run(df.filter(F.col(strategy) == name), doc, text, **options[name]).withColumn("strategy", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


