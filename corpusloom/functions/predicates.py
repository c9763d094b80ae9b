"""Filters, metadata predicates and routing rules compiled to Spark ``Column`` predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusloom.functions import text as X

# Spellings of the comparison operators.
OPERATOR_NAMES = {
    "is": "=", "==": "=", "not is": "≠", "is not": "≠", "!=": "≠", "<>": "≠", ">=": "≥", "<=": "≤",
}
OPERATORS = (
    "contains", "not contains", "in", "not in", "start with", "end with", "empty", "not empty", "=", "≠", ">", "<", "≥", "≤",
)
COMPARISONS = ("=", "≠", ">", "<", "≥", "≤")
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


class UnsupportedFilter(ValueError):
    """A clause that has no native form."""


def normalize_operator(op: str) -> str:
    op = op.strip().lower()
    op = OPERATOR_NAMES.get(op, op)
    if op not in OPERATORS:
        raise UnsupportedFilter(f"unknown operator {op!r}")
    return op


def compare(left: Column, op: str, right) -> Column:
    right = right if isinstance(right, Column) else F.lit(right)
    if op == "=":
        return left == right
    if op == "≠":
        return left != right
    if op == ">":
        return left > right
    if op == "<":
        return left < right
    if op == "≥":
        return left >= right
    if op == "≤":
        return left <= right
    raise UnsupportedFilter(f"no comparison {op!r}")


def _number(value):
    if isinstance(value, bool):
        return None
    if isinstance(value, (int, float)):
        return float(value)
    try:
        return float(str(value).strip())
    except ValueError:
        return None


def _members(value) -> list[str]:
    if isinstance(value, (list, tuple, set)):
        return [str(v).strip().lower() for v in value]
    return [v.strip().lower() for v in str(value).split(",") if v.strip()]


def cell_matches(cell: Column, op: str, value) -> Column:
    """One text cell of a metadata table against one clause; never null."""
    op = normalize_operator(op)
    low = F.lower(cell)
    if op in COMPARISONS:
        text = str(value).strip()
        if re.match(DATE_PATTERN, text):
            matched = X.strip(cell).rlike(DATE_PATTERN) & compare(X.strip(cell), op, text)
        else:
            number = cell.try_cast("double")
            target = _number(value)
            if target is None:  # a number never equals or orders against text
                matched = F.when(number.isNotNull(), F.lit(op == "≠")).otherwise(compare(low, op, str(value).lower()))
            elif isinstance(value, str):
                matched = F.when(number.isNotNull(), compare(number, op, target)).otherwise(compare(low, op, value.lower()))
            else:
                matched = F.when(number.isNotNull(), compare(number, op, target)).otherwise(F.lit(op == "≠"))
    elif op == "contains":
        matched = F.contains(low, F.lit(str(value).lower()))
    elif op == "not contains":
        matched = ~F.contains(low, F.lit(str(value).lower()))
    elif op == "in":
        matched = low.isin(_members(value))
    elif op == "not in":
        matched = ~low.isin(_members(value))
    elif op == "start with":
        matched = F.startswith(low, F.lit(str(value).lower()))
    elif op == "end with":
        matched = F.endswith(low, F.lit(str(value).lower()))
    elif op == "empty":
        matched = cell == ""
    else:
        matched = cell != ""
    return F.coalesce(matched, F.lit(False))


def metadata_filter(
    meta: DataFrame, filters: list[dict], logic: str = "and", docs: DataFrame | None = None, doc: str = "doc_id"
) -> DataFrame:
    """Documents of a long metadata table ``(doc, key, value)`` that satisfy the clauses."""
    grouped = metadata_flags(meta, filters, docs, doc)
    result = F.col("__c0")
    for i in range(1, len(filters)):
        result = (result & F.col(f"__c{i}")) if logic == "and" else (result | F.col(f"__c{i}"))
    return grouped.filter(result).select(doc)


def metadata_flags(meta: DataFrame, filters: list[dict], docs: DataFrame | None = None, doc: str = "doc_id") -> DataFrame:
    """``(doc, __c0, __c1, ...)``: which clauses each document satisfies.

    One aggregation with map-side combine, whatever the number of clauses. ``empty`` means missing or blank, so
    it needs ``docs``, the catalog of ids.
    """
    rows = meta.select(doc, "key", "value")
    if docs is not None:
        rows = rows.unionByName(docs.select(doc, F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    wanted = sorted({f["key"] for f in filters})
    if docs is None:
        rows = rows.filter(F.col("key").isin(wanted))
    flags = []
    for f in filters:
        of_key = F.coalesce(F.col("key") == f["key"], F.lit(False))
        if normalize_operator(f["op"]) == "empty":
            flags.append(~F.bool_or(of_key & cell_matches(F.col("value"), "not empty", None)))
        else:
            flags.append(F.bool_or(of_key & cell_matches(F.col("value"), f["op"], f.get("value"))))
    return rows.groupBy(doc).agg(*[flag.alias(f"__c{i}") for i, flag in enumerate(flags)])


def resolve_ids(base: DataFrame, filtered: DataFrame | None = None, doc: str = "doc_id") -> DataFrame:
    """Base ids united with the filter result; an empty filter result never widens to everything."""
    ids = base.select(doc)
    if filtered is not None:
        ids = ids.unionByName(filtered.select(doc))
    return ids.distinct()


def native_predicate(schema: T.StructType, clause: dict) -> Column:
    """Clause over a typed column, in the form that reaches the parquet reader where one exists.

    Negative and range clauses require the field to exist; wildcards are literal text.
    """
    key, value = clause.get("key"), clause.get("value")
    if not isinstance(key, str) or key not in schema.fieldNames():
        raise UnsupportedFilter(f"unknown field {key!r}")
    op = normalize_operator(clause["op"])
    column = F.col(key)
    is_text = isinstance(schema[key].dataType, T.StringType)
    if op in COMPARISONS or op in ("contains", "not contains", "start with", "end with"):
        if value is None or isinstance(value, (list, dict)):
            raise UnsupportedFilter(f"operator {op} needs one value")
    if op == "empty":
        return column.isNull() | (column == "") if is_text else column.isNull()
    if op == "not empty":
        return column.isNotNull() & (column != "") if is_text else column.isNotNull()
    if op in COMPARISONS:
        if not is_text:
            number = _number(value)
            if number is not None and isinstance(schema[key].dataType, T.NumericType):
                value = int(number) if number == int(number) else number
            return column.isNotNull() & compare(column, op, value)
        if op in ("=", "≠"):
            return column.isNotNull() & compare(F.lower(column), op, str(value).lower())
        return column.isNotNull() & compare(column, op, str(value))
    if op in ("in", "not in"):
        members = _members(value)
        if is_text:
            found = F.lower(column).isin(members)
        else:
            found = column.isin([int(m) if re.fullmatch("-?[0-9]+", m) else float(m) for m in members])
        return column.isNotNull() & (found if op == "in" else ~found)
    low, target = F.lower(column.cast("string")), F.lit(str(value).lower())
    if op == "contains":
        return F.contains(low, target)
    if op == "not contains":
        return column.isNotNull() & ~F.contains(low, target)
    return F.startswith(low, target) if op == "start with" else F.endswith(low, target)


def native_filter(df: DataFrame, clauses: list[dict], logic: str = "and") -> DataFrame:
    result = None
    for clause in clauses:
        p = native_predicate(df.schema, clause)
        result = p if result is None else ((result & p) if logic == "and" else (result | p))
    return df if result is None else df.filter(result)


def json_predicate(column: Column, name: str, op: str, value) -> Column:
    """Predicate on one field of a JSON text column; null counts as no match."""
    cell = F.get_json_object(column, f"$.{name}")
    decimal = cell.try_cast(T.DecimalType(20, 10))
    stamp = cell.try_cast("timestamp")
    if op in COMPARISONS:
        out = compare(decimal, op, F.lit(value).cast(T.DecimalType(20, 10)))
    elif op in ("is", "is not"):
        out = compare(cell, "=" if op == "is" else "≠", str(value))
    elif op in ("before", "after"):
        out = compare(stamp, "<" if op == "before" else ">", F.lit(value).cast("timestamp"))
    elif op in ("contains", "not contains"):  # JSON containment: member of an array, or the same scalar
        members = F.from_json(cell, "array<string>")
        found = F.coalesce(F.array_contains(members, str(value)), cell == str(value))
        out = found if op == "contains" else ~found
    elif op == "start with":
        out = F.startswith(cell, F.lit(str(value)))
    elif op == "end with":
        out = F.endswith(cell, F.lit(str(value)))
    elif op == "empty":
        return cell.isNull() | cell.isin("", "[]", "{}")
    elif op == "not empty":
        out = ~cell.isin("", "[]", "{}")
    else:
        raise UnsupportedFilter(f"unknown operator {op!r}")
    return F.coalesce(out, F.lit(False))


def json_filter(df: DataFrame, column: str, conditions: list[dict], logic: str = "and") -> DataFrame:
    if logic.lower() not in ("and", "or"):
        raise UnsupportedFilter(f"unknown logic {logic!r}")
    result = None
    for c in conditions:
        p = json_predicate(F.col(column), c["name"], c["op"], c.get("value"))
        result = p if result is None else ((result & p) if logic.lower() == "and" else (result | p))
    return df if result is None else df.filter(result)


def equality_filter(df: DataFrame, condition: dict) -> DataFrame:
    """Conjunction of field tests: scalar, list (``IN`` or any member), empty value ignored.

    ``available`` follows the null-is-available rule; ``exists`` and ``must_not`` name a field.
    """
    for key, value in condition.items():
        if key == "exists":
            df = df.filter(F.col(value).isNotNull())
            continue
        if key == "must_not":
            df = df.filter(F.col(value["exists"]).isNull())
            continue
        if value is None or value == "" or value == []:
            continue
        if isinstance(df.schema[key].dataType, T.ArrayType):
            members = value if isinstance(value, list) else [value]
            df = df.filter(F.arrays_overlap(F.col(key), F.array(*[F.lit(v) for v in members])))
        else:
            df = df.filter(F.col(key).isin(value) if isinstance(value, list) else F.col(key) == value)
    return df


def available(column: Column, wanted: int = 1) -> Column:
    """1: everything not marked below 1, null included. 0: marked below 1."""
    below = F.coalesce(column < 1, F.lit(False))
    return below if wanted == 0 else ~below


def contains_ignore_case(column: Column, needle: str) -> Column:
    return F.contains(F.lower(column), F.lit(needle.lower()))


def rule_matches(record: Column, rule: dict) -> Column:
    """One rule on the stringified value of a map record; a missing key never matches."""
    value = F.coalesce(record[rule["key"]], F.lit(""))
    target = F.lit(str(rule["value"]))
    tests = {
        "=": value == target, "≠": value != target, "contains": F.contains(value, target),
        "start with": F.startswith(value, target), "end with": F.endswith(value, target),
    }
    return F.map_contains_key(record, rule["key"]) & tests.get(rule["op"], F.lit(False))


def route(cases: list[dict], default: str) -> Column:
    """First case whose items hold; items are ``(column, operator, value, is_number)``."""

    def item(column, op, value, is_number=False):
        if op == "empty":
            return (F.coalesce(column, F.lit(0)) == 0) if is_number else F.coalesce(column, F.lit("")) == ""
        if op == "not empty":
            return ~item(column, "empty", value, is_number)
        if op in ("contains", "not contains", "start with", "end with"):
            low, target = F.lower(column.cast("string")), F.lit(str(value).lower())
            found = {
                "contains": F.contains(low, target), "not contains": ~F.contains(low, target),
                "start with": F.startswith(low, target), "end with": F.endswith(low, target),
            }
            return F.coalesce(found[op], F.lit(False))
        if is_number:
            return F.coalesce(compare(column.cast("double"), op, float(value)), F.lit(False))
        if op in ("=", "≠"):
            return F.coalesce(compare(column, op, str(value)), F.lit(op == "≠"))
        number, target = column.try_cast("double"), _number(value)
        as_text = compare(column, op, str(value))
        if target is None:
            return F.coalesce(as_text, F.lit(False))
        return F.coalesce(F.when(number.isNotNull(), compare(number, op, target)).otherwise(as_text), F.lit(False))

    out = None
    for case in cases:
        tests = [item(*i) for i in case["items"]]
        hit = tests[0]
        for test in tests[1:]:
            hit = (hit & test) if case.get("logic", "and") == "and" else (hit | test)
        out = F.when(hit, case["to"]) if out is None else out.when(hit, case["to"])
    return F.lit(default) if out is None else out.otherwise(default)


def typed_condition(column: Column, data_type: T.DataType, op: str, value=None) -> Column:
    """Condition whose operators depend on the type of the value."""
    if isinstance(data_type, T.StringType):
        table = {
            "contains": lambda: F.contains(column, F.lit(value)), "not contains": lambda: ~F.contains(column, F.lit(value)),
            "start with": lambda: F.startswith(column, F.lit(value)), "end with": lambda: F.endswith(column, F.lit(value)),
            "is": lambda: column == value, "is not": lambda: column != value,
            "empty": lambda: column == "", "not empty": lambda: column != "",
        }
    elif isinstance(data_type, T.BooleanType):
        table = {
            "is": lambda: column == value, "is not": lambda: column != value,
            "empty": lambda: F.lit(False), "not empty": lambda: F.lit(True),
        }
    elif isinstance(data_type, T.NumericType):
        table = {o: (lambda o=o: compare(column, o, value)) for o in COMPARISONS}
        table |= {"empty": lambda: F.lit(False), "not empty": lambda: F.lit(True)}
    elif isinstance(data_type, T.MapType):
        table = {"empty": lambda: F.size(column) == 0, "not empty": lambda: F.size(column) > 0}
    elif isinstance(data_type, T.ArrayType):
        same = F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else None
        table = {
            "contains": lambda: F.array_contains(column, value), "not contains": lambda: ~F.array_contains(column, value),
            "is": lambda: column == same, "is not": lambda: column != same,
            "empty": lambda: F.size(column) == 0, "not empty": lambda: F.size(column) > 0,
        }
    else:
        table = {}
    if op not in table:
        raise UnsupportedFilter(f"invalid operator {op!r} for {data_type.simpleString()}")
    return F.when(column.isNull(), F.lit(op == "empty")).otherwise(F.coalesce(table[op](), F.lit(False)))


def visible_to(tenants: DataFrame, owner: str, joined: DataFrame, user: str) -> DataFrame:
    """Catalog rows owned by ``user``, or shared with the team by a tenant the user joined; valid rows only."""
    valid = tenants.filter(F.col("status") == "1")
    own = valid.filter(F.col(owner) == user)
    shared = valid.filter((F.col(owner) != user) & (F.col("permission") == "team"))
    return own.unionByName(shared.join(joined.select(F.col("tenant").alias(owner)).distinct(), owner, "left_semi").select(own.columns))


def allow_list(df: DataFrame, name: str, wanted: list[str], regex: bool = False) -> DataFrame:
    """Rows whose name is listed (an unknown name fails the job) or fully matches a pattern; no list keeps all."""
    if not wanted:
        return df
    if regex:
        return df.filter(F.col(name).rlike("^(?:" + "|".join(f"(?:{p})" for p in wanted) + r")\z"))
    found = df.filter(F.col(name).isin(wanted)).agg(F.collect_set(name).alias("f"))  # at most len(wanted) names
    missing = F.array_except(F.array(*[F.lit(w) for w in wanted]), found.scalar())
    checked = F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("unknown names: "), F.array_join(missing, ", "))).cast("boolean"))
    return df.filter(F.col(name).isin(wanted) & F.coalesce(checked, F.lit(True)))


