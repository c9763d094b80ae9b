"""Operators on map records and lists held in columns, and on nested JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from corpusloom.functions import text as X

# --- map records ----------------------------------------------------------------------------------


def select_keys(record: Column, keys) -> Column:
    return F.map_filter(record, lambda k, v: k.isin(list(keys)))


def remove_keys(record: Column, keys) -> Column:
    return F.map_filter(record, lambda k, v: ~k.isin(list(keys)))


def rename_keys(record: Column, pairs) -> Column:
    """Rename in order; blank names and missing keys are skipped; an existing target is replaced."""
    for old, new in pairs:
        if not old.strip() or not new.strip() or old == new:
            continue
        moved = F.map_concat(remove_keys(record, [old, new]), F.create_map(F.lit(new), record[old]))
        record = F.when(F.map_contains_key(record, old), moved).otherwise(record)
    return record


def put_keys(record: Column, values: dict) -> Column:
    """Add keys or overwrite their values."""
    kept = F.map_filter(record, lambda k, v: ~k.isin(list(values)))
    added = F.create_map(*[part for k, v in values.items() for part in (F.lit(k), v if isinstance(v, Column) else F.lit(str(v)))])
    return F.map_concat(kept, added)


def literal(column: Column) -> Column:
    """Text that looks like a literal becomes a typed VARIANT, other text stays a string VARIANT."""
    text = X.strip(column)
    low = F.lower(text)
    looks = text.rlike(r"""^[{\[('"]""") | low.isin("true", "false", "none") | F.replace(text, F.lit("."), F.lit("")).rlike("^[0-9]+$")
    spelled = F.when(low == "true", "true").when(low == "false", "false").when(low == "none", "null").otherwise(
        F.when(text.rlike("^'[^']*'$"), F.concat(F.lit('"'), F.substr(text, F.lit(2), F.length(text) - 2), F.lit('"'))).otherwise(text)
    )
    return F.coalesce(F.when(looks, F.try_parse_json(spelled)), F.to_variant_object(F.array(column)).cast("array<variant>")[0])


# --- lists ------------------------------------------------------------------------------------------


def _out_of_range(what: str, values: Column, n: int) -> Column:
    message = F.concat(F.lit(f"{what} {n} is out of range for a list of "), F.size(values).cast("string"))
    return F.raise_error(message).cast("array<string>")


def nth(values: Column, n: int, strict: bool = False) -> Column:
    """The n-th member (from the end when negative) as a list of zero or one."""
    inside = (F.size(values) >= abs(n)) & F.lit(n != 0)
    miss = _out_of_range("nth", values, n) if strict else F.slice(values, 1, 0)
    return F.when(inside, F.slice(values, n if n else 1, 1)).otherwise(miss)


def head(values: Column, n: int, strict: bool = False) -> Column:
    taken = F.slice(values, 1, max(n, 0))
    if strict:
        return F.when(F.lit(n >= 1) & (F.size(values) >= n), taken).otherwise(_out_of_range("head", values, n))
    return taken


def tail(values: Column, n: int, strict: bool = False) -> Column:
    size = F.size(values)
    taken = F.slice(values, F.greatest(size - n + 1, F.lit(1)), F.lit(max(n, 0)))
    if strict:
        return F.when(F.lit(n >= 1) & (size >= n), taken).otherwise(_out_of_range("tail", values, n))
    return taken


def filter_list(values: Column, op: str, value: str) -> Column:
    target = F.lit(value)

    def keep(v):
        v = F.coalesce(v.cast("string"), F.lit(""))
        return {
            "=": v == target, "≠": v != target, "contains": F.contains(v, target),
            "start with": F.startswith(v, target), "end with": F.endswith(v, target),
        }.get(op, F.lit(False))

    return F.filter(values, keep)


def sort_list(values: Column, descending: bool = False) -> Column:
    return F.sort_array(values, not descending)


def sort_records(records: Column, descending: bool = False) -> Column:
    """Sort map records by their entries in key order."""
    keyed = F.transform(records, lambda r: F.struct(F.array_sort(F.map_entries(r)).alias("k"), F.array_sort(F.map_entries(r)).alias("r")))
    return F.transform(F.sort_array(keyed, not descending), lambda s: F.map_from_entries(s["r"]))


def distinct_records(records: Column) -> Column:
    """Keep the first of equal map records."""
    return F.transform(F.array_distinct(F.transform(records, lambda r: F.array_sort(F.map_entries(r)))), F.map_from_entries)


# --- assignment -------------------------------------------------------------------------------------

NOT_NUMBER = "ERROR:VARIABLE_NOT_NUMBER or PARAMETER_NOT_NUMBER"  # fixed values: error labels
DIVIDE_BY_ZERO = "ERROR:DIVIDE_BY_ZERO"
NOT_LIST = "ERROR:VARIABLE_NOT_LIST"


def arithmetic(variable: Column, op: str, parameter: Column) -> Column:
    """``+= -= *= /=`` on text cells: the number as text, or an error label."""
    a, b = variable.try_cast("double"), parameter.try_cast("double")
    value = {"+=": a + b, "-=": a - b, "*=": a * b, "/=": F.try_divide(a, b)}[op]
    out = F.when(a.isNull() | b.isNull(), NOT_NUMBER)
    if op == "/=":
        out = out.when(b == 0, DIVIDE_BY_ZERO)
    return out.otherwise(value.cast("string"))


def list_assign(values: Column, op: str, parameter: Column | None = None) -> Column:
    """``append``, ``extend``, ``remove_first``, ``remove_last``, ``clear``, ``overwrite`` or ``set``."""
    n = F.size(values)
    return {
        "append": lambda: F.array_append(F.coalesce(values, F.array().cast("array<string>")), parameter),
        "extend": lambda: F.concat(F.coalesce(values, F.array().cast("array<string>")), parameter),
        "remove_first": lambda: F.slice(values, 2, F.greatest(n, F.lit(1))),
        "remove_last": lambda: F.slice(values, 1, F.greatest(n - 1, F.lit(0))),
        "clear": lambda: F.slice(values, 1, 0),
        "overwrite": lambda: parameter,
        "set": lambda: parameter,
    }[op]()


# --- nested JSON ------------------------------------------------------------------------------------


def _step(values: Column, path: str) -> Column:
    return F.transform(values, lambda v: F.try_variant_get(v, path, "variant"))


def path_values(document: Column, path: str) -> Column:
    """All values at a dotted path with ``[n]`` and ``[*]`` steps, as an array of VARIANT."""
    values = F.array(document)
    for segment in path.split("."):
        key, index = re.fullmatch(r"([^\[\]]+)(?:\[(\*|[0-9]+)\])?", segment).groups()
        values = _step(values, f"$.{key}")
        if index == "*":
            values = F.flatten(F.transform(values, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))))
        elif index is not None:
            values = _step(values, f"$[{index}]")
        values = F.filter(values, lambda v: v.isNotNull() & (F.schema_of_variant(v) != "VOID"))
    return values


def path_text(document: Column, path: str, kind: str = "string", default: str = "") -> Column:
    """Values at a path as text, several joined by a comma; a default when nothing is there."""

    def show(v):
        if kind == "number":
            return F.try_variant_get(v, "$", "double").cast("string")
        if kind == "date":
            return F.date_format(F.try_variant_get(v, "$", "string").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))

    texts = F.filter(F.transform(path_values(document, path), show), lambda s: s.isNotNull())
    return F.when(F.size(texts) > 0, F.array_join(texts, ", ")).otherwise(default)
