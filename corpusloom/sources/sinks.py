"""Sinks over plain tables: upsert, conditional update and delete, copy checks, atomic writes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.running import latest


def upsert(stored: DataFrame, incoming: DataFrame, key, order: Column | None = None) -> DataFrame:
    """Stored rows replaced by incoming rows of the same key; the latest of repeated incoming rows wins."""
    keys = [key] if isinstance(key, str) else list(key)
    new = latest(incoming, keys, order) if order is not None else incoming
    kept = stored.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new.select(stored.columns))


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions the frame holds; each becomes visible as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def update(df: DataFrame, condition: Column, values: dict | None = None, remove: dict | None = None, add: dict | None = None) -> DataFrame:
    """Set fields, drop fields (``None``) or list members, add list members, where the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    new = {}
    for name, value in (values or {}).items():
        new[name] = F.when(hit, value if isinstance(value, Column) else F.lit(value)).otherwise(F.col(name))
    for name, value in (remove or {}).items():
        gone = F.lit(None).cast(df.schema[name].dataType) if value is None else F.array_remove(new.get(name, F.col(name)), value)
        new[name] = F.when(hit, gone).otherwise(new.get(name, F.col(name)))
    for name, value in (add or {}).items():
        base = new.get(name, F.col(name))
        new[name] = F.when(hit, F.array_append(F.coalesce(base, F.array().cast(df.schema[name].dataType)), value)).otherwise(base)
    return df.withColumns(new)


def delete(df: DataFrame, condition: Column | None = None, ids: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows left after deleting those that match the condition and, when given, are on the id list."""
    hit = F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True)
    if ids is None:
        return df.filter(~hit)
    listed = ids.select(key).distinct().withColumn("__hit", F.lit(True))
    return df.join(listed, key, "left").filter(~(hit & F.coalesce("__hit", F.lit(False)))).drop("__hit").select(df.columns)


def rename_tag(df: DataFrame, tags: str, old: str, new: str | None, scope: Column) -> DataFrame:
    """In rows of the scope that carry ``old``: drop it, or put ``new`` in its place."""
    without = F.array_remove(tags, old)
    changed = without if new is None else F.array_distinct(F.array_append(without, new))
    return df.withColumn(tags, F.when(scope & F.array_contains(tags, old), changed).otherwise(F.col(tags)))


def verify_copy(source: DataFrame, target: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row: counts, missing and extra ids, mismatches per field, match rate."""
    a = source.select(F.col(key), F.struct(*fields).alias("a"))
    b = target.select(F.col(key), F.struct(*fields).alias("b"))
    both = a.join(b, key, "full")
    paired = F.col("a").isNotNull() & F.col("b").isNotNull()
    differs = {f: paired & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")) for f in fields}
    same = paired & ~reduce(lambda x, y: x | y, differs.values())
    stats = both.agg(
        F.count("a").alias("source_rows"), F.count("b").alias("target_rows"), F.count_if(F.col("b").isNull()).alias("missing"),
        F.count_if(F.col("a").isNull()).alias("extra"), F.count_if(same).alias("matching"), *[F.count_if(d).alias(f"differs_{f}") for f, d in differs.items()])
    return stats.withColumn("match_rate", F.coalesce(F.try_divide("matching", "source_rows"), F.lit(1.0)))


def merge_sheets(frames: list[DataFrame], key: str | None = None) -> DataFrame:
    """Sheets stacked with the union of their columns, or joined on a key column."""
    if key is None:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return reduce(lambda a, b: a.join(b, key, "full"), frames)
