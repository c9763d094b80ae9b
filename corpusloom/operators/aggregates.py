"""Facets, summaries, metadata roll-ups and evaluation metrics.

Everything here combines on the map side (counts, sums, ``min_by``/``max_by``) or is kept in long form: a group of
unbounded size is never collected into one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusloom.functions import text as X
from corpusloom.operators.running import nearest_rank, row_numbers, top_k

# --- facets and counts --------------------------------------------------------------------------------


def terms(df: DataFrame, field: str, counted: DataFrame | None = None) -> DataFrame:
    """Value counts of a text or list field; blanks dropped; rows counted elsewhere (value, count) pass through."""
    value = F.explode(field) if isinstance(df.schema[field].dataType, T.ArrayType) else F.col(field)
    values = df.select(value.alias("value")).select(X.strip(F.col("value").cast("string")).alias("value"))
    out = values.filter(F.col("value") != "").groupBy("value").agg(F.count("*").alias("count"))
    return out if counted is None else out.unionByName(counted.select("value", "count"))


def facets(df: DataFrame, fields: list[str]) -> DataFrame:
    """Counts for many scalar fields in one pass; missing values are a facet of their own."""
    long = df.select(*[F.col(f).cast("string").alias(f) for f in fields]).withColumn("__id", F.lit(1))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.coalesce(F.col(f), F.lit("empty_metadata")).alias("value")) for f in fields]))
    return long.select(pairs.alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("count"))


def status_pivot(df: DataFrame, by: str, status: str, states: list[str]) -> DataFrame:
    return df.groupBy(by).pivot(status, states).count().fillna(0, subset=states)


def daily_stats(df: DataFrame, ts: str, user: str, amounts: dict[str, Column], start: str | None = None, end: str | None = None) -> DataFrame:
    """Per day: rows, distinct users, sums and mean; an end given as a date includes that whole day."""
    stamp = F.col(ts).cast("timestamp")
    if start:
        df = df.filter(stamp >= F.lit(start).cast("timestamp"))
    if end:
        df = df.filter(stamp <= F.lit(end + " 23:59:59" if len(end) == 10 else end).cast("timestamp"))
    sums = [F.sum(v).alias(n) for n, v in amounts.items()]
    return df.groupBy(F.date_format(stamp, "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.count_distinct(user).alias("users"), *sums
    )


def metadata_summary(meta: DataFrame) -> DataFrame:
    """Long metadata ``(doc, key, value, kind)`` -> per key its majority kind and its values by count."""
    values = meta.groupBy("key", "value").agg(F.count("*").alias("count"))
    kinds = meta.groupBy("key", "kind").agg(F.count("*").alias("n"))
    majority = kinds.groupBy("key").agg(F.min_by("kind", F.struct(-F.col("n"), F.col("kind"))).alias("type"))
    ranked = row_numbers(values, "key", [F.col("count").desc(), F.col("value")], "rank")
    return ranked.join(majority, "key")


def value_kind(value: Column) -> Column:
    """string, number, list or time, from a cell kept as text."""
    return (
        F.when(value.rlike(r"^\[.*\]$"), "list")
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"), "time")
        .when(value.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), "number")
        .otherwise("string")
    )


def summarize(df: DataFrame, by, value: str) -> DataFrame:
    """Count, mean, minimum and exact nearest-rank percentiles."""
    by = [by] if isinstance(by, str) else list(by)
    basic = df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("avg"), F.min(value).alias("min"))
    return basic.join(nearest_rank(df, by, value, {"p50": 0.5, "p90": 0.9, "p95": 0.95}), by)


def accumulate(totals: DataFrame, usage: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Running totals plus one batch of usage."""
    both = totals.select(*keys, amount).unionByName(usage.select(*keys, amount))
    return both.groupBy(*keys).agg(F.sum(amount).alias(amount))


def next_id(df: DataFrame, column: str, default: int = 1) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias(column))


# --- column types -----------------------------------------------------------------------------------

KINDS = ("int", "float", "text", "datetime", "bool")  # ties go to the earlier kind


def infer_types(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Majority type of every text column, in one pass: ``(column, type, int, float, text, datetime, bool)``."""
    long = cells.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("cell")) for c in columns])).alias("x"))
    cell = F.replace(F.col("x.cell"), F.lit("%%"), F.lit(""))
    zero = F.startswith(cell, F.lit("0"))
    kind = (
        F.when(cell.rlike(r"^[+-]?[0-9]+$") & ~zero, "int")
        .when(cell.rlike(r"^[+-]?[0-9.]{0,19}$") & ~zero, "float")
        .when(F.col("x.cell").rlike(X.TRUE_CELLS) | F.col("x.cell").rlike(X.FALSE_CELLS), "bool")
        .when(X.cell_to_timestamp(F.col("x.cell")).isNotNull(), "datetime")
        .otherwise("text")
    )
    big = F.abs(cell.try_cast(T.DecimalType(38, 0))) > F.lit(2**63 - 1)
    tagged = long.filter(F.col("x.cell").isNotNull()).select(
        F.col("x.column").alias("column"), kind.alias("kind"), F.coalesce(big, F.length(cell) > 37).alias("big"))
    counts = tagged.groupBy("column").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS],
        F.max((F.col("kind") == "int") & F.col("big")).alias("__big"),
    )
    best = F.array_max(F.array(*[F.struct(F.col(k).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, k in enumerate(KINDS)]))["k"]
    return counts.select("column", F.when(F.col("__big"), "float").otherwise(best).alias("type"), *KINDS)


def cast_cell(cell: Column, kind: str) -> Column:
    """Cell in the inferred type; what does not convert is null."""
    return {
        "int": lambda: cell.try_cast("long"), "float": lambda: cell.try_cast("double"), "text": lambda: cell,
        "datetime": lambda: X.cell_to_timestamp(cell), "bool": lambda: X.cell_to_bool(cell),
    }[kind]()


def cast_inferred(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with each of the text ``columns`` in its inferred type; a column without any cell stays text."""
    kinds = {r["column"]: r["type"] for r in infer_types(df, columns).select("column", "type").collect()}  # a row for each column
    return df.withColumns({c: cast_cell(F.col(c), kinds.get(c, "text")) for c in columns})


# --- metadata maps ------------------------------------------------------------------------------------


def first_seen_values(df: DataFrame, doc: str, pos: str, columns: list[str]) -> DataFrame:
    """Distinct values of each column per document, numbered in first-seen order."""
    long = df.select(doc, pos, F.explode(F.array(*[
        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x"))
    first = long.filter(F.col("x.value").isNotNull() & (X.strip(F.col("x.value")) != "")).groupBy(
        doc, F.col("x.key").alias("key"), F.col("x.value").alias("value")).agg(F.min(pos).alias("__first"))
    return row_numbers(first, [doc, "key"], ["__first", "value"], "ordinal").select(doc, "key", "ordinal", "value")


def merge_metadata(entries: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Merge maps in order: lists extend and drop repeats, a scalar overwrites a scalar, a list absorbs scalars.

    ``entries``: ``(doc, pos, idx, key, value, is_list)``, one row per member. From the first list on, everything
    is kept; without a list only the last scalar survives.
    """
    bounds = entries.groupBy(doc, "key").agg(
        F.min(F.when(F.col("is_list"), F.col("pos"))).alias("__list_from"), F.max("pos").alias("__last"))
    kept = entries.join(bounds, [doc, "key"]).filter(F.col("pos") >= F.coalesce("__list_from", "__last"))
    first = kept.groupBy(doc, "key", "value").agg(F.min(F.struct("pos", "idx")).alias("__first"))
    return row_numbers(first, [doc, "key"], ["__first"], "ordinal").select(doc, "key", "ordinal", "value")


META_TYPE = "map<string,struct<is_list:boolean,vals:array<string>>>"


def _cell(is_list: bool, values) -> Column:
    values = values if isinstance(values, Column) else F.array(*[F.lit(str(v)) for v in values])
    return F.struct(F.lit(is_list).alias("is_list"), values.alias("vals"))


def edit_metadata(meta: Column, updates: list[dict] = (), deletes: list[dict] = ()) -> Column:
    """Apply updates (optional ``match``) and deletes (optional ``value``) to a ``META_TYPE`` map."""
    for u in updates:
        key, value, match = u["key"], u["value"], u.get("match")
        values = [str(v) for v in value] if isinstance(value, list) else [str(value)]
        new = F.array(*[F.lit(v) for v in values])
        old = F.try_element_at(meta, F.lit(key))
        present = F.map_contains_key(meta, key)
        fresh = _cell(isinstance(value, list), F.array_distinct(new) if isinstance(value, list) else new)
        if match in (None, ""):
            appended = F.struct(F.lit(True).alias("is_list"), F.array_distinct(F.concat(old["vals"], new)).alias("vals"))
            cell = F.when(~present, fresh).when(old["is_list"], appended).otherwise(fresh)
            meta = F.map_concat(_without(meta, key), F.create_map(F.lit(key), cell))
        else:
            swapped = _swap(old["vals"], str(match), values[0])
            cell = F.struct(old["is_list"].alias("is_list"), F.when(old["is_list"], F.array_distinct(swapped)).otherwise(swapped).alias("vals"))
            meta = F.when(present, F.map_concat(_without(meta, key), F.create_map(F.lit(key), cell))).otherwise(meta)
    for d in deletes:
        key, value = d["key"], d.get("value")
        if value is None:
            meta = _without(meta, key)
        else:
            meta = _drop_member(meta, key, str(value))
    return meta


def _without(meta: Column, key: str) -> Column:
    return F.map_filter(meta, lambda k, v: k != key)


def _swap(values: Column, old: str, new: str) -> Column:
    return F.transform(values, lambda v: F.when(v == old, F.lit(new)).otherwise(v))


def _drop_member(meta: Column, key: str, value: str) -> Column:
    rest = F.transform_values(
        meta,
        lambda k, v: F.when(k == key, F.struct(v["is_list"].alias("is_list"), F.array_remove(v["vals"], value).alias("vals"))).otherwise(v),
    )
    return F.map_filter(rest, lambda k, v: (k != key) | (F.size(v["vals"]) > 0))


def batch_edit(docs: DataFrame, meta: str, updates=(), deletes=(), doc: str = "doc_id") -> DataFrame:
    """Edited metadata per document with a ``changed`` flag; a missing map starts empty when there are updates."""
    before = F.col(meta)
    empty = F.create_map().cast(META_TYPE)
    edited = F.when(before.isNull(), edit_metadata(empty, updates)).otherwise(edit_metadata(before, updates, deletes))
    out = docs.select(doc, before.alias("__before"), edited.alias(meta))
    entries = lambda c: F.array_sort(F.map_entries(F.coalesce(c, empty)))
    return out.select(doc, meta, (entries(F.col("__before")) != entries(F.col(meta))).alias("changed"))


# --- tags ---------------------------------------------------------------------------------------------


def tag_priors(tagged: DataFrame, tag: str, smoothing: int = 1000) -> DataFrame:
    """Smoothed share of every tag."""
    counts = tagged.groupBy(F.col(tag).alias("tag")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("tag", ((F.col("n") + 1) / (total + smoothing)).alias("prior"))


def tag_scores(matches: DataFrame, priors: DataFrame, owner: str, n: int = 3, smoothing: int = 1000, floor: int | None = None) -> DataFrame:
    """Tags of the exemplars matched by each owner: over-representation against the prior, best ``n``.

    ``floor=None`` drops tags scoring zero (chunks); ``floor=1`` lifts them (queries).
    """
    counts = matches.groupBy(owner, "tag").agg(F.count("*").alias("c"))
    totals = counts.groupBy(owner).agg(F.sum("c").alias("cnt"))
    prior = F.greatest(F.lit(1e-6), F.coalesce(F.col("prior"), F.lit(0.0001)))
    raw = 0.1 * (F.col("c") + 1) / (F.col("cnt") + smoothing) / prior
    scored = counts.join(totals, owner).join(priors, "tag", "left").withColumn("score", F.bround(raw).cast("long"))
    best = top_k(scored, owner, [F.col("score").desc(), F.col("tag")], n)
    if floor is None:
        best = best.filter(F.col("score") > 0)
    else:
        best = best.withColumn("score", F.greatest(F.col("score"), F.lit(floor).cast("long")))
    return best.select(owner, F.replace(F.col("tag"), F.lit("."), F.lit("_")).alias("tag"), "score", "rank")


# --- retrieval evaluation -------------------------------------------------------------------------------


def judge(run: DataFrame, qrels: DataFrame, query: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """Ranked list with the relevance of every hit (0 when not judged)."""
    rel = qrels.select(query, doc, F.col("rel").alias("rel"))
    return run.join(rel, [query, doc], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))


def retrieval_metrics(run: DataFrame, qrels: DataFrame, query: str = "query_id") -> DataFrame:
    """Precision, recall, F1, hit rate and reciprocal rank per judged query."""
    relevant = qrels.filter(F.col("rel") > 0).groupBy(query).agg(F.count("*").alias("n_rel"))
    found = judge(run, qrels, query).groupBy(query).agg(
        F.count("*").alias("n"), F.sum((F.col("rel") > 0).cast("int")).alias("hits"), F.min(F.when(F.col("rel") > 0, F.col("rank"))).alias("first"))
    both = relevant.join(found, query, "left")
    hits, n = F.coalesce("hits", F.lit(0)), F.coalesce("n", F.lit(0))
    p, r = F.coalesce(F.try_divide(hits, n), F.lit(0.0)), hits / F.col("n_rel")
    return both.select(
        query, p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"),
        (hits > 0).cast("double").alias("hit_rate"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("mrr"))


METRICS = ("precision", "recall", "f1", "hit_rate", "mrr")


def evaluation_summary(cases: DataFrame, time: str = "execution_time") -> DataFrame:
    """Case count, mean time, and the mean of each metric over the cases that have it."""
    return cases.agg(
        F.count("*").alias("total_cases"), F.avg(F.coalesce(F.col(time), F.lit(0.0))).alias("avg_execution_time"),
        *[F.avg(m).alias(f"avg_{m}") for m in METRICS if m in cases.columns])


def evaluation_flags(summary: DataFrame) -> Column:
    """Names of the problems a summary shows."""
    return F.array_compact(F.array(
        F.when(F.coalesce("avg_precision", F.lit(1.0)) < 0.7, "Low Precision"),
        F.when(F.coalesce("avg_recall", F.lit(1.0)) < 0.7, "Low Recall"),
        F.when(F.coalesce("avg_execution_time", F.lit(0.0)) > 5.0, "Slow Response Time")))


def ranking_metrics(run: DataFrame, qrels: DataFrame, query: str = "query_id") -> DataFrame:
    """nDCG@10, average precision at 5 and reciprocal rank at 10 per query that has results."""
    hits = judge(run.filter(F.col("rank") <= 10), qrels, query)
    gain = lambda rel, rank: rel / F.log2(rank + F.lit(1.0))
    relevant = qrels.filter(F.col("rel") > 0)
    ideal = top_k(relevant, query, [F.col("rel").desc()], 10, "pos").groupBy(query).agg(
        F.sum(gain(F.col("rel"), F.col("pos"))).alias("idcg"))
    n_rel = relevant.groupBy(query).agg(F.count("*").alias("n_rel"))
    # At most ten rows per query, so the fold over the ranked list is bounded.
    lists = hits.groupBy(query).agg(F.array_sort(F.collect_list(F.struct("rank", "rel"))).alias("l"))
    got = F.aggregate(
        "l",
        F.struct(F.lit(0.0).alias("dcg"), F.lit(0.0).alias("ap"), F.lit(0).alias("seen"), F.lit(0.0).alias("rr")),
        lambda a, x: F.struct(
            (a["dcg"] + gain(x["rel"], x["rank"])).alias("dcg"),
            F.when((x["rel"] > 0) & (x["rank"] <= 5), a["ap"] + (a["seen"] + 1) / x["rank"]).otherwise(a["ap"]).alias("ap"),
            (a["seen"] + (x["rel"] > 0).cast("int")).alias("seen"),
            F.when((a["rr"] == 0) & (x["rel"] > 0), 1.0 / x["rank"]).otherwise(a["rr"]).alias("rr"),
        ),
    )
    scored = lists.select(query, got.alias("g")).join(ideal, query, "left").join(n_rel, query, "left")
    return scored.select(
        query, F.coalesce(F.try_divide(F.col("g.dcg"), F.col("idcg")), F.lit(0.0)).alias("ndcg10"),
        F.coalesce(F.try_divide(F.col("g.ap"), F.least("n_rel", F.lit(5))), F.lit(0.0)).alias("map5"), F.col("g.rr").alias("mrr10"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


