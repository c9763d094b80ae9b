"""Paging, ranking, de-duplication, set algebra and joins over catalogs, plus budgets along an order."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.operators.running import earliest, row_numbers, running, running_sum, top_k
from corpusloom.session import cut_lineage

# --- paging -------------------------------------------------------------------------------------------


def list_mean(values: Column) -> Column:
    """Sort key of a list column."""
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double")), F.size(values))


def with_total(page: DataFrame, whole: DataFrame) -> DataFrame:
    """Page rows with the size of the unpaged result."""
    return page.withColumn("total", whole.agg(F.count("*")).scalar())


def after(df: DataFrame, keys: list[str], values: list, n: int) -> DataFrame:
    """Keyset paging: the next ``n`` rows after the last sort key seen."""
    last = F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, values)])
    return df.filter(F.struct(*keys) > last).orderBy(*keys).limit(n)


def rerank_window(page: int, size: int, top: int = 1024, reranker: bool = False) -> tuple[int, int, int]:
    """(offset of the candidate window, its length, first row of the page inside it)."""
    length = max(30, math.ceil(64 / size) * size) if size > 1 else 30
    if reranker:
        length = min(length, top, 64)
    start = (page - 1) * size
    return (start // length) * length, length, start % length


def window_page(ranked: DataFrame, by: str, order: list[Column], page: int, size: int, **kwargs) -> DataFrame:
    """Rows of one page, cut from the candidate window the page falls in."""
    offset, length, begin = rerank_window(page, size, **kwargs)
    best = top_k(ranked, by, order, offset + length, "rank").filter(F.col("rank") > offset)
    inside = F.col("rank") - offset
    return best.filter((inside > begin) & (inside <= begin + size))


def threshold_rank(hits: DataFrame, by, score: str, threshold: float, tie: str, vector_weight: float = 1.0, k: int | None = None) -> DataFrame:
    """Rank by descending score after dropping rows under the threshold (no threshold without vectors)."""
    limit = threshold if vector_weight > 0 else 0.0
    kept = hits.filter(F.col(score) >= limit)
    order = [F.col(score).desc(), F.col(tie)]
    return top_k(kept, by, order, k) if k else row_numbers(kept, by, order, "rank")


def scatter_gather(frames: list[DataFrame], order: list[Column], n: int) -> DataFrame:
    """The same search over many tables, merged and cut once."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).orderBy(*order).limit(n)


def keep_first(df: DataFrame, columns: list[str], order: Column) -> DataFrame:
    """First row among rows whose canonical JSON of ``columns`` is equal."""
    keyed = df.withColumn("__key", F.sha2(F.to_json(F.struct(*sorted(columns))), 256))
    return earliest(keyed, "__key", order).drop("__key")


def merge_rounds(hits: DataFrame, keys: list[str], round_column: str) -> DataFrame:
    """Hits of several queries: every key once, from the round that saw it first."""
    return earliest(hits, keys, F.col(round_column))


def key_diff(old: DataFrame, new: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """added / updated / unchanged / removed per key, from fingerprints."""
    a = old.select(F.col(key), F.col(fingerprint).alias("__a"))
    b = new.select(F.col(key), F.col(fingerprint).alias("__b"))
    both = a.withColumn("__ina", F.lit(True)).join(b.withColumn("__inb", F.lit(True)), key, "full")
    status = (
        F.when(F.col("__ina").isNull(), "added").when(F.col("__inb").isNull(), "removed")
        .when(F.col("__a").eqNullSafe(F.col("__b")), "unchanged").otherwise("updated")
    )
    return both.select(key, status.alias("status"))


# --- budgets ------------------------------------------------------------------------------------------


def pack_budget(items: DataFrame, by, order, tokens: str, budget: int, mode: str = "knowledge") -> DataFrame:
    """Items kept while the running token count fits.

    ``knowledge`` keeps the item that crosses 97 % of the budget, ``memory`` stops before the budget is exceeded.
    """
    summed = running_sum(items, by, order, F.col(tokens), "used")
    if mode == "knowledge":
        return summed.filter(F.col("used") - F.col(tokens) <= 0.97 * budget)
    return summed.filter(F.col("used") <= budget)


def fifo_eviction(messages: DataFrame, by: str, size: str, need: Column, tie: str) -> DataFrame:
    """Messages to drop: forgotten ones by ``forget_at`` first, then the oldest, until ``need`` is freed."""
    order = [F.col("forget_at").isNull(), F.coalesce("forget_at", "valid_at"), F.col(tie)]
    summed = running_sum(messages, by, order, F.col(size), "freed")
    return summed.filter(F.col("freed") - F.col(size) < need)


def split_budget(rows: DataFrame, by: str, weight: str, budget: int, position: list[str]) -> DataFrame:
    """Integer shares of ``budget`` in proportion to ``weight``: floors, then one more to the largest fractions."""
    totals = rows.groupBy(by).agg(F.sum(weight).alias("__total"), F.count("*").alias("__n"))
    positive = F.col("__total") > 0
    raw = F.when(positive, F.lit(budget) * F.col(weight) / F.nullif(F.col("__total"), F.lit(0))).otherwise(F.lit(float(budget)) / F.col("__n"))
    floors = rows.join(totals, by).withColumn("__raw", raw).withColumn("__floor", F.floor("__raw").cast("long"))
    # An even split hands the leftover out by position alone.
    floors = floors.withColumn("__frac", F.when(positive, F.col("__raw") - F.col("__floor")).otherwise(0.0))
    left = floors.groupBy(by).agg((F.lit(budget) - F.sum("__floor")).alias("__left"))
    ranked = row_numbers(floors, by, [F.col("__frac").desc()] + [F.col(p) for p in position], "__rn")
    share = F.col("__floor") + (F.col("__rn") <= F.col("__left")).cast("long")
    return ranked.join(left, by).select(*rows.columns, share.alias("share"))


def free_names(new: DataFrame, taken: DataFrame, name: str, order: str) -> DataFrame:
    """Distinct names for new rows: the first free of ``name``, ``name(1)``, ``name(2)``… before the extension.

    The k-th claimant of a name gets its k-th free counter, which is k plus the number of taken counters that have
    fewer than k free ones below them: one running sum over claimants and taken counters together.
    """
    stem = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)
    suffix = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    used = taken.select(name).distinct().select(
        F.concat(F.regexp_replace(stem, r"\([0-9]+\)$", ""), suffix).alias("__base"),
        F.coalesce(F.regexp_extract(stem, r"\(([0-9]+)\)$", 1).try_cast("long"), F.lit(0)).alias("__c"))
    used = row_numbers(used.distinct(), "__base", ["__c"], "__i").select(
        "__base", (F.col("__c") - F.col("__i") + 1).alias("__k"), F.lit(1).alias("__taken"), F.lit(None).cast("long").alias("__order"))
    claims = row_numbers(new, name, [order], "__k").withColumn("__k", F.col("__k") - 1)
    stream = claims.select(F.col(name).alias("__base"), "__k", F.lit(0).alias("__taken"), F.col(order).cast("long").alias("__order")).unionByName(used)
    # A taken counter with no more free ones below it than the claim index comes first.
    placed = running(stream, "__base", ["__k", F.col("__taken").desc(), "__order"], {"__skip": F.col("__taken")}).filter(F.col("__taken") == 0)
    counter = F.col("__k") + F.col("__skip")
    base = F.col("__base")
    stem_b, suffix_b = F.regexp_extract(base, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(base, r"^(.*?)(\.[^.]*)?$", 2)
    final = F.when(counter == 0, base).otherwise(F.concat(stem_b, F.lit("("), counter.cast("string"), F.lit(")"), suffix_b))
    return placed.select(F.col("__order").alias(order), base.alias(name), final.alias("free_name"))


def version_parts(version: Column) -> Column:
    """Sortable struct of a three-part numeric version, null when malformed."""
    parts = F.split(version, r"\.")
    numbers = [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]
    ok = (F.size(parts) == 3) & numbers[0].isNotNull() & numbers[1].isNotNull() & numbers[2].isNotNull()
    return F.when(ok, F.struct(numbers[0].alias("major"), numbers[1].alias("minor"), numbers[2].alias("patch")))


def latest_version(df: DataFrame, by: str, version: str) -> DataFrame:
    known = df.withColumn("__v", version_parts(F.col(version))).filter(F.col("__v").isNotNull())
    return known.groupBy(by).agg(F.max_by(version, "__v").alias(version))


def document_progress(tasks: DataFrame, doc: str, progress: str) -> DataFrame:
    """Mean of the non-negative task progress; -1 and failed once all are settled with a failure; 1 when done."""
    p = F.col(progress)
    stats = tasks.groupBy(doc).agg(
        F.sum(F.greatest(p, F.lit(0.0))).alias("sum"), F.count("*").alias("n"),
        F.bool_or((p >= 0) & (p < 1)).alias("open"), F.bool_or(p == -1).alias("bad"))
    return stats.select(
        doc, F.when(F.col("open"), F.col("sum") / F.col("n")).when(F.col("bad"), -1.0).otherwise(1.0).alias("progress"),
        F.when(F.col("open"), "running").when(F.col("bad"), "fail").otherwise("done").alias("status"))


# --- hierarchies ----------------------------------------------------------------------------------------


def ancestors(nodes: DataFrame, node: str = "id", parent: str = "parent") -> DataFrame:
    """``(id, ancestor, depth)`` for every node, itself at depth 0; one join per level of the tree. A cycle raises."""
    links = nodes.select(F.col(node).alias("ancestor"), F.col(parent).alias("__up")).filter(F.col("__up").isNotNull())
    frontier = nodes.select(F.col(node).alias("id"), F.col(node).alias("ancestor"), F.lit(0).alias("depth"))
    levels, most, depth = [frontier], nodes.count(), 0
    while True:
        depth += 1
        if depth > most:
            raise ValueError("the parents form a cycle")
        frontier = cut_lineage(
            frontier.join(links, "ancestor").select("id", F.col("__up").alias("ancestor"), F.lit(depth).alias("depth")))
        if frontier.isEmpty():
            return reduce(lambda a, b: a.unionByName(b), levels)
        levels.append(frontier)


def subtree_sizes(nodes: DataFrame, size: str, node: str = "id", parent: str = "parent") -> DataFrame:
    """Total size and node count under every node."""
    pairs = ancestors(nodes, node, parent)
    return pairs.join(nodes.select(F.col(node).alias("id"), F.col(size).alias("__s")), "id").groupBy("ancestor").agg(
        F.sum("__s").alias("size"), F.count("*").alias("n"))


def due_tasks(last: DataFrame, config: DataFrame, key: str, updated: str, minutes: str, now) -> DataFrame:
    """Distinct tasks whose last update is older than their own period, newest first."""
    now = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    joined = last.join(config, key)
    limit = F.timestamp_add("MINUTE", -F.col(minutes), now)
    return joined.filter(F.col(updated).cast("timestamp") < limit).distinct().orderBy(F.col(updated).desc())


# --- runs along an order inside one document ---------------------------------------------------------------


def per_document(doc: str = "doc_id", pos: str = "pos") -> Window:
    """Window over the lines of a document. The lines come from one input row, which bounds the group."""
    return Window.partitionBy(doc).orderBy(pos)
