"""Structure along the lines of a document, and the joins that build chunk records.

Windows here are partitioned by document. All lines of a document come from one input row, so that row bounds the
group; nothing spans documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions import text as X
from corpusloom.operators.running import row_numbers

BODY_LEVEL = 99


# --- titles and sections --------------------------------------------------------------------------------


def section_numbers(lines: DataFrame, doc: str, pos: str, level: str, target: int | Column) -> DataFrame:
    """Number sections: a new one at every line at or above the target level, except the first line."""
    order = Window.partitionBy(doc).orderBy(pos)
    starts = (F.coalesce(F.col(level) <= target, F.lit(False)) & F.lag(pos).over(order).isNotNull()).cast("long")
    marked = lines.withColumn("__s", starts)
    return marked.withColumn("section", F.sum("__s").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__s")


def heading_path(lines: DataFrame, doc: str, pos: str, level: str, title: Column, depth: int) -> DataFrame:
    """Array of the titles in force at each line, outermost first; a title ends those at its level and below."""
    upto = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    last = {
        f"__h{k}": F.last(F.when(F.col(level) == k, F.struct(F.col(pos).alias("p"), title.alias("t"))), ignorenulls=True).over(upto)
        for k in range(1, depth + 1)
    }
    marked = lines.withColumns(last)
    parts, outer = [], F.lit(-1).cast("long")
    for k in range(1, depth + 1):
        h = F.col(f"__h{k}")
        parts.append(F.when(h["p"] > outer, h["t"]))
        outer = F.greatest(outer, F.coalesce(h["p"], F.lit(-1)))
    return marked.withColumn("path", F.array_compact(F.array(*parts))).drop(*last)


def frequent_level(lines: DataFrame, doc: str, level: str) -> DataFrame:
    """Most common title level of every document that has titles."""
    counts = lines.filter(F.col(level) < BODY_LEVEL).groupBy(doc, level).agg(F.count("*").alias("__n"))
    return counts.groupBy(doc).agg(F.min_by(level, F.struct(-F.col("__n"), F.col(level))).alias(level))


def hierarchy_level(lines: DataFrame, doc: str, level: str, k: int) -> DataFrame:
    """The k-th distinct title level of a document, or its last one."""
    found = F.array_sort(F.collect_set(F.when(F.col(level) < BODY_LEVEL, F.col(level))))  # at most a handful of levels
    levels = lines.groupBy(doc).agg(found.alias("__l")).filter(F.size("__l") > 0)
    return levels.select(doc, F.get("__l", F.least(F.lit(max(k, 1)), F.size("__l")) - 1).alias("target"))


# --- context ------------------------------------------------------------------------------------------


def sentences(text: Column) -> Column:
    """Sentences with their closing mark."""
    marked = F.regexp_replace(text, r"([。!?？；！\n]|\. )", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: s != "")


def take_sentences(text: Column, need: Column, from_end: bool) -> Column:
    """Sentences from one end until the token budget is reached."""
    parts = F.reverse(sentences(text)) if from_end else sentences(text)
    join = (lambda a, s: F.concat(s, a)) if from_end else (lambda a, s: F.concat(a, s))
    return F.aggregate(
        parts,
        F.struct(F.lit("").alias("t"), F.lit(0).alias("n")),
        lambda a, s: F.when(a["n"] >= need, a).otherwise(
            F.struct(join(a["t"], s).alias("t"), (a["n"] + X.token_count(s)).alias("n"))),
        lambda a: a["t"],
    )


def neighbour_context(chunks: DataFrame, doc: str, pos: str, text: str, tokens: str, kind: str, budget: int) -> DataFrame:
    """Text around every table or image chunk: ``(doc, pos, side, part_pos, n, part)``.

    Text chunks are placed on a token axis. Those within the budget of the anchor are found through buckets as wide as
    the budget, so an anchor meets a few chunks, not its whole document. The chunk that reaches the budget is cut at
    sentences.
    """
    order = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    is_text = F.col(kind) == "text"
    placed = chunks.withColumn("__cum", F.sum(F.when(is_text, F.col(tokens)).otherwise(0)).over(order))
    anchors = placed.filter(~is_text).select(doc, F.col(pos).alias("__a"), F.col("__cum").alias("__at"))
    spans = placed.filter(is_text).select(
        doc, F.col(pos).alias("part_pos"), text, tokens, (F.col("__cum") - F.col(tokens)).alias("__from"), F.col("__cum").alias("__to"))

    def side(near: str, before: bool) -> DataFrame:
        cell = F.floor(F.col("__at") / budget)
        reach = F.explode(F.array(cell, cell - 1 if before else cell + 1))
        left = anchors.withColumn("__b", reach)
        right = spans.withColumn("__b", F.floor(F.col(near) / budget))
        gap = F.col("__at") - F.col("__to") if before else F.col("__from") - F.col("__at")
        ahead = F.col("part_pos") < F.col("__a") if before else F.col("part_pos") > F.col("__a")
        hit = left.join(right, [doc, "__b"]).filter(ahead & (gap < budget)).withColumn("__need", budget - gap)
        cut = F.when(F.col(tokens) >= F.col("__need"), take_sentences(F.col(text), F.col("__need"), before)).otherwise(F.col(text))
        return hit.select(doc, F.col("__a").alias(pos), F.lit("above" if before else "below").alias("side"), "part_pos", F.col(tokens).alias("n"), cut.alias("part"))

    return side("__to", True).unionByName(side("__from", False))


# --- chunk records -------------------------------------------------------------------------------------


def outer_merge(frames: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def attach_metadata(chunks: DataFrame, meta: DataFrame, doc: str, field: str, keys: list[str], name: str) -> DataFrame:
    """Chosen metadata keys of the document on every chunk; nothing chosen, no value."""
    chosen = F.map_filter(field, lambda k, v: k.isin(keys))
    small = meta.select(doc, F.when(F.size(chosen) > 0, chosen).alias(name))
    return chunks.join(small, doc, "left")


def with_parents(children: DataFrame, parents: DataFrame, key: str, id: str, parent_text: str, text: str) -> DataFrame:
    """Children with their parent id, plus every distinct text of a parent that has children once as an unavailable row.

    ``children (key, id, text)`` meet their ``parents (key, parent_text)`` by ``key``. A child meets the id of its parent and not its
    text, so a long text does not travel once for each of its children.
    """
    known = parents.select(key, F.md5(parent_text).alias("parent_id"), F.col(parent_text).alias("__text"))
    rows = children.join(known.select(key, "parent_id"), key).select(id, "parent_id", F.lit(1).alias("available"), F.col(text).alias("text"))
    held = known.join(children.select(key).distinct(), key, "left_semi").dropDuplicates(["parent_id"])
    return rows.unionByName(held.select(F.col("parent_id").alias(id), F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("available"), F.col("__text").alias("text")))


def nest_extracts(raw: DataFrame, extracts: DataFrame, id: str, source: str, extract: str) -> DataFrame:
    """Raw messages with their extracts in order, one row per extract (one row when there is none)."""
    numbered = row_numbers(extracts, source, [extract], "ordinal")
    return raw.join(numbered.withColumnRenamed(source, id), id, "left")
