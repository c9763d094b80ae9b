"""Mixing sources to target weights by pivotal dependent rounding.

Every row of a source should be taken ``target / size of the source`` times on average. The whole part of that number is
taken outright. The fraction is a copy probability, and these are rounded together: two rows are paired, and words (the
mass, probability times size) move from one to the other, in a random direction, until one of the two probabilities is 0
or 1. The expected copies of every row stay what they were and the words of the pair do not change, so a source
misses its target by at most one row, the last one left.

Pairing is a reduction tree: rows fall into blocks of about ``BLOCK`` rows of one source by a hash of their key, a block is
folded in one pass and leaves one fractional row at most, and the rows that are left go to the next level until a
source has one block. Rows that are equal in key, source and size are folded as one row of several copies, so neither a hot
source nor a key repeated without end makes a large block.

Null sources are a source of their own and come last. Null and empty texts have size 0: they are taken the whole part of
their number of times. An empty table gives an empty result. Repeated rows share their group's copies as evenly as possible.
The random numbers are hashes of the key and the seed, so reruns agree whatever the partitions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import uniform
from corpusloom.session import cut_lineage

BLOCK = 64
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Blank-separated words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``: a row for each source.

    Sources in code-point order, null last, weigh ``weights``, repeating, and share ``share`` of all sizes; a target stops
    at ``limit`` times its source's size and what is too much is shared again by weight. In closed form: sorted by the level
    at which a source is full, the first ones are full and the rest get ``level * weight``. The table has a row for each source, not for each document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.lit(list(weights)).cast("array<double>"), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    full = F.lit(float(limit)) * F.col("source_size")
    rows = sizes.select("source", "source_size", weight.alias("w"), full.cast("double").alias("full")).withColumn("at", F.col("full") / F.col("w"))
    by_level = Window.orderBy("at", F.col("source").asc_nulls_last())
    upto, after = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow), by_level.rowsBetween(1, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # After the first sources up to this one are full, the rest share what is left at this level.
    rows = rows.withColumns({"all": F.sum("source_size").over(whole) * F.lit(float(share)), "used": F.sum("full").over(upto), "rest": F.coalesce(F.sum("w").over(after), F.lit(0.0))})
    rows = rows.withColumn("level", (F.col("all") - (F.col("used") - F.col("full"))) / (F.col("rest") + F.col("w")))
    is_full = F.col("level") >= F.col("at")
    # The level that holds is the one at the first source that is not full.
    rows = rows.withColumn("final", F.min(F.when(~is_full, F.struct("at", "level"))).over(whole))
    target = F.when(F.col("final").isNull() | (F.col("at") < F.col("final.at")), F.col("full")).otherwise(F.least(F.col("full"), F.col("final.level") * F.col("w")))
    return rows.select("source", "source_size", target.alias("target"))


def _fold(seed: int, level: int) -> Column:
    """Fold ``rows`` (array of id, w, p) of a block: all of them with their final p, but one, which is left as it is."""
    kind = "struct<id:bigint,w:bigint,p:double>"
    row = lambda r, p: F.struct(r["id"].alias("id"), r["w"].alias("w"), p.alias("p"))
    let = lambda v, f: F.transform(F.array(v), f)[0]

    def pair(a, j):
        i = a["held"]

        def move(m):
            total = m["there"] + m["back"]
            # Mass moves to the new row with a probability that keeps what each row expects.
            go = F.when(total <= 0, True).otherwise(uniform(i["id"], j["id"], F.lit(seed), F.lit(level)) * total < m["back"])
            clip = lambda p: F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
            there, back = m["there"], m["back"]
            empties_i, empties_j = there >= i["p"] * i["w"], back >= j["p"] * j["w"]
            pi = F.when(go, F.when(empties_i, F.lit(0.0)).otherwise(clip(i["p"] - there / i["w"]))).otherwise(F.when(empties_j, clip(i["p"] + back / i["w"])).otherwise(F.lit(1.0)))
            pj = F.when(go, F.when(empties_i, clip(j["p"] + there / j["w"])).otherwise(F.lit(1.0))).otherwise(F.when(empties_j, F.lit(0.0)).otherwise(clip(j["p"] - back / j["w"])))
            i_done = F.when(go, empties_i).otherwise(~empties_j)
            return F.struct(
                F.when(i_done, row(j, pj)).otherwise(row(i, pi)).alias("held"),
                F.concat(a["out"], F.array(F.when(i_done, row(i, pi)).otherwise(row(j, pj)))).alias("out"))

        there = F.least(i["p"] * i["w"], (1 - j["p"]) * j["w"])
        back = F.least(j["p"] * j["w"], (1 - i["p"]) * i["w"])
        return let(F.struct(there.alias("there"), back.alias("back")), move)

    rows = F.array_sort("rows", lambda x, y: F.when(x["w"] != y["w"], F.when(x["w"] > y["w"], -1).otherwise(1)).otherwise(F.when(x["id"] < y["id"], -1).when(x["id"] > y["id"], 1).otherwise(0)))
    start = lambda r: F.struct(r[0].alias("held"), F.array().cast(f"array<{kind}>").alias("out"))
    return let(rows, lambda r: F.aggregate(F.slice(r, 2, F.size(r)), start(r), pair))


def mix_counts(rows: DataFrame, seed: int = 0, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Copies of each row of ``rows (key, source, size)``: ``(key, source, size, source_size, target, nth, copies)``.

    ``nth`` numbers equal rows from 1; every other row has 1. No row is taken more than ``limit`` times, rounded up.
    """
    units = cut_lineage(rows.groupBy("key", "source", "size").agg(F.count("*").alias("n")))
    targets = source_targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, limit)
    sources = units.groupBy("source").agg(F.count("*").alias("units"))
    facts = cut_lineage(targets.join(sources, targets["source"].eqNullSafe(sources["source"])).select(targets["source"].alias("src"), "source_size", "target", "units"))
    most = facts.agg(F.max("units")).first()[0] or 0
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = F.col("each") * F.col("n")
    whole = F.floor(wanted + F.lit(1e-9)).cast("long")
    full = units.join(facts, units["source"].eqNullSafe(facts["src"])).withColumn("each", each)
    full = full.withColumns({"whole": whole, "p": F.greatest(wanted - whole, F.lit(0.0)), "id": F.xxhash64("key", "source", "size")})
    full = full.withColumn("p", F.when((F.col("size") > 0) & (F.col("p") > 1e-9), F.col("p")).otherwise(F.lit(0.0)))
    # The first level carries what a row needs in the end; the higher ones only see the rows left over.
    info = F.struct("id", "key", "size", "n", "whole")
    blocks = F.greatest(F.ceil(F.col("units") / BLOCK), F.lit(1))
    first = full.groupBy("src", "source_size", "target", "units", F.pmod(F.col("id"), blocks).cast("long").alias("block")).agg(
        F.collect_list(F.when(F.col("p") > 0, F.struct("id", F.col("size").alias("w"), "p"))).alias("rows"), F.collect_list(info).alias("info"))
    folded = first.withColumn("f", F.when(F.size("rows") > 0, _fold(seed, 0)))
    base = cut_lineage(folded.select("src", "source_size", "target", "units", "block", "info", F.col("f.held").alias("held"), F.col("f.out").alias("out")))
    left = base.filter("held is not null").select("src", "block", F.ceil(F.col("units") / BLOCK).alias("blocks"), "held")
    settled = None
    level, size = 1, -(-most // BLOCK)
    while size > 1:
        up = left.groupBy("src", F.floor(F.col("block") / BLOCK).cast("long").alias("block")).agg(F.collect_list("held").alias("rows"))
        up = cut_lineage(up.withColumn("f", _fold(seed, level)).select("src", "block", F.col("f.held").alias("held"), F.col("f.out").alias("out")))
        rows_up = up.select(F.explode("out").alias("r")).select("r.id", "r.p")
        settled = rows_up if settled is None else settled.unionByName(rows_up)
        left = up.select("src", "block", "held")
        level, size = level + 1, -(-size // BLOCK)
    # The last row of a source is rounded by itself.
    last = left.select("held.id", F.when(uniform(F.col("held.id"), F.lit(seed), F.lit("last")) < F.col("held.p"), 1.0).otherwise(0.0).alias("p"))
    settled = last if settled is None else settled.unionByName(last)
    ups = settled.filter("p >= 0.5").select(F.col("id").alias("up_id"))
    # A block leaves one row; whether it was rounded up joins that row alone.
    tops = base.select("src", "block", F.col("held.id").alias("held_id")).filter("held_id is not null").join(ups, F.col("held_id") == F.col("up_id")).select(F.col("src").alias("s2"), F.col("block").alias("b2"), "up_id")
    done = base.join(tops, base["src"].eqNullSafe(tops["s2"]) & (base["block"] == tops["b2"]), "left")
    ones = F.array_compact(F.concat(F.transform(F.filter(F.coalesce("out", F.array().cast("array<struct<id:bigint,w:bigint,p:double>>")), lambda r: r["p"] >= 0.5), lambda r: r["id"]), F.array("up_id")))
    flat = done.withColumn("ones", ones).select("src", "source_size", "target", "ones", F.explode("info").alias("i"))
    taken = F.col("i.whole") + F.array_contains("ones", F.col("i.id")).cast("long")
    each_row = flat.select(F.col("i.key").alias("key"), F.col("src").alias("source"), F.col("i.size").alias("size"), "source_size", "target", F.col("i.n").alias("n"), taken.alias("t"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("i.n"))).alias("nth"))
    copies = F.floor(F.col("t") / F.col("n")) + (F.col("nth") <= F.pmod("t", "n")).cast("long")
    return each_row.select("key", "source", "size", "source_size", "target", "nth", copies.cast("long").alias("copies"))


def mix_sources(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0, **targets) -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as it is taken, with all its columns."""
    size = word_count(F.col(text))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"))
    counts = mix_counts(keyed.select("key", "source", "size"), seed, **targets).filter("copies > 0")
    same = Window.partitionBy("key", "source", "size").orderBy(F.xxhash64("row"))
    numbered = keyed.withColumn("nth", F.row_number().over(same).cast("long"))
    on = [numbered[c].eqNullSafe(counts[c]) for c in ("key", "source", "size", "nth")]
    return numbered.join(counts, on).select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
