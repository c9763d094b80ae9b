"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows lie in input partitions. How many rows of partition ``p`` go to shard ``s`` in a uniformly random shuffle with fixed
shard sizes is one draw of a multivariate hypergeometric matrix. The matrix is drawn first, from row counts alone; then
each partition permutes its rows and deals them out by its line of the matrix, the rows are exchanged once, and each shard
permutes what it received. Only DataFrame functions are used; the one shuffle of whole rows is the exchange itself.

The matrix is drawn down a tree: a node holds how many rows of its partitions each shard takes, and splits that line
among its ``FAN`` children, so no task or driver loop sees all partitions. A single hypergeometric number is drawn by
inversion of its distribution function around the mode.

A shard's rows are permuted in blocks of about ``block_rows``: a row falls into a block by a random number, blocks are
sorted by another one, and the block's offset comes from counts. So a shard of any size is sorted by many tasks.

Input partitions must be the same whenever the input is read: Parquet and other files are. For any other input pass
``stable=False``; it is then written to the shared folder first. A row past the counted rows of its partition raises.

Null texts and keys, empty tables (no rows out), repeated rows (dealt out one by one), extra columns (kept; the added
names are arguments) need nothing special, as rows are only counted and numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import stored, uniform
from corpusloom.session import cut_lineage

FAN = 16
#: A matrix of at most so many numbers (8 bytes each) is sent to every task; a larger one is joined by partition.
BROADCAST_CELLS = 1 << 22


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """One draw: how many of ``drawn`` rows out of ``total`` are among its ``good`` ones, by inversion of ``u`` in [0, 1).

    Only values within 12 standard deviations and 20 around the mode are weighed; what lies beyond has less probability
    than ``u`` can resolve.
    """
    d = lambda c: c.cast("double")
    lowest = F.greatest(F.lit(0).cast("long"), drawn + good - total)
    highest = F.least(drawn, good)

    def around(s):
        mode = F.floor(d(drawn + 1) * d(good + 1) / d(total + 2)).cast("long")
        share = d(good) / d(total)
        width = F.ceil(12 * F.sqrt(d(drawn) * share * (1 - share))).cast("long") + 20
        return F.struct(F.greatest(lowest, mode - width).alias("lo"), F.least(highest, mode + width).alias("hi"))

    def up(k, w):  # the weight of k + 1 from that of k
        return w * d(good - k) * d(drawn - k) / (d(k + 1) * d(total - good - drawn + k + 1))

    def pick(r):
        lo, hi = r["lo"], r["hi"]
        steps = F.when(hi > lo, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<bigint>"))
        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"))
        whole = F.aggregate(steps, start, lambda a, k: _let(up(k, a["w"]), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))), lambda a: a["sum"])
        return _let(whole * u, lambda aim: F.aggregate(
            steps, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), lo.alias("k")),
            lambda a, k: F.when(a["sum"] > aim, a).otherwise(_let(up(k, a["w"]), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"), (k + 1).alias("k")))),
            lambda a: a["k"]))

    plain = F.when(highest <= lowest, lowest)
    return plain.otherwise(_let(around(None), pick))


def _line(rest: Column, size: Column, node: Column, seed: int) -> Column:
    """How many of ``size`` rows each shard takes, when ``rest`` is how many rows each shard takes of a larger set."""
    start = F.struct(F.aggregate(rest, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), size.alias("left"), F.array().cast("array<bigint>").alias("line"))

    def step(a, s):
        return _let(
            hypergeometric(a["total"], rest[s], a["left"], uniform(node, s, F.lit(seed))),
            lambda x: F.struct((a["total"] - rest[s]).alias("total"), (a["left"] - x).alias("left"), F.concat(a["line"], F.array(x)).alias("line")))

    return F.aggregate(F.sequence(F.lit(0), F.size(rest) - 1), start, step, lambda a: a["line"])


def communication_matrix(counts: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``(part, rows, line)``: for each input partition of ``counts (part long, rows long)`` how many rows go to each shard.

    Column sums are the shard sizes, which are at most one apart; row sums are the partitions' rows.
    """
    ranked = counts.select("part", "rows").filter("rows > 0")
    bounds = ranked.agg(F.max("part").alias("top"), F.sum("rows").alias("total")).first()
    total, top = bounds["total"] or 0, bounds["top"] or 0
    spark = counts.sparkSession
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    levels = 1
    while FAN**levels <= top:
        levels += 1
    tree = spark.range(1).select(F.lit(0).cast("long").alias("node"), F.lit(sizes).cast("array<bigint>").alias("line"))
    for level in range(levels - 1, -1, -1):
        child = F.floor(F.col("part") / F.lit(FAN**level)).cast("long")
        sums = ranked.groupBy(child.alias("child")).agg(F.sum("rows").alias("rows"))
        kin = sums.groupBy(F.floor(F.col("child") / FAN).cast("long").alias("parent")).agg(F.array_sort(F.collect_list(F.struct("child", "rows"))).alias("kin"))
        start = F.struct(F.col("line").alias("rest"), F.array().cast("array<struct<child:bigint,rows:bigint,line:array<bigint>>>").alias("out"))

        def deal(a, c):
            def keep(line):
                row = F.struct(c["child"].alias("child"), c["rows"].alias("rows"), line.alias("line"))
                return F.struct(F.zip_with(a["rest"], line, lambda r, x: r - x).alias("rest"), F.concat(a["out"], F.array(row)).alias("out"))

            return _let(_line(a["rest"], c["rows"], c["child"] * 64 + F.lit(level), seed), keep)  # noqa: B023

        dealt = tree.join(kin, tree["node"] == kin["parent"]).select(F.explode(F.aggregate("kin", start, deal, lambda a: a["out"])).alias("c"))
        tree = cut_lineage(dealt.select(F.col("c.child").alias("node"), F.col("c.rows").alias("rows"), F.col("c.line").alias("line")))
    return tree.select(F.col("node").alias("part"), "rows", "line")


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 0, block_rows: int = 2000, stable: bool = True, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """All rows of ``docs`` with a ``shard`` (int) and a ``slot`` in it (long, from 0 without gaps), uniformly at random for ``seed``."""
    docs = docs if stable else stored(docs, "shard-input")
    low = F.lit((1 << 33) - 1)
    names = {n: f"__{n}" for n in ("at", "part", "i", "line", "rows", "block", "rank", "before", "to", "b")}
    while any(n in docs.columns for n in names.values()):
        names = {k: f"_{v}" for k, v in names.items()}
    n = type("Names", (), names)
    counts = cut_lineage(docs.groupBy(F.spark_partition_id().cast("long").alias("part")).agg(F.count("*").alias("rows")))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    matrix = communication_matrix(counts, shards, seed).select(F.col("part").alias(n.part), F.col("rows").alias(n.rows), F.col("line").alias(n.line))
    if counts.count() * shards <= BROADCAST_CELLS:
        matrix = F.broadcast(matrix)
    blocks = max(1, total // (shards * block_rows))

    def dealt(rows: DataFrame) -> DataFrame:
        """The rows with their shard and block: a random order inside each partition, cut by the partition's line."""
        mixed = rows.withColumn(n.at, F.monotonically_increasing_id()).sortWithinPartitions(F.xxhash64(F.col(n.at), F.lit(seed)), n.at)
        placed = mixed.withColumns({n.i: F.monotonically_increasing_id()}).withColumns({n.part: F.shiftright(F.col(n.i), 33), n.i: F.col(n.i).bitwiseAND(low)})
        both = placed.join(matrix, n.part)
        start = F.struct(F.lit(0).alias("s"), F.col(n.i).alias("left"))
        cut = F.aggregate(n.line, start, lambda a, x: F.when((a["left"] < 0) | (a["left"] < x), F.struct(a["s"].alias("s"), F.lit(-1).cast("long").alias("left"))).otherwise(F.struct((a["s"] + 1).alias("s"), (a["left"] - x).alias("left"))), lambda a: a["s"])
        guard = F.when(F.col(n.i) < F.col(n.rows), cut).otherwise(F.raise_error(F.lit("the input partitions changed between reads: pass stable=False")).cast("int"))
        return both.withColumns({n.to: guard, n.b: F.pmod(F.xxhash64(F.col(n.at), F.lit(seed + 1)), F.lit(blocks))}).drop(n.line, n.rows, n.part, n.i)

    sizes = dealt(docs.select()).groupBy(n.to, n.b).agg(F.count("*").alias(n.rows))
    offsets = _offsets(cut_lineage(sizes), n, blocks)
    bin_ = [F.col(n.to), F.col(n.b)]
    from pyspark.sql import Window

    permuted = dealt(docs).withColumn(n.rank, F.row_number().over(Window.partitionBy(*bin_).orderBy(F.xxhash64(F.col(n.at), F.lit(seed + 2)), n.at)))
    out = permuted.join(offsets, [n.to, n.b])
    return out.select(*docs.columns, F.col(n.to).cast("int").alias(shard), (F.col(n.before) + F.col(n.rank) - 1).cast("long").alias(slot))


def _offsets(sizes: DataFrame, n, blocks: int) -> DataFrame:
    """Rows of a shard before each of its blocks: sums per thousand blocks first, so that no window sees all blocks of a shard."""
    from pyspark.sql import Window

    group = F.floor(F.col(n.b) / 1000)
    own = Window.partitionBy(n.to, "__g").orderBy(n.b).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(n.to).orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    grouped = sizes.withColumn("__g", group)
    totals = grouped.groupBy(n.to, "__g").agg(F.sum(n.rows).alias("__t"))
    totals = totals.select(n.to, "__g", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o"))
    local = grouped.withColumn("__l", F.coalesce(F.sum(n.rows).over(own), F.lit(0)))
    return local.join(totals, [n.to, "__g"]).select(n.to, n.b, (F.col("__l") + F.col("__o")).alias(n.before))
