"""Running sums and ranks that survive a group holding a third of all rows.

A window partitioned by a hot key puts that whole key into one task. Here the rows are range-partitioned by
(group, order) instead, so a large group spreads over many partitions. Each partition is summed on its own, and
the sums of the earlier partitions of the same group are added as an offset. A group that fits one partition
needs no offset, and every partition starts inside at most one group, so the offset table has fewer rows than
there are partitions: that is the proven bound that makes broadcasting it safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.session import cut_lineage


def _names(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def running(df: DataFrame, by, order: list[Column | str], sums: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums of ``sums`` (output name -> value) within ``by``, ordered by ``order``.

    ``order`` must be a total order inside each group, otherwise ties are broken arbitrarily.
    """
    by = _names(by)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    sort = [F.col(b) for b in by] + order
    placed = (
        df.withColumns({f"__v_{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()})
        .repartitionByRange(parts, *sort)
        .withColumn("__p", F.spark_partition_id())
    )
    # The partition ids must not change between the two uses below, even if an executor is lost.
    placed = cut_lineage(placed)
    totals = placed.groupBy(*by, "__p").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__p", *[F.sum(f"__t_{n}").over(before).alias(f"__b_{n}") for n in sums]).filter(
        F.col(f"__b_{next(iter(sums))}").isNotNull()
    )
    within = Window.partitionBy("__p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({n: F.sum(f"__v_{n}").over(within) for n in sums})
    match = F.col("l.__p") == F.col("r.__p")
    for b in by:
        match = match & F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}"))
    joined = local.alias("l").join(F.broadcast(offsets).alias("r"), match, "left")
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"l.{n}") + F.coalesce(F.col(f"r.__b_{n}"), F.lit(0))).alias(n) for n in sums],
    )


def running_sum(df: DataFrame, by, order, value: Column, name: str) -> DataFrame:
    return running(df, by, order, {name: value})


def row_numbers(df: DataFrame, by, order, name: str = "rn") -> DataFrame:
    """1-based position within each group, without a one-task window."""
    return running(df, by, order, {name: F.lit(1).cast("long")})


def nearest_rank(df: DataFrame, by, value: str, shares: dict[str, float]) -> DataFrame:
    """Exact nearest-rank percentiles: counts per distinct value, running counts, first value past the rank."""
    by = _names(by)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    placed = running(counted, by, [value], {"__cum": F.col("__n")})
    total = counted.groupBy(*by).agg(F.sum("__n").alias("__total"))
    if by:
        both = placed.join(total, by)
    else:
        both = placed.withColumn("__total", total.select("__total").scalar())
    return both.groupBy(*by).agg(
        *[
            F.min(F.when(F.col("__cum") >= F.greatest(F.ceil(F.col("__total") * F.lit(p)), F.lit(1)), F.col(value))).alias(n)
            for n, p in shares.items()
        ]
    )


def top_k(df: DataFrame, by, order, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group. Spark prunes to ``k`` per group before the shuffle."""
    window = Window.partitionBy(*_names(by)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def latest(df: DataFrame, by, order: Column) -> DataFrame:
    """One row per key, the one with the greatest ``order``; combined on the map side, so hot keys are cheap."""
    by = _names(by)
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return best.select(*by, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def earliest(df: DataFrame, by, order: Column) -> DataFrame:
    """One row per key, the one with the least ``order``."""
    by = _names(by)
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return best.select(*by, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def blocks(df: DataFrame, by, item: str, size: int = 4096, name: str = "items") -> DataFrame:
    """Posting lists in bounded blocks: ``(by..., block, n, items)``, at most ``size`` sorted items each.

    The block is a range of the integer ``item``, so a key that holds a third of all rows still makes many
    small groups.
    """
    block = F.floor(F.col(item) / F.lit(size)).cast("long")
    grouped = df.withColumn("block", block).groupBy(*_names(by), "block")
    items = F.array_sort(F.collect_set(item))
    return grouped.agg(items.alias(name)).withColumn("n", F.size(name).cast("long"))
