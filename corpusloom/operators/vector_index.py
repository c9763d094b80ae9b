"""Approximate nearest vectors through an inverted file with product-quantised residuals.

Unit vectors are dealt to the cells of a k-means (MLlib, fitted on a bounded sample); what a cell's centre leaves of a vector is cut into
parts, and each part is stored as the number of its nearest code. The index is a table partitioned by cell, whose rows are
blocks of vectors of one cell, so a cell of any size is many rows. A search reads only the partitions of the cells its queries
probe, ranks their vectors by the codes, and scores the best ``refine * k`` of each query exactly. Queries and blocks meet in a
join on the cell; neither passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import vectors as VEC
from corpusloom.operators.running import top_k
from corpusloom.operators.vector_search import _matrix, _unit_rows, nearest
from corpusloom.session import cut_lineage, scratch_path

#: Vectors of a block, and queries of one.
BLOCK, QUERIES = 4096, 1024


@dataclass(frozen=True)
class VectorIndex:
    """``path``: blocks ``(cell, ids, codes, vectors)``; ``centres`` is cells x dim, ``books`` parts x codes x dim / parts (zeros fill up the last part)."""

    path: str
    item: str
    centres: np.ndarray
    books: np.ndarray


def _parts(m: np.ndarray, parts: int) -> np.ndarray:
    """Rows cut into equal parts: rows x parts x width."""
    width = -(-m.shape[1] // parts)
    return np.pad(m, ((0, 0), (0, width * parts - m.shape[1]))).reshape(len(m), parts, width)


def _nearest_code(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1)[None] - 2 * x @ book.T).argmin(1)


def _codebook(x: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds over a sample of one part."""
    book = x[rng.permutation(len(x))[:codes]].copy()
    for _ in range(rounds):
        own = _nearest_code(x, book)
        n = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, x)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


def build_index(items: DataFrame, item: str = "item_id", vector: str = "vector", cells: int | None = None, parts: int = 16, codes: int = 64, sample: int = 20_000, seed: int = 7) -> VectorIndex:
    """An index of all ``items`` with a vector. Centres and codes are fitted on about ``sample`` of them; ``cells`` is the root of their number, 4 096 at most."""
    spark = items.sparkSession
    rows = items.select(item, vector).filter(F.col(vector).isNotNull())
    n = rows.count()
    if not n:
        return VectorIndex("", item, np.zeros((0, 0)), np.zeros((0, 0, 0)))
    cells = min(cells or int(np.sqrt(n)) + 1, 4096, n)
    part_of = cut_lineage(rows.filter(F.pmod(F.xxhash64(item, F.lit(seed)), F.lit(1 << 20)) < min(1.0, sample / n) * (1 << 20)).select(VEC.unit(F.col(vector)).alias("u")))
    if part_of.isEmpty():
        part_of = cut_lineage(rows.limit(1).select(VEC.unit(F.col(vector)).alias("u")))
    model = KMeans(k=max(cells, 2), seed=seed, featuresCol="f", maxIter=10).fit(part_of.select(array_to_vector("u").alias("f")))
    centres = _unit_rows(np.array(model.clusterCenters()))
    taken = _unit_rows(_matrix(part_of.limit(2 * sample).toArrow().column("u").combine_chunks()))
    rest = _parts(taken - centres[(taken @ centres.T).argmax(1)], parts)
    rng = np.random.default_rng(seed)
    books = np.stack([_codebook(rest[:, p], min(codes, len(rest)), rng) for p in range(parts)])
    kind = items.schema[item].dataType.simpleString()

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _unit_rows(_matrix(batch.column(vector)))
            own = (m @ centres.T).argmax(1)
            left = _parts(m - centres[own], parts)
            coded = np.stack([_nearest_code(left[:, p], books[p]) for p in range(parts)], axis=1).astype(np.uint8)
            for cell in np.unique(own):
                at = np.flatnonzero(own == cell)
                for a in range(0, len(at), BLOCK):
                    some = at[a : a + BLOCK]
                    ids = batch.column(item).take(pa.array(some))
                    lists = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), ids)
                    yield pa.RecordBatch.from_arrays([pa.array([int(cell)], pa.int32()), lists, pa.array([coded[some].tobytes()]), pa.array([m[some].tobytes()])], names=["cell", "ids", "codes", "vectors"])

    path = scratch_path(spark, "vector-index")
    blocks = rows.mapInArrow(encode, f"cell int, ids array<{kind}>, codes binary, vectors binary")
    # A few tasks for each cell: few files, and no task holds all of a hot cell.
    blocks.repartition("cell", F.pmod(F.xxhash64("codes"), F.lit(4))).write.partitionBy("cell").parquet(path)
    return VectorIndex(path, item, centres, books)


def search_index(queries: DataFrame, index: VectorIndex, k: int, probes: int | None = None, refine: int = 4, query: str = "query_id", vector: str = "vector", digits: int = 6) -> DataFrame:
    """``(query, item, similarity, rank)``: the best ``k`` of the ``probes`` cells nearest to each query (a third of all cells if not given).

    Candidates are ranked by their codes, then by exact cosine; ties go to the smaller id. Null query vectors find nothing, and an empty index has nothing.
    """
    spark = queries.sparkSession
    if not index.path:
        return queries.select(query, F.lit(None).cast("long").alias(index.item), F.lit(0.0).alias("similarity"), F.lit(0).alias("rank")).limit(0)
    centres, books, item = index.centres, index.books, index.item
    probes = min(probes or -(-len(centres) // 3), len(centres))
    asked = queries.select(query, vector).filter(F.col(vector).isNotNull())
    kind = asked.schema[query].dataType.simpleString()

    def probe(batches):
        for batch in batches:
            if batch.num_rows:
                m = _unit_rows(_matrix(batch.column(vector)))
                near = np.argsort(-(m @ centres.T), axis=1, kind="stable")[:, :probes]
                at = np.repeat(np.arange(len(m)), probes)
                yield pa.RecordBatch.from_arrays([pa.array(near.reshape(-1).astype(np.int32)), batch.column(query).take(pa.array(at)), pa.array(list(m[at]), pa.list_(pa.float64()))], names=["cell", "q", "u"])

    probing = cut_lineage(asked.mapInArrow(probe, f"cell int, q {kind}, u array<double>"))
    sizes = [r["cell"] for r in probing.select("cell").distinct().collect()]  # at most as many as there are cells
    tiles = -(-probing.count() // (max(len(sizes), 1) * QUERIES))
    blocks = spark.read.parquet(index.path).filter(F.col("cell").isin(sizes))
    ask = probing.groupBy("cell", F.pmod(F.xxhash64("q"), F.lit(tiles)).alias("tile")).agg(F.collect_list("q").alias("qs"), F.collect_list("u").alias("us"))
    both = blocks.join(ask, "cell")
    kind_of_item = blocks.schema["ids"].dataType.elementType.simpleString()

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cell, us = batch.column("cell")[i].as_py(), np.array(batch.column("us")[i].as_py())
                ids, qs = batch.column("ids")[i].values, batch.column("qs")[i].values
                codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint8).reshape(len(ids), -1)
                m = np.frombuffer(batch.column("vectors")[i].as_buffer(), np.float64).reshape(len(ids), -1)
                cut = _parts(us, len(books))
                about = np.repeat((us @ centres[cell])[:, None], len(ids), axis=1)
                for p, book in enumerate(books):
                    about += (cut[:, p] @ book.T)[:, codes[:, p]]
                if len(ids) > refine * k:
                    at = np.argpartition(-about, refine * k - 1, axis=1)[:, : refine * k]
                else:
                    at = np.broadcast_to(np.arange(len(ids)), about.shape)
                row = np.repeat(np.arange(len(us)), at.shape[1])
                col = at.reshape(-1)
                exact = np.round((us[row] * m[col]).sum(1), digits) + 0.0
                yield pa.RecordBatch.from_arrays([qs.take(pa.array(row)), ids.take(pa.array(col)), pa.array(about[row, col]), pa.array(exact)], names=[query, item, "about", "similarity"])

    found = both.select("cell", "ids", "codes", "vectors", "qs", "us").mapInArrow(score, f"{query} {kind}, {item} {kind_of_item}, about double, similarity double")
    best = top_k(found, query, [F.col("about").desc(), F.col(item)], refine * k, "__c")
    return top_k(best.select(query, item, "similarity"), query, [F.col("similarity").desc(), F.col(item)], k)
