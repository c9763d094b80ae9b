"""Exact and approximate nearest vectors for many queries at once."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import text as X, vectors as VEC
from corpusloom.functions.text import token_lists  # by name: a task that refers to the module takes all of it along, with functions that cannot be sent
from corpusloom.operators.running import top_k
from corpusloom.session import cut_lineage

QUERY_BLOCK = 16384  # query vectors sent to every task at once
CELLS = 1 << 22  # similarities that a task holds at once


def hashed_vectors(rows: DataFrame, key: str, text: str = "text", dim: int = 64) -> DataFrame:
    """``(key, vector)`` with ``vectors.hash_embedding`` of each text; a task hashes each distinct token of an Arrow batch once."""
    tokens = rows.select(key, *X.token_parts(F.col(text), "__t"))

    def count(batches):
        for batch in batches:
            lists = token_lists(batch, "__t")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            words = lists.flatten().dictionary_encode()
            buckets = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim if w else -1 for w in words.dictionary.to_pylist()], np.int64)
            bucket = buckets[words.indices.to_numpy(zero_copy_only=False)]
            cells = (np.repeat(np.arange(len(lists)) * dim, sizes) + bucket)[bucket >= 0]
            # The vector of a missing text has no values, as the column function's.
            values = pa.array(np.bincount(cells, minlength=len(lists) * dim).astype(float), mask=np.repeat(lists.is_null().to_numpy(zero_copy_only=False), dim))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * dim), values)], names=[key, "vector"])

    return tokens.mapInArrow(count, f"{key} {rows.schema[key].dataType.simpleString()}, vector array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, 0))
    sizes = pc.list_value_length(column)
    if pc.min_max(sizes)["min"] != pc.min_max(sizes)["max"]:
        raise ValueError("vectors of different lengths: filter the column to one length first")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def nearest(
    queries: DataFrame, items: DataFrame, k: int | None = None, threshold: float = -2.0, query: str = "query_id",
    item: str = "item_id", vector: str = "vector", digits: int = 6,
) -> DataFrame:
    """``(query, item, similarity[, rank])``: exact cosine, filtered by ``threshold``, the best ``k`` per query.

    The items are scanned in place and never shuffled: each task multiplies its Arrow batches with a block of query
    vectors and keeps at most ``k`` rows per query and batch. A block holds at most about ``QUERY_BLOCK`` queries;
    more queries are split by hash and make further passes. Scores are rounded so that equal vectors tie exactly.
    """
    # A missing vector is near to nothing, whether it is a query's or an item's.
    queries = queries.select(query, vector).filter(F.col(vector).isNotNull())
    out_schema = f"{query} {queries.schema[query].dataType.simpleString()}, {item} {items.schema[item].dataType.simpleString()}, similarity double"
    head = queries.limit(QUERY_BLOCK + 1).toArrow()
    if head.num_rows <= QUERY_BLOCK:
        blocks = [head]
    else:
        # Every block reads both sides again: what they are computed from is not.
        queries, items = cut_lineage(queries), cut_lineage(items.select(item, vector))
        n = -(-2 * queries.count() // QUERY_BLOCK)  # twice as many as needed, for uneven hashes
        blocks = (queries.filter(F.pmod(F.xxhash64(query), F.lit(n)) == b).toArrow() for b in range(n))
    found = reduce(
        lambda a, b: a.unionByName(b),
        [_one_pass(block, items, k, threshold, query, item, vector, digits, out_schema) for block in blocks])
    if k is None:
        return found
    return top_k(found, query, [F.col("similarity").desc(), F.col(item)], k)


def _one_pass(block, items, k, threshold, query, item, vector, digits, out_schema):
    ids = block.column(query).combine_chunks()
    matrix = _unit_rows(_matrix(block.column(vector).combine_chunks()))
    shared = items.sparkSession.sparkContext.broadcast((ids, matrix))

    def score(batches):
        ids, matrix = shared.value
        for batch in batches:
            if batch.column(vector).null_count:
                batch = batch.filter(pc.is_valid(batch.column(vector)))
            if batch.num_rows == 0 or len(ids) == 0:
                continue
            names = batch.column(item)
            rows = _unit_rows(_matrix(batch.column(vector)))
            step = max(1, CELLS // len(rows))
            for low in range(0, len(ids), step):
                sims = np.round(matrix[low:low + step] @ rows.T, digits) + 0.0
                keep = sims >= threshold
                if k is not None and sims.shape[1] > k:
                    # Ties at the k-th score are all kept here; the global cut decides by id.
                    cut = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
                    keep &= sims >= cut[:, None]
                qi, ii = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(qi + low)), names.take(pa.array(ii)), pa.array(sims[qi, ii])], names=[query, item, "similarity"]
                )

    return items.select(item, vector).mapInArrow(score, out_schema)


def nearest_approximate(
    queries: DataFrame, items: DataFrame, k: int, query: str = "query_id", item: str = "item_id", vector: str = "vector",
    bucket_length: float = 0.5, tables: int = 4, max_distance: float = 2.0,
) -> DataFrame:
    """Candidates from random projections of unit vectors (2k kept per query), re-scored exactly.

    Unit vectors are at most 2 apart, so no candidate is cut by its distance; a query with fewer than ``k`` candidates is
    searched exactly, so every query gets ``k`` rows if there are as many items.
    """
    queries, items = queries.filter(F.col(vector).isNotNull()), items.filter(F.col(vector).isNotNull())
    as_unit = lambda df, key: df.select(F.col(key), array_to_vector(VEC.unit(F.col(vector))).alias("u"), F.col(vector).alias("v"))
    q, i = as_unit(queries, query), as_unit(items, item)
    model = BucketedRandomProjectionLSH(inputCol="u", outputCol="h", bucketLength=bucket_length, numHashTables=tables, seed=7).fit(i)
    pairs = model.approxSimilarityJoin(q, i, max_distance, distCol="distance").select(
        F.col(f"datasetA.{query}").alias(query), F.col(f"datasetB.{item}").alias(item), "distance",
        F.col("datasetA.v").alias("__a"), F.col("datasetB.v").alias("__b"))
    candidates = top_k(pairs, query, [F.col("distance"), F.col(item)], 2 * k, "__c")
    scored = candidates.select(query, item, F.round(VEC.cosine(F.col("__a"), F.col("__b")), 6).alias("similarity"))
    found = cut_lineage(top_k(scored, query, [F.col("similarity").desc(), F.col(item)], k))
    full = found.groupBy(query).agg(F.count("*").alias("__n")).filter(F.col("__n") >= k).select(query)
    short = cut_lineage(queries.select(query, vector).join(full, query, "left_anti"))
    if short.isEmpty():
        return found
    exact = nearest(short, items, k, query=query, item=item, vector=vector)
    return found.join(short.select(query), query, "left_anti").unionByName(exact.select(found.columns))
