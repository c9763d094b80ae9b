"""The vector index: recall against exact search, pruned partitions, every row indexed."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import vector_index as I, vector_search as S

SCHEMA = "item_id long, vector array<double>"


def recall(got, want):
    want = {(r["query_id"], r["item_id"]) for r in want.collect()}
    return len(want & {(r["query_id"], r["item_id"]) for r in got.collect()}) / len(want)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(30)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in centres[i % 30 if i % 3 else 0]]) for i in range(3000)]
    return spark.createDataFrame([*rows, (3000, None), (3001, [0.0] * 20)], SCHEMA).repartition(3).cache()


def test_recall_and_pruning(spark, items):
    index = I.build_index(items, cells=24, sample=1000)
    stored = spark.read.parquet(index.path)
    assert sorted(r["i"] for r in stored.select(F.explode("ids").alias("i")).collect()) == [*range(3000), 3001]
    queries = items.filter("item_id % 100 = 7").select(F.col("item_id").alias("query_id"), "vector")
    found = I.search_index(queries, index, 10, probes=4)
    assert {r["count"] for r in found.groupBy("query_id").count().collect()} == {10}
    assert recall(found, S.nearest(queries, items, 10)) >= 0.9
    one = I.search_index(queries.limit(1), index, 5, probes=2)
    assert "PartitionFilters: [cell" in one._jdf.queryExecution().toString()


def test_all_cells_are_exact(spark, items):
    index = I.build_index(items, cells=8, sample=500)
    queries = items.filter("item_id in (1, 2, 3001)").select(F.col("item_id").alias("query_id"), "vector")
    found = I.search_index(queries.filter("query_id < 3000"), index, 3, probes=8, refine=2000)
    assert recall(found, S.nearest(queries.filter("query_id < 3000"), items, 3)) == 1
    assert I.search_index(queries.select("query_id", F.lit(None).cast("array<double>").alias("vector")), index, 3).count() == 0


def test_registered_data(spark):
    from corpusloom.plans import retrieval as R
    from corpusloom.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    want = S.nearest(R.centroid_queries(t), R.embedding_items(t), 10, item="vec_id").withColumnRenamed("vec_id", "item_id")
    assert recall(R.r7(t).withColumnRenamed("vec_id", "item_id"), want) >= 0.9
