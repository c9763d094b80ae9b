"""Registry of runnable queries with their independent SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import configure


# Key of the tables whose rows are long texts or vectors, worth spreading over all cores.
HEAVY_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "embeddings": "vec_id"}


class Tables:
    """Lazy access to the parquet tables of one directory: ``t.orders``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        key = HEAVY_TABLES.get(name)
        cores = self.spark.sparkContext.defaultParallelism
        if key and df.rdd.getNumPartitions() < cores:
            # Fewer splits than cores: less than a split of data for each core. A larger table is read as it lies.
            df = df.repartition(cores, *([key, "turn"] if name == "conversations" else [key]))
        return df


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


def runner(entry: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return entry.build(Tables(configure(spark), sf_dir))

    return run
