"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; ``run`` writes each result as Parquet to
the shared folder and reads it again for the next one. All but the last stage return the columns of documents.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns are defined by the operators: a document
without text is rejected by the first stage, repeated rows are near-duplicates of each other, extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import decontamination, jaccard, mixing, quality, sharding
from corpusloom.llm.common import stored
from corpusloom.llm.registry import table
from corpusloom.session import configure

SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    kept = quality.clean_documents(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else kept


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return jaccard.keep_one_of_each(docs, size=5, similarity=Fraction(4, 5))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates (13-word windows; a twentieth of the words hit)."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as they are taken."""
    return mixing.mix_sources(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in uniformly shuffled shards of equal size, with ``shard`` and ``slot``."""
    return sharding.shuffle_into_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", ngram_jaccard),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("sharding", shards),
]

#: Rounding and shuffling are drawn at random: SQL cannot express the rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents in ``sf_dir``."""
    configure(spark)
    sf_dir = sf_dir.rstrip("/")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i + 1}")
    return docs
