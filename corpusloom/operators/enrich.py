"""Embedding and enrichment of chunks in batches, with a cache of finished work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusloom.functions import text as X, vectors as VEC
from corpusloom.operators import retrieval as V
from corpusloom.operators.running import top_k

TABLE_TAGS = r"</?(table|td|caption|tr|th)( [^<>]{0,12})?>"


def embedding_input(text: Column, questions: Column | None = None) -> Column:
    """Questions when there are any, else the text; table tags removed; blank becomes ``None``."""
    body = text if questions is None else F.when(X.is_blank(questions), text).otherwise(questions)
    clean = F.regexp_replace(body, TABLE_TAGS, " ")
    return F.when(X.is_blank(clean), "None").otherwise(clean)


def tfidf_embedding(df: DataFrame, key: str, text: str, dim: int = 256) -> DataFrame:
    """Unit vectors from hashed term frequencies and inverse document frequencies."""
    tokens = df.select(key, X.tokens(F.col(text)).alias("__t"))
    stages = Pipeline(stages=[
        HashingTF(inputCol="__t", outputCol="__tf", numFeatures=dim), IDF(inputCol="__tf", outputCol="__idf"), Normalizer(inputCol="__idf", outputCol="__v")])
    return stages.fit(tokens).transform(tokens).select(key, vector_to_array("__v").alias("vector"))


def encode_batches(df: DataFrame, key: str, text: str, encode: Callable[[list[str]], list[list[float]]], max_tokens: int | None = None, batch: int = 16) -> DataFrame:
    """Vectors from a plug-in model, called with bounded batches of texts, cut to ``max_tokens`` if the model needs that."""
    whole = F.array_join(X.tokens(F.col(text)), " ")
    ready = df.select(key, (whole if max_tokens is None else X.truncate_tokens(F.col(text), max_tokens)).alias("__t"))
    schema = T.StructType([ready.schema[key], T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["__t"].tolist()
            vectors = []
            for i in range(0, len(texts), batch):
                vectors.extend(encode(texts[i : i + batch]))
            yield pd.DataFrame({key: frame[key], "vector": vectors})

    return ready.mapInPandas(run, schema)


def title_blend(title: Column, content: Column, weight: float = 0.1) -> Column:
    return VEC.blend(title, content, weight)


def work_key(model: str, text: Column, task: str, config: str) -> Column:
    return F.md5(F.concat_ws("\u0001", F.lit(model), text, F.lit(task), F.lit(config)))


def cached_enrichment(
    df: DataFrame, text: str, cache: DataFrame, compute: Callable[[list[str]], list[str]], model: str, task: str, config: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``result``, new cache entries): equal texts are computed once, known keys not at all."""
    keyed = df.withColumn("work_key", work_key(model, F.col(text), task, config))
    todo = keyed.select("work_key", F.col(text).alias("__t")).dropDuplicates(["work_key"]).join(cache.select("work_key"), "work_key", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"work_key": frame["work_key"], "result": compute(frame["__t"].tolist())})

    fresh = todo.mapInPandas(run, "work_key string, result string")
    known = cache.select("work_key", "result").unionByName(fresh)
    return keyed.join(known, "work_key").drop("work_key"), fresh


def keyword_list(c: Column) -> Column:
    """Keywords written with any comma or semicolon."""
    return F.array_distinct(F.filter(F.transform(F.split(c, "[,，;；、\r\n]+"), X.strip), lambda k: k != ""))


def question_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n"), X.strip), lambda s: s != "")


def top_keywords(df: DataFrame, key: str, text: str, stats: DataFrame, n: int) -> DataFrame:
    """The ``n`` terms of each text with the largest term frequency times inverse document frequency."""
    counts = df.select(key, F.explode(X.tokens(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))
    scored = counts.join(stats.select("term", "df", "n"), "term").withColumn("score", F.round(F.col("tf") * F.log(F.col("n") / F.col("df")), 6))
    return top_k(scored, key, [F.col("score").desc(), F.col("term")], n).select(key, "term", "score", "rank")


def index_fields(name: Column, text: Column, summary: Column, keywords: Column, questions: Column) -> dict[str, Column]:
    """Token fields of a chunk: a summary, when present, is indexed instead of the text."""
    source = F.when(X.is_blank(summary), text).otherwise(summary)
    title = F.regexp_replace(name, r"\.[a-zA-Z]+$", "")
    lists = lambda c: X.tokens(F.array_join(c, " "))
    return {
        "title_tks": X.tokens(title), "title_sm_tks": X.fine_tokens(title), "important_kwd": keywords, "important_tks": lists(keywords),
        "question_kwd": questions, "question_tks": lists(questions), "content_ltks": X.tokens(source), "content_sm_ltks": X.fine_tokens(source),
    }


def propagate_tags(chunks: DataFrame, key: str, exemplars: DataFrame, exemplar: str, tag: str, priors: DataFrame, min_share: float, n: int = 3, smoothing: int = 1000):
    """(tags of chunks, chunks without any tag), from exemplars that share enough terms."""
    from corpusloom.operators.aggregates import tag_scores

    matches = V.term_overlap(chunks, key, exemplars, exemplar, keep=[tag], min_share=min_share).withColumnRenamed(tag, "tag")
    tags = tag_scores(matches, priors, key, n, smoothing)
    return tags, chunks.select(key).join(tags.select(key).distinct(), key, "left_anti")


def insert_counters(chunks: DataFrame, by: list[str], chunk: str, tokens: str, seconds: str) -> DataFrame:
    """Distinct chunks, their tokens and the time spent, to add to document and dataset counters."""
    once = chunks.groupBy(*by, chunk).agg(F.max(tokens).alias("__t"), F.sum(seconds).alias("__s"))
    return once.groupBy(*by).agg(F.count("*").alias("chunk_num"), F.sum("__t").alias("token_num"), F.sum("__s").alias("duration"))


def cluster_summary(members: DataFrame, cluster: str, key: str, text: str, sentences: int = 3) -> DataFrame:
    """Extractive summary rows of every cluster: ``(cluster, rank, key, sentence, score)``.

    The whole text of every member is read; sentences are ranked by the mean weight of their terms inside the
    cluster. Ranked rows instead of one joined text keep large clusters distributed.
    """
    flat = F.regexp_replace(F.col(text), r"[ \t\r\n]+", " ")
    parts = members.select(cluster, key, F.posexplode(F.split(flat, r"(?<=[.!?]) ")).alias("spos", "sentence"))
    parts = parts.filter(~X.is_blank(F.col("sentence")))
    terms = parts.select(cluster, key, "spos", F.explode(F.array_distinct(X.tokens(F.col("sentence")))).alias("term"))
    df = terms.groupBy(cluster, "term").agg(F.count("*").alias("__df"))
    scores = terms.join(df, [cluster, "term"]).groupBy(cluster, key, "spos").agg(F.round(F.avg(F.log(1 + F.col("__df"))), 6).alias("score"))
    ranked = top_k(scores, cluster, [F.col("score").desc(), F.col(key), F.col("spos")], sentences)
    return ranked.join(parts, [cluster, key, "spos"]).select(cluster, "rank", key, "spos", "sentence", "score")
