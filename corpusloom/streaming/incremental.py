"""Incremental processing: polling windows, cursors, change capture, upserts, windows over time, retention.

Structured Streaming runs the loops (``availableNow`` drains what is there and stops). Every micro-batch is written
under its own batch id, so a batch that is delivered again after a lost executor or driver overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusloom.operators.running import latest, running_sum
from corpusloom.session import scratch_path
from corpusloom.sources.readers import time_window


# --- plumbing -------------------------------------------------------------------------------------------------


def stage_files(df: DataFrame, bucket: Column, name: str = "stream") -> str:
    """Write a table as one folder per bucket, to be read as a stream."""
    path = scratch_path(df.sparkSession, name)
    df.withColumn("__b", bucket).repartition("__b").write.partitionBy("__b").parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drain(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run ``batch(df, id)`` over everything available, then stop. The next call with the same ``checkpoint`` folder goes on from there."""
    query = stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def drain_to_table(stream: DataFrame, mode: str = "append", name: str = "sink", path: str | None = None) -> DataFrame:
    """Drain a streaming plan into the folder ``path`` and return all that it holds.

    Rows and checkpoint stay in the folder: a second call reads only what is new, and a batch that is delivered again
    overwrites itself. Without a path the folder is a new one.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    drain(stream, write, f"{path}/checkpoint", mode)
    path = f"{path}/rows"
    schema = T.StructType(stream.schema.fields + [T.StructField("batch", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


# --- polling ----------------------------------------------------------------------------------------------------


def poll(df: DataFrame, ts: str, start=None, end=None, rule: str = "open_start", reindex: bool = False) -> DataFrame:
    """Rows of one polling window; ``reindex`` ignores the start; an end not after the start gives nothing."""
    if not reindex and start is not None and end is not None and str(end) <= str(start):
        return df.limit(0)
    return time_window(df, ts, None if reindex else start, end, rule)


def advance_cursor(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, ts: str, failed: Column) -> None:
    """Record the batch; its cursor counts only if no row failed."""
    stats = batch.agg(F.max(ts).alias("ts"), F.count("*").alias("rows"), F.count_if(failed).alias("failed"))
    stats.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def cursor(log: DataFrame) -> DataFrame:
    """Greatest timestamp of the batches before the first that failed: what failed, and what came after it, is polled again."""
    bad = F.col("failed") > 0
    through = ~bad
    for order in [c for c in ("ts", "batch_id") if c in log.columns]:
        first = log.agg(F.min(F.when(bad, F.col(order)))).scalar()
        through = through & (first.isNull() | (F.col(order) < first))
    return log.agg(F.max(F.when(through, F.col("ts"))).alias("cursor"), F.sum("rows").alias("rows"), F.sum("failed").alias("failed"))


def classify_changes(stored: DataFrame, incoming: DataFrame, key: str, fingerprint: str, scope: str | None = None) -> DataFrame:
    """new / changed / unchanged / collision for every incoming row; a collision has the id of another scope's row."""
    old = stored.select(F.col(key), F.col(fingerprint).alias("__f"), *([F.col(scope).alias("__s")] if scope else []), F.lit(True).alias("__known"))
    joined = incoming.join(old, key, "left")
    clash = (F.col("__s") != F.col(scope)) if scope else F.lit(False)
    status = F.when(F.col("__known").isNull(), "new").when(clash, "collision").when(F.col("__f") == F.col(fingerprint), "unchanged").otherwise("changed")
    return joined.select(*incoming.columns, status.alias("status"))


def sync_summary(classified: DataFrame, failed: Column) -> DataFrame:
    """Counts of one run: rows that failed are not counted as added or updated."""
    ok = ~F.coalesce(failed, F.lit(False))
    return classified.agg(
        F.count_if((F.col("status") == "new") & ok).alias("added"), F.count_if((F.col("status") == "changed") & ok).alias("updated"),
        F.count_if((F.col("status") == "unchanged") & ok).alias("unchanged"), F.count_if(~ok).alias("failed"))


def prune_to_snapshot(stored: DataFrame, snapshot: DataFrame | None, key: str) -> DataFrame:
    """Stored rows that are no longer in the full listing of the source; without a listing nothing is pruned."""
    if snapshot is None:
        return stored.limit(0)
    return stored.join(snapshot.select(key).distinct(), key, "left_anti")


def pending_units(units: DataFrame, finished: DataFrame, columns: list[str]) -> DataFrame:
    """Units of work whose digest of range and settings has not finished before."""
    digest = F.md5(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in columns]))
    return units.withColumn("digest", digest).join(finished.select("digest").distinct(), "digest", "left_anti")


def upsert_batches(stream: DataFrame, key: str, order: str, name: str = "upsert", path: str | None = None) -> DataFrame:
    """Latest row per key over all batches of all runs with this ``path``; a batch delivered twice changes nothing."""
    columns = [c for c in stream.columns]
    landed = drain_to_table(stream, name=name, path=path)
    return latest(landed.select(columns), key, F.col(order))


def bulk_write(df: DataFrame, path: str, batch: Column, valid: Column) -> DataFrame:
    """Write in batches; a batch with an invalid row is rolled back as a whole. Returns what is visible."""
    marked = df.withColumn("batch_id", batch).withColumn("__ok", F.coalesce(valid, F.lit(False)))
    bad = marked.filter(~F.col("__ok")).select("batch_id").distinct()
    kept = marked.join(bad, "batch_id", "left_anti").drop("__ok")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    return df.sparkSession.read.schema(kept.schema).parquet(path)


# --- windows over time --------------------------------------------------------------------------------------------


def rolling_daily(stream: DataFrame, ts: str, user: str, value: str, late: str = "1 day") -> DataFrame:
    """Daily counts, sums and distinct users, kept up to date; rows later than the watermark are dropped.

    Distinct users come from a second grouping of one row per user and day, so no day holds its users in one state.
    """
    per_user = stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), user).agg(F.count("*").alias("n"), F.sum(value).alias("v"))
    return per_user.groupBy(F.window(F.window_time("w"), "1 day").alias("w")).agg(
        F.count("*").alias("users"), F.sum("n").alias("n"), F.sum("v").alias("total"))


def sliding_activity(df: DataFrame, ts: str, by: str, width: str = "1 day", step: str = "12 hours", late: str = "1 day") -> DataFrame:
    source = df.withWatermark(ts, late) if df.isStreaming else df
    return source.groupBy(by, F.window(ts, width, step).alias("w")).agg(F.count("*").alias("n"))


def sessions(df: DataFrame, ts: str, by: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Sessions of activity per id, closed after a gap."""
    source = df.withWatermark(ts, late) if df.isStreaming else df
    return source.groupBy(by, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.max(ts).alias("latest"))


class Retention(StatefulProcessor):
    """Per memory: keep the newest messages within the size limit, emit the ones that fall out, oldest first."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getMapState("kept", "valid_at long, id long", "size long")
        self.total = handle.getValueState("total", "size long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total = self.total.get()[0] if self.total.exists() else 0
        for frame in rows:
            for valid_at, id_, size in zip(frame["valid_at"], frame["id"], frame["size"]):
                known = (int(valid_at), int(id_))
                if not self.kept.containsKey(known):  # a replayed message is there already
                    self.kept.updateValue(known, (int(size),))
                    total += int(size)
        gone = []
        if total > self.limit:
            for (valid_at, id_), (size,) in sorted(self.kept.iterator()):
                if total <= self.limit:
                    break
                self.kept.removeKey((valid_at, id_))
                total -= size
                gone.append(id_)
        self.total.update((total,))
        yield pd.DataFrame({"memory_id": [key[0]] * len(gone), "id": gone}).astype({"memory_id": "int64", "id": "int64"})

    def close(self) -> None:
        pass


def retention_stream(stream: DataFrame, limit: int) -> DataFrame:
    """Evicted ids of a message stream ``(memory_id, id, valid_at, size)``; needs the RocksDB state store."""
    return stream.groupBy("memory_id").transformWithStateInPandas(Retention(limit), "memory_id long, id long", "append", "none")


def retention(messages: DataFrame, by: str, size: str, limit: int, tie: str) -> DataFrame:
    """Messages to evict so that each memory fits its limit: the oldest, forgotten ones first, until enough is freed."""
    need = messages.groupBy(by).agg((F.sum(size) - limit).alias("__need")).filter("__need > 0")
    order = [F.col("forget_at").isNull(), F.coalesce("forget_at", "valid_at"), F.col(tie)]
    over = messages.join(need, by)
    return running_sum(over, by, order, F.col(size), "freed").filter(F.col("freed") - F.col(size) < F.col("__need"))


# --- run state ------------------------------------------------------------------------------------------------------


PHASES = ("resolved", "communities")  # fixed values: steps that follow a merge


def phase_state(merges: DataFrame, phases: DataFrame, scope: str) -> DataFrame:
    """A phase is done when it ran after the last merge of new data; otherwise, or when it never ran, it is pending."""
    last = merges.groupBy(scope).agg(F.max("ts").alias("__merged"))
    ran = phases.groupBy(scope, "phase").agg(F.max("ts").alias("__ran"))
    grid = last.withColumn("phase", F.explode(F.array(*[F.lit(p) for p in PHASES])))
    state = grid.join(ran, [scope, "phase"], "left")
    return state.select(scope, "phase", F.when(F.col("__ran") > F.col("__merged"), "done").otherwise("pending").alias("state"))


def missing_field(df: DataFrame, field: str, order: list[Column], n: int | None = None) -> DataFrame:
    """Rows that lack a derived field; with ``n``, the oldest so many for one run, the next run takes the rest."""
    rows = df.filter(F.col(field).isNull())
    return rows if n is None else rows.orderBy(*order).limit(n)


def repair(df: DataFrame, key: str, field: str, value: Column, order: list[Column], n: int | None = None) -> DataFrame:
    """The table with the field of its incomplete rows (with ``n``, the next so many) recomputed."""
    if n is None:
        return df.withColumn(field, F.when(F.col(field).isNull(), value).otherwise(F.col(field)))
    todo = missing_field(df, field, order, n).select(key, F.lit(True).alias("__fix"))
    return df.join(todo, key, "left").withColumn(field, F.when(F.col("__fix"), value).otherwise(F.col(field))).drop("__fix")

