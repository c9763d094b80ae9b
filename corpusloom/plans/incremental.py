"""Streaming and incremental processing over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X

from corpusloom.plans.ranking import MESSAGES_SQL, SNAPSHOT_SQL, docs_v1, docs_v2, messages
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query
from corpusloom.session import scratch_path
from corpusloom.sources import readers
from corpusloom.streaming import incremental as I


def event_files(t):
    """The events as one folder per day, with a zoned timestamp."""
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return I.stage_files(events, F.to_date("ts"), "events"), events.schema


@query("i1_polling_windows", """
select event_id, 'open_start' as rule from events where ts > timestamp '2024-01-05 12:00:00' and ts <= timestamp '2024-01-08 12:00:00' union all
select event_id, 'open_end' from events where ts >= timestamp '2024-01-05 12:00:00' and ts < timestamp '2024-01-08 12:00:00' union all select event_id, 'reindex' from events where ts <= timestamp '2024-01-03 00:00:00'""")
def i1(t):
    path, schema = event_files(t)
    stream = I.file_stream(t.spark, path, schema)
    lo, hi = "2024-01-05 12:00:00", "2024-01-08 12:00:00"
    tag = lambda df, rule: df.select("event_id", F.lit(rule).alias("rule"))
    first = tag(I.drain_to_table(I.poll(stream, "ts", lo, hi), name="poll"), "open_start")
    batch = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    rest = tag(I.poll(batch, "ts", lo, hi, "open_end"), "open_end").unionByName(tag(I.poll(batch, "ts", hi, "2024-01-03 00:00:00", reindex=True), "reindex"))
    return first.unionByName(rest).unionByName(tag(I.poll(batch, "ts", hi, lo), "empty"))


@query("i2_cursor_advance", "select strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as cursor, count(*) as rows, 0::bigint as failed from events")
def i2(t):
    path, schema = event_files(t)
    log = scratch_path(t.spark, "cursor")
    spark = t.spark
    stream = I.file_stream(spark, path, schema, files_per_trigger=8)
    I.drain(stream, lambda df, i: I.advance_cursor(spark, log, df, i, "ts", F.col("event_id").isNull()), scratch_path(spark, "cursor-checkpoint"))
    return I.cursor(spark.read.parquet(log)).select(F.date_format("cursor", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("cursor"), "rows", "failed")


CHANGES_SQL = f"""{SNAPSHOT_SQL}, cl as (select v2.doc_id, case when v1.doc_id is null then 'new' when v2.source = 'src9' then 'collision' when v1.fp = v2.fp then 'unchanged' else 'changed' end as status from v2 left join v1 on v1.doc_id = v2.doc_id)"""


def classified(t):
    """The second snapshot arrives as a stream of files; one source claims ids of another."""
    incoming = docs_v2(t).select("doc_id", "fp", F.when(F.col("source") == "src9", "other").otherwise(F.col("source")).alias("source"))
    path = I.stage_files(incoming, F.col("source"), "docs")
    stream = I.file_stream(t.spark, path, incoming.schema, files_per_trigger=8)
    return I.drain_to_table(I.classify_changes(docs_v1(t), stream, "doc_id", "fp", "source"), name="changes").drop("batch")


@query("i3_change_capture", f"with {CHANGES_SQL} select doc_id, status from cl")
def i3(t):
    return classified(t).select("doc_id", "status")


@query("i4_sync_summary", f"""with {CHANGES_SQL} select count(*) filter (status = 'new' and source <> 'src2') as added, count(*) filter (status = 'changed' and source <> 'src2') as updated,
 count(*) filter (status = 'unchanged' and source <> 'src2') as unchanged, count(*) filter (source = 'src2') as failed from cl join documents using (doc_id)""")
def i4(t):
    return I.sync_summary(classified(t), F.col("source") == "src2")


@query("i5_snapshot_prune", f"with {SNAPSHOT_SQL} select doc_id from v1 where doc_id not in (select doc_id from v2)")
def i5(t):
    gone = I.prune_to_snapshot(docs_v1(t), docs_v2(t), "doc_id").select("doc_id")
    return gone.unionByName(I.prune_to_snapshot(docs_v1(t), None, "doc_id").select("doc_id"))


@query("i6_checkpoint_resume", """
select doc_id, r as "from", least(r + 3000, n_chars) as "to" from documents, lateral (select unnest(range(0, n_chars, 3000)) as r) where n_chars > 0 and not (lang = 'en' and r = 0)""")
def i6(t):
    ranges = readers.document_ranges(t.documents, "doc_id", F.col("n_chars"), 3000).join(t.documents.select("doc_id", "lang"), "doc_id").withColumn("config", F.lit("v1"))
    columns = ["doc_id", "from", "to", "config"]
    english = ranges.filter((F.col("lang") == "en") & (F.col("from") == 0))
    finished = I.pending_units(english, english.limit(0).withColumn("digest", F.lit("")), columns)
    stale = I.pending_units(ranges.filter("lang = 'fr'").withColumn("config", F.lit("v0")), english.limit(0).withColumn("digest", F.lit("")), columns)
    return I.pending_units(ranges, finished.select("digest").unionByName(stale.select("digest")), columns).select("doc_id", "from", "to")


@query("i7_micro_batch_upsert", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by event_id desc) = 1")
def i7(t):
    path, schema = event_files(t)
    stream = I.file_stream(t.spark, path, schema, files_per_trigger=8)
    return I.upsert_batches(stream, "user_id", "event_id").select("user_id", "event_id", "event_type")


@query("i8_bulk_write", """
select doc_id, doc_id // 50 as batch_id from documents where doc_id // 50 not in (select doc_id // 50 from documents where n_chars > 20000)""")
def i8(t):
    path = scratch_path(t.spark, "bulk")
    return I.bulk_write(t.documents.select("doc_id", "n_chars"), path, F.floor(F.col("doc_id") / 50), F.col("n_chars") <= 20000).select("doc_id", "batch_id")


@query("i9_rolling_daily_stats", """
select strftime(ts, '%Y-%m-%d') as day, count(*) as n, count(distinct user_id) as users, round(sum(value), 4) as total from events group by 1
having max(ts) is not null and cast(strftime(ts, '%Y-%m-%d') as date) + 1 <= (select max(ts) from events) - interval 1 day""")
def i9(t):
    """The days that the watermark has closed."""
    path, schema = event_files(t)
    daily = I.rolling_daily(I.file_stream(t.spark, path, schema), "ts", "user_id", "value")
    return I.drain_to_table(daily, name="daily").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n", "users", F.round("total", 4).alias("total"))


@query("i9_late_rows_batch", "select strftime(ts, '%Y-%m-%d') as day, count(*) as n, count(distinct user_id) as users, round(sum(value), 4) as total from events group by 1")
def i9_batch(t):
    """The same plan as a batch: every day."""
    daily = I.rolling_daily(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "user_id", "value")
    return daily.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n", "users", F.round("total", 4).alias("total"))


@query("i10_sliding_activity", """
select event_type, strftime(s, '%Y-%m-%d %H:%M:%S') as start, count(*) as n from (select event_type, ts, unnest([time_bucket(interval 12 hours, ts), time_bucket(interval 12 hours, ts) - interval 12 hours]) as s from events) group by all""")
def i10(t):
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    out = I.sliding_activity(events, "ts", "event_type")
    return out.select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("i10_sessions", """
with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hours then 0 else 1 end as fresh from events),
 s as (select *, sum(fresh) over (partition by user_id order by ts) as session from g),
 c as (select user_id, min(ts) as start, max(ts) as latest, count(*) as n from s group by user_id, session)
select user_id, strftime(start, '%Y-%m-%d %H:%M:%S') as start, strftime(latest, '%Y-%m-%d %H:%M:%S') as latest, n from c where latest + interval 6 hours <= (select max(ts) from events) - interval 1 day""")
def i10_sessions(t):
    """Sessions closed by the watermark, from the stream."""
    path, schema = event_files(t)
    closed = I.drain_to_table(I.sessions(I.file_stream(t.spark, path, schema), "ts", "user_id"), name="sessions")
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return closed.select("user_id", fmt("w.start").alias("start"), fmt("latest").alias("latest"), "n")


@query("i11_retention", f"with {MESSAGES_SQL}, s as (select *, octet_length(encode(text)) as size from msg), "
       "n as (select memory_id, sum(size) - 20000 as need from s group by 1), "
       "r as (select s.*, need, sum(size) over (partition by s.memory_id order by forget_at is null, coalesce(forget_at, valid_at), id) as freed from s join n using (memory_id) where need > 0) "
       "select memory_id, id from r where freed - size < need")
def i11(t):
    sized = messages(t).withColumn("size", F.octet_length("text").cast("long"))
    return I.retention(sized, "memory_id", "size", 20000, "id").select("memory_id", "id")


@query("i12_phase_invalidation", """
with m as (select user_id, max(ts) as merged from events where event_type = 'click' group by 1), p as (select user_id, case when event_type = 'view' then 'resolved' else 'communities' end as phase, max(ts) as ran from events where event_type in ('view', 'error') group by all)
select m.user_id, ph.phase, case when ran > merged then 'done' else 'pending' end as state from m cross join (values ('resolved'), ('communities')) ph(phase) left join p on p.user_id = m.user_id and p.phase = ph.phase""")
def i12(t):
    merges = t.events.filter("event_type = 'click'").select("user_id", "ts")
    phase = F.when(F.col("event_type") == "view", "resolved").otherwise("communities")
    return I.phase_state(merges, t.events.filter(F.col("event_type").isin("view", "error")).select("user_id", phase.alias("phase"), "ts"), "user_id")


@query("i13_missing_field_repair", f"""with {MESSAGES_SQL}, miss as (select id from msg where role = 'assistant')
select id, case when role <> 'assistant' then 'kept' when id in (select id from miss) then md5(array_to_string({sql_tokens('text')}, ' ')) end as tokens from msg""")
def i13(t):
    rows = messages(t).withColumn("tokens", F.when(F.col("role") != "assistant", "kept"))
    value = F.md5(F.array_join(X.tokens(F.col("text")), " "))
    return I.repair(rows, "id", "tokens", value, [F.col("valid_at"), F.col("id")]).select("id", "tokens")
