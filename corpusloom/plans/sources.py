"""Scans, sources and sinks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F


from corpusloom.operators import aggregates as A, chunking as C, retrieval as V
from corpusloom.plans.ranking import SNAPSHOT_SQL, docs_v1, docs_v2
from corpusloom.registry import query
from corpusloom.session import scratch_path
from corpusloom.sources import readers as S, sinks


def write_files(rows, path, head, foot=None, files=8):
    """Text files of ``(k, value)`` rows in key order, each with its own first and last line."""
    bucketed = rows.select(F.pmod("k", F.lit(files)).alias("bucket"), F.lit(1).alias("part"), "k", "value")
    edge = lambda part, text: bucketed.select("bucket").distinct().select("bucket", F.lit(part).alias("part"), F.lit(0).cast("long").alias("k"), F.lit(text).alias("value"))
    every = bucketed.unionByName(edge(0, head))
    if foot:
        every = every.unionByName(edge(2, foot))
    every.repartition("bucket").sortWithinPartitions("bucket", "part", "k").select("bucket", "value").write.partitionBy("bucket").text(path)


@query("s1_parquet_passages", f"""
select doc_id, pos, contains(line, 'the') as rel, md5(line) as text from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)""")
def s1(t):
    """Documents written as (query, nested passages) parquet, then read back one passage per row."""
    path = scratch_path(t.spark, "passages")
    lines = F.split("text", "\n")
    t.documents.select("doc_id", F.transform(lines, lambda l: F.contains(l, F.lit("the"))).alias("is_selected"), lines.alias("passage_text")).write.parquet(path)
    rows = S.parquet_corpus(t.spark, path, "doc_id", "is_selected", "passage_text")
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "rel", F.md5("text").alias("text"))


@query("s2_judged_corpus", """
select cast(item_id as varchar) as qid, cast(doc_id as varchar) as docid, 1 as rel, md5(d.text) as text, md5(replace(b.text, chr(10), ' ')) as query from benchmark b join documents d on contains(d.text, b.text)""")
def s2(t):
    path = scratch_path(t.spark, "judged")
    t.documents.select(F.col("doc_id").cast("string").alias("docid"), "text").write.json(f"{path}/corpus")
    topics = t.benchmark.select(F.col("item_id").cast("string").alias("qid"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("query"))
    topics.write.csv(f"{path}/topics", sep="\t", quote="", escapeQuotes=False)
    rels = V.containment_judgments(t.benchmark, "item_id", t.documents, "doc_id")
    rels.select(F.col("item_id").cast("string"), F.lit("Q0"), F.col("doc_id").cast("string"), "rel").write.csv(f"{path}/qrels", sep="\t")
    out = S.judged_corpus(t.spark, f"{path}/corpus", f"{path}/topics", f"{path}/qrels")
    return out.select("qid", "docid", "rel", F.md5("text").alias("text"), F.md5("query").alias("query"))


@query("s3_delimited_table", """
select cast(c_custkey as varchar) as c_custkey, c_name, 'good' as kind from customer where c_mktsegment <> 'HOUSEHOLD'
union all select cast(c_custkey as varchar), c_name, 'bad' from customer where c_mktsegment = 'HOUSEHOLD'""")
def s3(t):
    path = scratch_path(t.spark, "table")
    line = F.concat_ws(",", "c_custkey", "c_name", F.when(F.col("c_mktsegment") == "HOUSEHOLD", "x,y").otherwise(F.col("c_mktsegment")))
    write_files(t.customer.select(line.alias("value"), F.col("c_custkey").alias("k")), path, head="c_custkey,c_name,c_mktsegment")
    good, bad = S.delimited_table(t.spark, path)
    bad_cells = F.split("value", ",")
    return good.select(F.col("cells")["c_custkey"].alias("c_custkey"), F.col("cells")["c_name"].alias("c_name"), F.lit("good").alias("kind")).unionByName(
        bad.select(bad_cells[0].alias("c_custkey"), bad_cells[1].alias("c_name"), F.lit("bad").alias("kind")))


@query("s4_delimiter_sniff", """
select doc_id, case when len(list_filter(l, lambda x: len(string_split(x, chr(9))) = 2)) >= len(list_filter(l, lambda x: len(string_split(x, ',')) = 2)) then 'tab' else 'comma' end as delimiter
from (select doc_id, string_split(text, chr(10)) as l from documents)""")
def s4(t):
    d = C.sniff_delimiter(F.split("text", "\n"))
    return t.documents.select("doc_id", F.when(d == "\t", "tab").otherwise("comma").alias("delimiter"))


@query("s5_json_sniff", """
select event_id, case event_type when 'error' then 'text' when 'click' then 'json' when 'view' then 'jsonl' else case when user_id > 75 then 'jsonl' else 'text' end end as format from events""")
def s5(t):
    n = F.lit("\n")
    four = F.concat("props", n, "props", n, n, "props", n, "props", n)
    kind = F.col("event_type")
    text = F.when(kind == "error", F.concat(F.lit("x"), "props")).when(kind == "click", F.col("props")).when(kind == "view", four).otherwise(
        F.when(F.col("user_id") > 75, F.concat(four, F.lit("oops"))).otherwise(F.concat("props", n, F.lit("oops"))))
    return t.events.select("event_id", S.json_format(text).alias("format"))


@query("s6_relational_window", """
select o_orderkey, 'row' as kind from orders where o_orderdate > timestamp '1996-01-01' and o_orderdate <= timestamp '1997-06-30'
union all select epoch_ms(max(o_orderdate)), 'cursor' from orders""")
def s6(t):
    rows = S.time_window(t.orders, "o_orderdate", "1996-01-01", "1997-06-30").select("o_orderkey", F.lit("row").alias("kind"))
    cursor = S.max_cursor(t.orders, "o_orderdate").select(F.unix_millis(F.col("cursor").cast("timestamp")).alias("o_orderkey"), F.lit("cursor").alias("kind"))
    return rows.unionByName(cursor)


@query("s6_ids_only", "select distinct o_custkey::varchar as id from orders")
def s6_ids(t):
    return S.ids_only(t.orders, "o_custkey")


@query("s7_row_documents", """
with r as (select c_custkey, c_name, case when c_acctbal > 0 then c_mktsegment end as seg, c_nationkey from customer),
 b as (select *, '【c_name】:' || chr(10) || c_name || case when seg is not null then chr(10) || chr(10) || '【seg】:' || chr(10) || seg else '' end as body from r)
select c_custkey, 'db:' || case when seg is not null then cast(c_custkey as varchar) else md5(body) end as id, body as text, c_name as title, octet_length(encode(body))::int as size, cast(c_nationkey as varchar) as nation from b""")
def s7(t):
    rows = t.customer.withColumn("seg", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).withColumn("key", F.when(F.col("seg").isNotNull(), F.col("c_custkey")))
    docs = S.render_rows(rows, ["c_name", "seg"], ["c_nationkey", "seg"], "key", "db", keep=["c_custkey"])
    return docs.select("c_custkey", "id", "text", "title", F.col("size_bytes").alias("size"), F.col("metadata")["c_nationkey"].alias("nation"))


@query("s8_object_listing", """
with o as (select page_id, split_part(split_part(url, '?', 1), '#', 1) as key, timestamp '2024-01-01' + to_days(cast(page_id % 30 as int)) as modified from pages),
 k as (select *, regexp_extract(key, '([^/]*)$', 1) as base from o where not ends_with(key, '/') and modified > timestamp '2024-01-03' and modified <= timestamp '2024-01-25')
select page_id, case when count(*) over (partition by base) > 1 then key else base end as name from k""")
def s8(t):
    key = F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    modified = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int")).cast("timestamp")
    listing = t.pages.select("page_id", key.alias("key"), modified.alias("modified"))
    return S.select_objects(listing, "2024-01-03", "2024-01-25").select("page_id", "name")


@query("s9_nested_records", """
select event_id, cast(event_id as varchar) as id, 'Type ' || event_type || ' by ' || event_type || ', ' || user_id as text, cast(json_extract(props, '$.k') as varchar) as k
from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20'""")
def s9(t):
    body = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.struct(F.get_json_object("props", "$.k").cast("int").alias("k")).alias("inner"), F.col("event_type").alias("type"),
        F.array(F.struct(F.concat(F.lit("<b>"), "event_type", F.lit("</b>")).alias("label")), F.struct(F.col("user_id").cast("string").alias("label"))).alias("tags"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")))
    rows = t.events.select("event_id", body.alias("body"))
    docs = S.record_documents(rows, "body", "id", "<p>Type {type} by {tags[*].label}</p>", ["inner.k", "missing"], "at", "2024-01-05", "2024-01-20", keep=["event_id"])
    return docs.select("event_id", "id", F.regexp_replace("text", " +, ", ", ").alias("text"), F.col("metadata")["inner.k"].alias("k"))


@query("s10_feed_entries", """
select 'rss:' || md5(case when page_id % 3 = 0 then 'g' || page_id when page_id % 3 = 1 then url || '#' || page_id else 'T ' || page_id end) as id, 'T ' || page_id as title,
 'T ' || page_id || chr(10) || chr(10) || case when page_id % 2 = 0 then 'body & more' else 'short' end as text, strftime(timestamp '2024-01-01 10:00:00' + to_days(cast(page_id % 28 as int)), '%Y-%m-%d %H:%M:%S') as updated
from pages where page_id % 28 + 1 > 3 and page_id % 28 + 1 <= 20""")
def s10(t):
    """Feed XML written from the pages, then read back."""
    path = scratch_path(t.spark, "feed")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), esc(c), F.lit(f"</{name}>"))
    pid = F.col("page_id")
    day = F.date_format(F.make_timestamp_ntz(F.lit(2024), F.lit(1), (pid % 28 + 1).cast("int"), F.lit(10), F.lit(0), F.lit(0)).cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss Z")
    optional = lambda cond, c: F.when(cond, c).otherwise("")
    item = F.concat(
        F.lit("<item>"), optional(pid % 3 == 0, tag("guid", F.concat(F.lit("g"), "page_id"))), optional(pid % 3 != 2, tag("link", F.concat("url", F.lit("#"), "page_id"))),
        tag("title", F.concat(F.lit(" T "), "page_id")), optional(pid % 2 == 0, tag("content", F.lit("<p>body &amp; more</p>"))), tag("summary", F.lit("<i>short</i>")),
        F.when(pid % 5 == 0, tag("published", day)).otherwise(tag("updated", day)), F.lit("</item>"))
    write_files(t.pages.select(item.alias("value"), pid.alias("k")), path, head="<rss>", foot="</rss>")
    docs = S.feed_documents(S.feed_entries(t.spark, path), "feed", "2024-01-03 10:00:00", "2024-01-20 10:00:00")
    return docs.select("id", "title", "text", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated"))


@query("s11_threads", """
with k as (select *, row_number() over (partition by conv_id order by turn) as section from conversations where role <> 'system')
select conv_id, replace(arg_min(role, turn) || ' in #' || (conv_id % 5) || ': ' || case when length(arg_min(text, turn)) > 50 then rtrim(left(arg_min(text, turn), 50)) || '...' else arg_min(text, turn) end, chr(10), ' ') as title,
 max(turn) as updated, count(*) as sections, 'thread' as kind from k group by conv_id
union all select conv_id, md5(text), 0, section, 'section' from k""")
def s11(t):
    rows = t.conversations.withColumn("channel", F.col("conv_id") % 5)
    heads, sections = S.threads(rows, "channel", "conv_id", "turn", "role", "text", F.col("role") == "system")
    return heads.select("conv_id", "title", "updated", "sections", F.lit("thread").alias("kind")).unionByName(
        sections.select("conv_id", F.md5("text").alias("title"), F.lit(0).cast("long").alias("updated"), F.col("section").alias("sections"), F.lit("section").alias("kind")))


@query("s12_upsert", f"""with {SNAPSHOT_SQL} select doc_id, fp from v2 union all select doc_id, fp from v1 where doc_id not in (select doc_id from v2)""")
def s12(t):
    """Re-delivered rows: the newer version number wins."""
    incoming = docs_v2(t).withColumn("version", F.lit(2)).unionByName(docs_v2(t).withColumn("fp", F.lit("old")).withColumn("version", F.lit(1)))
    stored = docs_v1(t).withColumn("version", F.lit(0))
    path = scratch_path(t.spark, "store")
    sinks.overwrite_partitions(sinks.upsert(stored, incoming, "doc_id", F.col("version")).select("doc_id", "fp", "source"), path, "source")
    return t.spark.read.parquet(path).select("doc_id", "fp")


@query("s13_conditional_update", """
select d.doc_id, case when lang = 'fr' and n_chars > 500 then 'edited' else source end as source, case when lang = 'fr' and n_chars > 500 then null else n_chars end as n_chars,
 case when lang = 'fr' and n_chars > 500 then 'a|' || lang || '|new' else 'a|' || lang || '|old' end as tags from documents d""")
def s13(t):
    rows = t.documents.select("doc_id", "lang", "source", "n_chars", F.array(F.lit("a"), "lang", F.lit("old")).alias("tags"))
    out = sinks.update(rows, (F.col("lang") == "fr") & (F.col("n_chars") > 500), {"source": "edited"}, remove={"n_chars": None, "tags": "old"}, add={"tags": "new"})
    return out.select("doc_id", "source", "n_chars", F.array_join("tags", "|").alias("tags"))


@query("s14_conditional_delete", """
select d.doc_id, 'ids' as kind from documents d left join labels l using (doc_id) where not (l.doc_id is not null and coalesce(toxic = 1, false))
union all select d.doc_id, 'exists' from documents d left join labels l using (doc_id) where quality is null union all select d.doc_id, 'must_not' from documents d left join labels l using (doc_id) where quality is not null""")
def s14(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    left = lambda df, kind: df.select("doc_id", F.lit(kind).alias("kind"))
    return A.union_all([
        left(sinks.delete(rows, F.col("toxic") == 1, t.labels, "doc_id"), "ids"), left(sinks.delete(rows, F.col("quality").isNotNull()), "exists"),
        left(sinks.delete(rows, F.col("quality").isNull()), "must_not")])


@query("s15_suffix_cast", """
select o_orderkey as key_long, case when o_orderstatus = 'P' then null else o_totalprice end as price_dbl, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as day_dt, o_orderpriority as name_kwd from orders""")
def s15(t):
    price = F.when(F.col("o_orderstatus") == "P", "bad").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd_HH-mm-ss"))
    cells = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_long"), price.alias("price_dbl"), day.alias("day_dt"), F.col("o_orderpriority").alias("name_kwd"))
    return S.suffix_cast(cells).withColumn("day_dt", F.date_format("day_dt", "yyyy-MM-dd HH:mm:ss"))


@query("s16_table_copy", """
select p_partkey, p_size::double as p_size, p_name, p_brand || ',' || p_type as tags, round(p_retailprice, 2) as first, case when p_size > 25 then 2 else 1 end as n_extra from part""")
def s16(t):
    rows = t.part.select(
        "p_partkey", F.col("p_size").cast("string").alias("p_size"), "p_name", F.to_json(F.array("p_brand", "p_type")).alias("tags"),
        F.array("p_retailprice", F.lit(0.0)).alias("q_2_vec"), F.col("p_type").alias("kind"), F.when(F.col("p_size") > 25, "big").alias("mark"))
    out = S.convert_table(rows, {"p_partkey": "bigint", "p_size": "double", "p_name": "string", "tags": "array<string>", "absent": "string"})
    return out.select("p_partkey", "p_size", "p_name", F.array_join("tags", ",").alias("tags"), F.round(F.col("q_2_vec")[0], 2).alias("first"), F.size("extra").alias("n_extra"))


@query("s17_copy_verification", f"""with {SNAPSHOT_SQL}
select (select count(*) from v1) as source_rows, (select count(*) from v2) as target_rows, count(*) filter (status = 'removed') as missing, count(*) filter (status = 'added') as extra,
 count(*) filter (status = 'unchanged') as matching, count(*) filter (status = 'updated') as differs_fp, 0::bigint as differs_source, round(count(*) filter (status = 'unchanged') / (select count(*) from v1), 6) as match_rate from diff""")
def s17(t):
    return sinks.verify_copy(docs_v1(t), docs_v2(t), "doc_id", ["fp", "source"]).withColumn("match_rate", F.round("match_rate", 6))


@query("s18_sheet_merge", """
select cast(n_nationkey as bigint) as key, n_name as name, cast(null as double) as balance, 'stack' as kind from nation union all select s_suppkey, s_name, s_acctbal, 'stack' from supplier
union all select coalesce(n_nationkey, r_regionkey), coalesce(n_name, '') || '/' || coalesce(r_name, ''), null, 'join' from nation full join region on n_nationkey = r_regionkey""")
def s18(t):
    nation = t.nation.select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    region = t.region.select(F.col("r_regionkey").cast("long").alias("key"), F.col("r_name").alias("rname"))
    none = F.lit("")
    joined = sinks.merge_sheets([nation, region], "key").select(
        "key", F.concat(F.coalesce("name", none), F.lit("/"), F.coalesce("rname", none)).alias("name"), F.lit(None).cast("double").alias("balance"), F.lit("join").alias("kind"))
    return sinks.merge_sheets([nation, supplier]).withColumn("kind", F.lit("stack")).unionByName(joined)


@query("s19_document_ranges", """select doc_id, r as "from", least(r + 3000, n_chars) as "to" from documents, lateral (select unnest(range(0, n_chars, 3000)) as r) where n_chars > 0""")
def s19(t):
    return S.document_ranges(t.documents, "doc_id", F.col("n_chars"), 3000)


@query("s20_tag_rename", """
select doc_id, case when source = 'src1' and lang = 'en' then 'src1|english|x' when source = 'src2' and lang = 'fr' then source || '|x' else source || '|' || lang || '|x' end as tags from documents""")
def s20(t):
    rows = t.documents.select("doc_id", "source", F.array("source", "lang", F.lit("x")).alias("tags"))
    renamed = sinks.rename_tag(rows, "tags", "en", "english", F.col("source") == "src1")
    dropped = sinks.rename_tag(renamed, "tags", "fr", None, F.col("source") == "src2")
    order = F.when(F.array_contains("tags", "english"), F.array("source", F.lit("english"), F.lit("x"))).otherwise(F.col("tags"))
    return dropped.select("doc_id", F.array_join(order, "|").alias("tags"))
