"""Aggregations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import aggregates as A, retrieval as V
from corpusloom.operators.running import blocks
from corpusloom.plans.predicates import META_SQL, doc_meta
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query
from corpusloom.session import cut_lineage


@query("g1_terms_aggregation", """
select value, count(*) as count from (select unnest([trim(lang), trim(source)]) as value from documents) where value <> '' group by value
union all select 'given', 5""")
def g1(t):
    rows = t.documents.select(F.array(F.concat(F.lit(" "), "lang"), F.concat("source", F.lit(" ")), F.lit(" ")).alias("tags"))
    given = t.spark.sql("select 'given' as value, 5L as count")
    return A.terms(rows, "tags", given)


@query("g3_multi_facet", """
with j as (select lang, source, cast(quality as varchar) as quality, cast(toxic as varchar) as toxic from documents left join labels using (doc_id))
select 'lang' as facet, lang as value, count(*) as count from j group by all union all select 'source', source, count(*) from j group by all
union all select 'quality', coalesce(quality, 'empty_metadata'), count(*) from j group by all
union all select 'toxic', coalesce(toxic, 'empty_metadata'), count(*) from j group by all""")
def g3(t):
    return A.facets(t.documents.join(t.labels, "doc_id", "left"), ["lang", "source", "quality", "toxic"])


@query("g4_status_pivot", """
select o_orderpriority, count(*) filter (o_orderstatus = 'F') as "F", count(*) filter (o_orderstatus = 'O') as "O",
 count(*) filter (o_orderstatus = 'P') as "P", 0::bigint as "X" from orders group by 1""")
def g4(t):
    return A.status_pivot(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P", "X"])


@query("g5_conditional_sums", """
select count(*) filter (o_orderstatus = 'F') as finished, count(*) filter (o_orderstatus = 'O') as processing,
 count(*) filter (o_orderstatus = 'P') as failed, count(*) filter (o_orderstatus = 'P' and o_totalprice < 1000) as cancelled,
 count(*) filter (o_orderdate >= timestamp '1998-01-01') as downloaded from orders""")
def g5(t):
    s = F.col("o_orderstatus")
    return t.orders.agg(
        F.count_if(s == "F").alias("finished"), F.count_if(s == "O").alias("processing"), F.count_if(s == "P").alias("failed"),
        F.count_if((s == "P") & (F.col("o_totalprice") < 1000)).alias("cancelled"),
        F.count_if(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("downloaded"))


@query("g6_daily_usage", """
select strftime(ts, '%Y-%m-%d') as day, count(*) as n, count(distinct user_id) as users, round(sum(value), 4) as total,
 round(avg(value), 6) as mean from events where ts >= timestamp '2024-01-05' and ts <= timestamp '2024-01-20 23:59:59' group by 1""")
def g6(t):
    daily = A.daily_stats(t.events, "ts", "user_id", {"total": F.col("value")}, "2024-01-05", "2024-01-20")
    return daily.select("day", "n", "users", F.round("total", 4).alias("total"), F.round(F.col("total") / F.col("n"), 6).alias("mean"))


@query("g7_metadata_summary", f"""with {META_SQL},
 v as (select key, value, count(*) as count from meta group by all)
select key, case when key in ('lang', 'source') then 'string' else 'number' end as type, value, count,
 row_number() over (partition by key order by count desc, value) as rank from v""")
def g7(t):
    meta = doc_meta(t).withColumn("kind", A.value_kind(F.col("value")))
    return A.metadata_summary(meta).select("key", "type", "value", "count", "rank")


@query("g8_inverted_metadata", f"""with {META_SQL}
select key, value, doc_id // 4096 as block, count(*) as n, string_agg(cast(doc_id as varchar), ',' order by doc_id) as ids
from meta group by key, value, doc_id // 4096""")
def g8(t):
    return blocks(doc_meta(t), ["key", "value"], "doc_id").select("key", "value", "block", "n", F.array_join("items", ",").alias("ids"))


@query("g9_size_totals", """
select source, coalesce(sum(n_chars) filter (lang <> 'en'), 0)::bigint as size, count(*) filter (lang <> 'en') as n from documents group by source""")
def g9(t):
    other = F.col("lang") != "en"
    return t.documents.groupBy("source").agg(
        F.coalesce(F.sum(F.when(other, F.col("n_chars"))), F.lit(0)).alias("size"), F.count_if(other).alias("n"))


@query("g10_tag_priors", """
select source as tag, round((count(*) + 1) / ((select count(*) from documents) + 1000), 9) as prior from documents group by source""")
def g10(t):
    return A.tag_priors(t.documents, "source").withColumn("prior", F.round("prior", 9))


TAG_SQL = f"""qt as (select distinct item_id, unnest({sql_tokens('text')}) as term from benchmark),
 dt as (select distinct doc_id, source, unnest({sql_tokens('text')}) as term from documents),
 m as (select item_id, doc_id, source as tag, count(*) as n from qt join dt using (term) group by all),
 keep as (select m.* from m join (select item_id, count(*) as total from qt group by 1) using (item_id) where n >= 0.7 * total),
 c0 as (select item_id, tag, count(*) as c from keep group by all),
 c as (select *, sum(c) over (partition by item_id) as cnt from c0),
 pr as (select source as tag, (count(*) + 1) / ((select count(*) from documents) + 10) as prior from documents group by 1),
 s as (select item_id, tag, cast(round_even(0.1 * (c + 1) / (cnt + 10) / greatest(0.000001, prior), 0) as bigint) as score from c join pr using (tag)),
 r as (select *, row_number() over (partition by item_id order by score desc, tag) as rank from s)"""


@query("g11_tag_scoring", f"""with {TAG_SQL}
select item_id, tag, score, rank, 'chunk' as kind from r where rank <= 3 and score > 0
union all select item_id, tag, greatest(score, 1), rank, 'query' from r where rank <= 3""")
def g11(t):
    matches = V.term_overlap(t.benchmark, "item_id", t.documents, "doc_id", keep=["source"], min_share=0.7).withColumnRenamed("source", "tag")
    priors = A.tag_priors(t.documents, "source", 10)
    chunk = A.tag_scores(matches, priors, "item_id", smoothing=10).withColumn("kind", F.lit("chunk"))
    asked = A.tag_scores(matches, priors, "item_id", smoothing=10, floor=1).withColumn("kind", F.lit("query"))
    return chunk.unionByName(asked)


RUN_SQL = f"""qt as (select distinct item_id, unnest({sql_tokens('text')}) as term from benchmark),
 dt as (select distinct doc_id, unnest({sql_tokens('text')}) as term from documents),
 m as (select item_id, doc_id, count(*) as n from qt join dt using (term) group by all),
 run as (select * from (select item_id as query_id, doc_id, n, row_number() over (partition by item_id order by n desc, doc_id) as rank from m) where rank <= 30),
 qrels as (select item_id as query_id, doc_id, 1 as rel from benchmark b join documents d on contains(d.text, b.text)),
 j as (select run.*, coalesce(rel, 0) as rel from run left join qrels using (query_id, doc_id)),
 nr as (select query_id, count(*) as n_rel from qrels group by 1),
 cases as (select query_id, coalesce(h / n, 0) as precision, coalesce(h, 0) / n_rel as recall, case when h > 0 then 1.0::double else 0.0::double end as hit_rate,
   coalesce(1 / first, 0) as mrr from nr left join (select query_id, count(*) as n, sum(rel)::bigint as h, min(case when rel > 0 then rank end) as first from j group by 1) using (query_id)),
 met as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from cases)"""


def overlap_run(t):
    """Documents ranked by shared distinct terms, best 30 per benchmark passage, and the judgments."""
    hits = V.term_overlap(t.benchmark, "item_id", t.documents, "doc_id")
    run = V.top_k(hits, "item_id", [F.col("n").desc(), F.col("doc_id")], 30).withColumnRenamed("item_id", "query_id")
    judged = V.containment_judgments(t.benchmark, "item_id", t.documents, "doc_id").withColumnRenamed("item_id", "query_id")
    return cut_lineage(run), cut_lineage(judged)  # small, and read several times by the metrics


@query("g12_retrieval_metrics", f"""with {RUN_SQL}
select query_id, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, hit_rate, round(mrr, 6) as mrr from met""")
def g12(t):
    m = A.retrieval_metrics(*overlap_run(t))
    return m.select("query_id", *[F.round(c, 6).alias(c) for c in A.METRICS])


@query("g13_evaluation_summary", f"""with {RUN_SQL}
select count(*) as total_cases, 1.5::double as avg_execution_time, round(avg(precision), 6) as avg_precision, round(avg(recall), 6) as avg_recall,
 round(avg(f1), 6) as avg_f1, round(avg(hit_rate), 6) as avg_hit_rate, round(avg(mrr), 6) as avg_mrr from met""")
def g13(t):
    s = A.evaluation_summary(A.retrieval_metrics(*overlap_run(t)).withColumn("execution_time", F.lit(1.5)))
    return s.select("total_cases", *[F.round(c, 6).alias(c) for c in s.columns if c != "total_cases"])


@query("g14_evaluation_flags", f"""with {RUN_SQL}
select array_to_string(list_filter([case when avg(precision) < 0.7 then 'Low Precision' end, case when avg(recall) < 0.7 then 'Low Recall' end,
 'Slow Response Time'], lambda x: x is not null), ',') as flags from met""")
def g14(t):
    s = A.evaluation_summary(A.retrieval_metrics(*overlap_run(t)).withColumn("execution_time", F.lit(6.5)))
    return s.select(F.array_join(A.evaluation_flags(s), ",").alias("flags"))


RANK_SQL = """dcg as (select query_id, sum(rel / log2(rank + 1)) as dcg, min(case when rel > 0 then rank end) as first from j where rank <= 10 group by 1),
 seen as (select query_id, rank, rel, sum(rel) over (partition by query_id order by rank) as s from j where rank <= 5),
 ap as (select query_id, sum(case when rel > 0 then s / rank else 0 end) as ap from seen group by 1),
 ideal as (select query_id, n_rel, list_sum(list_transform(range(1, least(n_rel, 10) + 1), lambda i: 1 / log2(i + 1))) as idcg from nr),
 scores as (select query_id, coalesce(dcg / idcg, 0) as ndcg10, coalesce(ap / least(n_rel, 5), 0) as map5, coalesce(1 / first, 0) as mrr10
   from dcg left join ap using (query_id) left join ideal using (query_id))"""


@query("g15_ranking_metrics", f"""with {RUN_SQL}, {RANK_SQL}
select cast(query_id as varchar) as query, round(ndcg10, 6) as ndcg10, round(map5, 6) as map5, round(mrr10, 6) as mrr10 from scores
union all select 'all', round(avg(ndcg10), 6), round(avg(map5), 6), round(avg(mrr10), 6) from scores""")
def g15(t):
    scores = A.ranking_metrics(*overlap_run(t))
    each = scores.select(F.col("query_id").cast("string").alias("query"), "ndcg10", "map5", "mrr10")
    whole = scores.agg(*[F.avg(c).alias(c) for c in ("ndcg10", "map5", "mrr10")]).withColumn("query", F.lit("all"))
    rounded = [F.round(c, 6).alias(c) for c in ("ndcg10", "map5", "mrr10")]
    return each.unionByName(whole).select("query", *rounded).orderBy("ndcg10")


@query("g16_column_types", """
with c as (select o_orderkey::varchar as k, case when o_orderstatus = 'P' then '' else o_totalprice::varchar end as p, strftime(o_orderdate, '%Y-%m-%d') as d,
  case o_orderstatus when 'F' then 'yes' else 'No' end as b, o_orderpriority as x, o_orderkey::varchar || '0000000000000000000' as big from orders),
 l as (unpivot c on k, p, d, b, x, big into name col value cell),
 g as (select col as "column", case when regexp_matches(cell, '^[+-]?[0-9]+$') and not starts_with(cell, '0') then 'int'
   when regexp_matches(cell, '^[+-]?[0-9.]{0,19}$') and not starts_with(cell, '0') then 'float' when lower(cell) in ('yes', 'no') then 'bool'
   when regexp_matches(cell, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') then 'datetime' else 'text' end as kind from l)
select "column", case "column" when 'k' then 'int' when 'p' then 'float' when 'd' then 'datetime' when 'b' then 'bool' when 'x' then 'text' else 'float' end as type,
 count(*) filter (kind = 'int') as int, count(*) filter (kind = 'float') as float, count(*) filter (kind = 'text') as text,
 count(*) filter (kind = 'datetime') as datetime, count(*) filter (kind = 'bool') as bool from g group by 1""")
def g16(t):
    return A.infer_types(order_cells(t), CELLS)


CELLS = ["k", "p", "d", "b", "x", "big"]


def order_cells(t):
    """Orders as text cells: numbers, blanks, dates, yes and no, words, numbers too long for an integer."""
    price = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.format_string("%.2f", "o_totalprice"))
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("k"), price.alias("p"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("No").alias("b"), F.col("o_orderpriority").alias("x"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("0" * 19)).alias("big"))


@query("g16_cast_columns", """
select o_orderkey as k, case when o_orderstatus <> 'P' then o_totalprice::double end as p, strftime(o_orderdate, '%Y-%m-%d') as d, case when o_orderstatus = 'F' then 'yes' else 'no' end as b, o_orderpriority as x, (o_orderkey::varchar || '0000000000000000000')::double as big from orders""")
def g16_cast(t):
    return A.cast_inferred(order_cells(t), CELLS).withColumn("d", F.date_format("d", "yyyy-MM-dd"))


@query("g17_latency_summary", """
with r as (select event_type, value, row_number() over (partition by event_type order by value) as rn, count(*) over (partition by event_type) as n from events)
select event_type, max(n) as count, round(avg(value), 6) as avg, min(value) as min, min(case when rn >= ceil(0.5 * n) then value end) as p50,
 min(case when rn >= ceil(0.9 * n) then value end) as p90, min(case when rn >= ceil(0.95 * n) then value end) as p95 from r group by 1""")
def g17(t):
    return A.summarize(t.events, "event_type", "value").withColumn("avg", F.round("avg", 6))


@query("g18_row_metadata", """
with l as (select l_orderkey, l_linenumber * 100000000 + l_partkey * 10000 + l_suppkey as pos, l_returnflag, l_linestatus from lineitem),
 u as (select l_orderkey, pos, 'l_returnflag' as key, l_returnflag as value from l union all select l_orderkey, pos, 'l_linestatus', l_linestatus from l),
 f as (select l_orderkey, key, value, min(pos) as first from u group by all)
select l_orderkey, key, row_number() over (partition by l_orderkey, key order by first, value) as ordinal, value from f""")
def g18(t):
    pos = F.col("l_linenumber") * 100000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")
    rows = t.lineitem.select("l_orderkey", pos.alias("pos"), "l_returnflag", "l_linestatus")
    return A.first_seen_values(rows, "l_orderkey", "pos", ["l_returnflag", "l_linestatus"])


@query("g19_metadata_merge", f"""
with w as (select doc_id, unnest({sql_tokens('text')}) as value, generate_subscripts({sql_tokens('text')}, 1) as idx from documents),
 words as (select doc_id, 'words' as key, value, min(idx) as first from w where length(value) = 3 group by all),
 mixed as (select doc_id, 'mixed' as key, lang as value, 2 as first from documents union all select doc_id, 'mixed', source, 3 from documents)
select doc_id, key, row_number() over (partition by doc_id, key order by first) as ordinal, value from words
union all select doc_id, 'last', 1, source from documents
union all select doc_id, key, row_number() over (partition by doc_id, key order by first), value from mixed""")
def g19(t):
    none = F.lit(0)
    entry = lambda df, pos, key, value, is_list, idx=none: df.select(
        "doc_id", F.lit(pos).alias("pos"), idx.alias("idx"), F.lit(key).alias("key"), value.alias("value"), F.lit(is_list).alias("is_list"))
    words = t.documents.select("doc_id", F.posexplode(X.tokens(F.col("text"))).alias("i", "w")).filter(F.length("w") == 3)
    parts = [
        entry(words, 1, "words", F.col("w"), True, F.col("i")), entry(words, 2, "words", F.col("w"), True, F.col("i")),
        entry(t.documents, 1, "last", F.col("lang"), False), entry(t.documents, 2, "last", F.col("source"), False),
        entry(t.documents, 1, "mixed", F.lit("gone"), False), entry(t.documents, 2, "mixed", F.col("lang"), True),
        entry(t.documents, 3, "mixed", F.col("source"), False), entry(t.documents, 4, "mixed", F.col("lang"), False),
    ]
    return A.merge_metadata(A.union_all(parts))


@query("g20_usage_accumulation", """
select user_id, event_type, (sum(cast(json_extract(props, '$.k') as bigint)) + 10 * count(*))::bigint as used from events group by all""")
def g20(t):
    used = t.events.select("user_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("used"))
    totals = used.groupBy("user_id", "event_type").agg((F.count("*") * 10).alias("used"))
    return A.accumulate(totals, used, ["user_id", "event_type"], "used")


@query("g21_memory_size", "select conv_id, sum(octet_length(encode(text)) + 64 * 4)::bigint as size from conversations group by 1")
def g21(t):
    return t.conversations.groupBy("conv_id").agg(F.sum(F.octet_length("text") + 64 * 4).alias("size"))


@query("g22_max_id", "select max(conv_id) as conv_id, 'some' as kind from conversations union all select 1, 'none'")
def g22(t):
    none = t.conversations.filter(F.col("conv_id") < 0)
    return A.next_id(t.conversations, "conv_id").withColumn("kind", F.lit("some")).unionByName(
        A.next_id(none, "conv_id").withColumn("kind", F.lit("none")))


@query("g25_batch_metadata_edit", """
select d.doc_id, case when l.doc_id is null then null else lang end as lang, case when l.doc_id is null then 'new'
   else array_to_string(list_distinct_sorted, ',') end as tags, 'x' as owner, true as changed
from documents d left join labels l using (doc_id), lateral (select case when source = 'src1' then ['new', 'one'] else list_sort(['new', source]) end as list_distinct_sorted)""")
def g25(t):
    cell = lambda is_list, values: F.struct(F.lit(is_list).alias("is_list"), values.alias("vals"))
    given = F.map_from_arrays(F.array(F.lit("lang"), F.lit("tags"), F.lit("junk")), F.array(
        cell(False, F.array("lang")), cell(True, F.array("source", F.lit("old"))), cell(False, F.array(F.lit("1")))))
    rows = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.when(F.col("quality").isNotNull(), given).cast(A.META_TYPE).alias("meta"))
    out = A.batch_edit(
        rows, "meta",
        updates=[{"key": "tags", "value": ["new"]}, {"key": "tags", "value": "one", "match": "src1"}, {"key": "owner", "value": "x"}, {"key": "zzz", "value": "y", "match": "q"}],
        deletes=[{"key": "junk"}, {"key": "tags", "value": "old"}, {"key": "lang", "value": "xx"}])
    value = lambda k: F.array_join(F.array_sort(F.try_element_at(F.col("meta"), F.lit(k))["vals"]), ",")
    return out.select("doc_id", value("lang").alias("lang"), value("tags").alias("tags"), value("owner").alias("owner"), "changed")


@query("g26_corpus_term_statistics", f"""
select term, count(distinct doc_id) as df, count(*) as cf, (select count(*) from documents) as n,
 round((select avg(len({sql_tokens('text')})) from documents), 6) as avg_len
from (select doc_id, unnest({sql_tokens('text')}) as term from documents) group by term""")
def g26(t):
    return V.term_statistics(t.documents, "doc_id").withColumn("avg_len", F.round("avg_len", 6))
