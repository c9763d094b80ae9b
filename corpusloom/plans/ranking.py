"""Windows, budgets, paging, set operations and catalog joins over whole tables (W, T, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import aggregates as A, layout as L, ranking as K, retrieval as V
from corpusloom.operators.running import latest, row_numbers, top_k
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query

# --- windows and budgets ---------------------------------------------------------------------------------


@query("w1_token_budget", f"""
with m as (select conv_id, turn, len({sql_tokens('text')}) as n from conversations),
 s as (select *, sum(n) over (partition by conv_id order by turn) as used from m)
select conv_id, turn, used::bigint as used, 'knowledge' as mode from s where used - n <= 0.97 * 200
union all select conv_id, turn, used::bigint, 'memory' from s where used <= 200""")
def w1(t):
    items = t.conversations.select("conv_id", "turn", X.token_count(F.col("text")).alias("n"))
    parts = [K.pack_budget(items, "conv_id", ["turn"], "n", 200, mode).withColumn("mode", F.lit(mode)) for mode in ("knowledge", "memory")]
    return A.union_all(parts).select("conv_id", "turn", "used", "mode")


def messages(t):
    """Conversation turns as memory messages; assistant turns are forgotten at a later time."""
    return t.conversations.select(
        (F.col("conv_id") % 7).alias("memory_id"), "conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        (F.col("turn") * 1000 + F.col("conv_id")).alias("valid_at"), F.when(F.col("role") == "system", 0).otherwise(1).alias("status"),
        F.when(F.col("role") == "assistant", F.col("conv_id") * 10 + F.col("turn")).alias("forget_at"), "text", "role")


MESSAGES_SQL = """msg as (select conv_id % 7 as memory_id, conv_id, turn, conv_id * 1000 + turn as id, turn * 1000 + conv_id as valid_at,
  case when role = 'system' then 0 else 1 end as status, case when role = 'assistant' then conv_id * 10 + turn end as forget_at, text, role from conversations)"""


@query("w2_fifo_eviction", f"""with {MESSAGES_SQL},
 s as (select *, octet_length(encode(text)) as size from msg),
 r as (select *, sum(size) over (partition by memory_id order by forget_at is null, coalesce(forget_at, valid_at), id) as freed from s)
select memory_id, id, freed::bigint as freed from r where freed - size < 9000""")
def w2(t):
    sized = messages(t).withColumn("size", F.octet_length("text").cast("long"))
    return K.fifo_eviction(sized, "memory_id", "size", F.lit(9000), "id").select("memory_id", "id", "freed")


@query("w3_recent_per_session", f"""with {MESSAGES_SQL}
select conv_id, id, row_number() over (partition by conv_id order by valid_at desc, id) as rank from msg where forget_at is null
qualify row_number() over (partition by conv_id order by valid_at desc, id) <= 3""")
def w3(t):
    visible = messages(t).filter(F.col("forget_at").isNull())
    return top_k(visible, "conv_id", [F.col("valid_at").desc(), F.col("id")], 3).select("conv_id", "id", "rank")


@query("w4_best_per_key", """
select label, vec_id, round(s, 6) as score from (select label, vec_id, list_sum(embedding::double[]) as s from embeddings) qualify row_number() over (partition by label order by round(s, 6) desc, vec_id) = 1""")
def w4(t):
    scored = t.embeddings.select("label", "vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")), 6).alias("score"))
    best = latest(scored, "label", F.struct(F.col("score"), -F.col("vec_id")))
    return best.orderBy(F.col("score").desc())


LINES_SQL = f"""ln as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
 li as (select doc_id, pos, line, len({sql_tokens('line')}) as n, case when contains(line, ' | ') then 'table' when contains(line, '!!') then 'image' else 'text' end as kind
   from ln where trim(line) <> '')"""


def doc_lines(t):
    """Non-blank lines of the documents with their token count and a kind."""
    kind = F.when(F.contains("line", F.lit(" | ")), "table").when(F.contains("line", F.lit("!!")), "image").otherwise("text")
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(~X.is_blank(F.col("line")))
    return lines.select("doc_id", F.col("pos").cast("long").alias("pos"), "line", X.token_count(F.col("line")).alias("n"), kind.alias("kind"))


@query("w5_neighbour_context", rf"""with {LINES_SQL},
 c as (select *, sum(case when kind = 'text' then n else 0 end) over (partition by doc_id order by pos) as cum from li),
 anchor as (select doc_id, pos, cum from c where kind <> 'text'),
 above as (select a.doc_id, a.pos, b.pos as bpos, b.line, b.n, 20 - (a.cum - b.cum) as remain from anchor a join c b on a.doc_id = b.doc_id and b.kind = 'text'
   and b.pos < a.pos and a.cum - b.cum < 20),
 below as (select a.doc_id, a.pos, b.pos as bpos, b.line, b.n, 20 - (b.cum - b.n - a.cum) as remain from anchor a join c b on a.doc_id = b.doc_id and b.kind = 'text'
   and b.pos > a.pos and b.cum - b.n - a.cum < 20),
 sent as (select *, 'above' as side, regexp_extract_all(line, '([^。!?？；！.]|\.[^ ]|\.$)*([。!?？；！]|\. |$)') as ss from above
   union all select *, 'below', regexp_extract_all(line, '([^。!?？；！.]|\.[^ ]|\.$)*([。!?？；！]|\. |$)') from below)
select doc_id, pos, sum(n)::bigint as tokens_seen, count(*) as parts from sent group by doc_id, pos""")
def w5(t):
    ctx = L.neighbour_context(doc_lines(t), "doc_id", "pos", "line", "n", "kind", 20)
    return ctx.groupBy("doc_id", "pos").agg(F.sum("n").alias("tokens_seen"), F.count("*").alias("parts"))


LEVEL_SQL = f"""{LINES_SQL}, lv as (select *, case when length(line) < 40 then 1 when length(line) < 90 then 2 when length(line) < 200 then 3 else 99 end as level from li)"""


def levelled(t):
    """Document lines with a title level taken from the length of the line; 99 is body text."""
    size = F.length("line")
    level = F.when(size < 40, 1).when(size < 90, 2).when(size < 200, 3).otherwise(L.BODY_LEVEL)
    return doc_lines(t).withColumn("level", level)


@query("w6_section_numbering", f"""with {LEVEL_SQL}
select doc_id, pos, (sum(case when level <= 2 then 1 else 0 end) over (partition by doc_id order by pos) -
   first(case when level <= 2 then 1 else 0 end) over (partition by doc_id order by pos))::bigint as section from lv""")
def w6(t):
    return L.section_numbers(levelled(t), "doc_id", "pos", "level", 2).select("doc_id", "pos", "section")


PATH_SQL = f"""{LEVEL_SQL},
 m as (select *, max(case when level = 1 then pos end) over w as p1, max(case when level = 2 then pos end) over w as p2, max(case when level = 3 then pos end) over w as p3
   from lv window w as (partition by doc_id order by pos)),
 v as (select *, p1 as q1, case when p2 > coalesce(p1, -1) then p2 end as q2, case when p3 > greatest(coalesce(p1, -1), coalesce(p2, -1)) then p3 end as q3 from m)"""


@query("w7_heading_path", f"""with {PATH_SQL}
select doc_id, pos, concat_ws('/', q1, q2, q3) as path from v""")
def w7(t):
    return L.heading_path(levelled(t), "doc_id", "pos", "level", F.col("pos").cast("string"), 3).select(
        "doc_id", "pos", F.array_join("path", "/").alias("path"))


@query("w8_frequent_title_level", f"""with {LEVEL_SQL}, c as (select doc_id, level, count(*) as n, min(pos) as first from lv where level < 99 group by all)
select doc_id, level from c qualify row_number() over (partition by doc_id order by n desc, level) = 1""")
def w8(t):
    return L.frequent_level(levelled(t), "doc_id", "level")


@query("w9_hierarchy_level", f"""with {LEVEL_SQL}, d as (select distinct doc_id, level from lv where level < 99),
 r as (select *, row_number() over (partition by doc_id order by level) as k, count(*) over (partition by doc_id) as n from d)
select doc_id, level as target from r where k = least(2, n)""")
def w9(t):
    return L.hierarchy_level(levelled(t), "doc_id", "level", 2)


@query("w10_document_progress", """
with tk as (select l_orderkey, case l_returnflag when 'A' then 1.0 when 'N' then case when l_linestatus = 'O' then 0.5 else 1.0 end else -1.0 end as p
  from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'P')
select l_orderkey, round(case when bool_or(p >= 0 and p < 1) then sum(greatest(p, 0)) / count(*) when bool_or(p = -1) then -1 else 1 end, 6)::double as progress,
 case when bool_or(p >= 0 and p < 1) then 'running' when bool_or(p = -1) then 'fail' else 'done' end as status from tk group by 1""")
def w10(t):
    p = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "R", -1.0).otherwise(F.when(F.col("l_linestatus") == "O", 0.5).otherwise(1.0))
    running_docs = t.orders.filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("l_orderkey"))
    tasks = t.lineitem.select("l_orderkey", p.alias("p")).join(running_docs, "l_orderkey", "left_semi")
    return K.document_progress(tasks, "l_orderkey", "p").withColumn("progress", F.round("progress", 6))


SPLIT_SQL = """base as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint) as w from lineitem),
 tot as (select *, sum(w) over (partition by l_orderkey) as total from base),
 raw as (select *, 100 * w::double / total::double as raw from tot), fl as (select *, floor(raw)::bigint as f from raw),
 shares as (select *, f + case when row_number() over (partition by l_orderkey order by raw - f desc, l_linenumber, l_partkey, l_suppkey) <=
   100 - sum(f) over (partition by l_orderkey) then 1 else 0 end as share from fl)"""


@query("w11_largest_remainder", f"with {SPLIT_SQL} select l_orderkey, l_linenumber, l_partkey, l_suppkey, share::bigint as share from shares")
def w11(t):
    return line_shares(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "share")


def line_shares(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("w"))
    return K.split_budget(rows, "l_orderkey", "w", 100, ["l_linenumber", "l_partkey", "l_suppkey"])


@query("w12_latest_version", """
select p_name, (max_by(v, v.a * 1000000 + v.b * 1000 + v.c)).s as version from (
 select p_name, {'s': (p_size // 10) || '.' || (p_size % 10) || '.' || (p_partkey % 13), 'a': p_size // 10, 'b': p_size % 10, 'c': p_partkey % 13} as v from part
 where p_brand <> 'Brand#3') group by p_name""")
def w12(t):
    version = F.concat_ws(".", F.floor(F.col("p_size") / 10), F.col("p_size") % 10, F.col("p_partkey") % 13)
    rows = t.part.select("p_name", F.when(F.col("p_brand") == "Brand#3", F.concat(F.lit("v"), version)).otherwise(version).alias("version"))
    return K.latest_version(rows, "p_name", "version")


@query("w13_collision_names", """
with new as (select p_partkey, p_name || '.v1.txt' as name, row_number() over (partition by p_name order by p_partkey) as k from part),
 taken as (select distinct p_name as b, 0 as c from part where p_brand = 'Brand#1' union select distinct p_name, 3 from part where p_brand = 'Brand#2'),
 cand as (select p_name as b, c, row_number() over (partition by p_name order by c) as k from (select distinct p_name from part), range(0, (select count(*) + 10 from part)) r(c)
   where not exists (select 1 from taken where taken.b = p_name and taken.c = r.c))
select p_partkey, case when c = 0 then name else replace(name, '.txt', '(' || c || ').txt') end as free_name
from new join cand on cand.b || '.v1.txt' = new.name and cand.k = new.k""")
def w13(t):
    new = t.part.select("p_partkey", F.concat("p_name", F.lit(".v1.txt")).alias("name"))
    brand = F.col("p_brand")
    taken = t.part.filter(brand.isin("Brand#1", "Brand#2")).select(
        F.concat("p_name", F.when(brand == "Brand#1", ".v1.txt").otherwise(".v1(3).txt")).alias("name"))
    return K.free_names(new, taken, "name", "p_partkey").select("p_partkey", "free_name")


# --- order, pages, sets -------------------------------------------------------------------------------------


@query("t1_multi_key_order", f"""
with d as (select doc_id, case when lang <> 'de' then list_avg(list_transform(string_split(text, chr(10)), lambda l: length(l))) end as k, source from documents)
select doc_id, row_number() over (order by k asc nulls last, source desc, doc_id) as place from d""")
def t1(t):
    sizes = F.when(F.col("lang") != "de", F.transform(F.split("text", "\n"), F.length))
    keyed = t.documents.select("doc_id", "source", K.list_mean(sizes).alias("k"))
    return row_numbers(keyed, [], [F.col("k").asc_nulls_last(), F.col("source").desc(), F.col("doc_id")], "place").select("doc_id", "place")


@query("t2_offset_page", """
select o_orderkey, (select count(*) from orders where o_orderstatus = 'F') as total from orders where o_orderstatus = 'F'
order by o_totalprice desc, o_orderkey limit 20 offset 40""")
def t2(t):
    whole = t.orders.filter(F.col("o_orderstatus") == "F")
    page = whole.orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(40).limit(20).select("o_orderkey")
    return K.with_total(page, whole)


@query("t3_keyset_page", """
select l_orderkey, l_linenumber, l_partkey from lineitem where (l_orderkey, l_linenumber, l_partkey) > (500, 3, 0)
order by l_orderkey, l_linenumber, l_partkey limit 100""")
def t3(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return K.after(rows, keys, [F.lit(500).cast("long"), F.lit(3), F.lit(0).cast("long")], 100)


OVERLAP_SQL = f"""qt as (select distinct item_id, unnest({sql_tokens('text')}) as term from benchmark),
 dt as (select distinct doc_id, unnest({sql_tokens('text')}) as term from documents),
 hits as (select item_id as query_id, doc_id, count(*) as n from qt join dt using (term) group by all)"""


def overlap_hits(t):
    return V.term_overlap(t.benchmark, "item_id", t.documents, "doc_id").withColumnRenamed("item_id", "query_id")


@query("t4_rerank_window", f"""with {OVERLAP_SQL}, r as (select *, row_number() over (partition by query_id order by n desc, doc_id) as rank from hits)
select query_id, doc_id, rank from r where rank > 70 + 10 and rank <= 70 + 20""")
def t4(t):
    # size 10 -> windows of 70; page 9 is the second page of the second window
    assert K.rerank_window(9, 10) == (70, 70, 10)
    return K.window_page(overlap_hits(t), "query_id", [F.col("n").desc(), F.col("doc_id")], 9, 10).select("query_id", "doc_id", "rank")


@query("t5_threshold_rank", f"""with {OVERLAP_SQL}, tot as (select item_id as query_id, count(*) as total from qt group by 1),
 s as (select query_id, doc_id, round(n / total, 6) as similarity from hits join tot using (query_id)),
 r as (select *, 'vector' as mode from s where similarity >= 0.4 union all select *, 'text' from s)
select query_id, doc_id, similarity, mode, row_number() over (partition by query_id, mode order by similarity desc, doc_id) as rank from r""")
def t5(t):
    totals = V.distinct_terms(t.benchmark, "item_id").groupBy(F.col("item_id").alias("query_id")).agg(F.count("*").alias("total"))
    sims = overlap_hits(t).join(totals, "query_id").select("query_id", "doc_id", F.round(F.col("n") / F.col("total"), 6).alias("similarity"))
    strict = K.threshold_rank(sims, "query_id", "similarity", 0.4, "doc_id").withColumn("mode", F.lit("vector"))
    free = K.threshold_rank(sims, "query_id", "similarity", 0.4, "doc_id", vector_weight=0.0).withColumn("mode", F.lit("text"))
    return strict.unionByName(free)


@query("t6_scatter_gather", """
select doc_id, lang, n_chars, case when lang = 'en' then source end as source from documents order by n_chars desc, doc_id limit 60""")
def t6(t):
    docs = t.documents
    frames = [docs.filter(F.col("lang") == "en").select("doc_id", "lang", "n_chars", "source")]
    frames += [docs.filter(F.col("lang") == lang).select("doc_id", "lang", "n_chars") for lang in ("fr", "de", "es")]
    return K.scatter_gather(frames, [F.col("n_chars").desc(), F.col("doc_id")], 60)


@query("t7_ordered_dedupe", """
select min(doc_id) as doc_id, 'row' as kind, count(distinct lang) as n from documents group by text, lang
union all select doc_id, 'list', len(list_distinct(string_split(text, chr(10)))) from documents""")
def t7(t):
    rows = K.keep_first(t.documents.select("doc_id", "text", "lang"), ["text", "lang"], F.col("doc_id"))
    lists = t.documents.select("doc_id", F.lit("list").alias("kind"), F.size(F.array_distinct(F.split("text", "\n"))).cast("long").alias("n"))
    return rows.select("doc_id", F.lit("row").alias("kind"), F.lit(1).cast("long").alias("n")).unionByName(lists)


@query("t8_round_merge", f"""with {OVERLAP_SQL}
select doc_id, min(query_id) as first_round from hits where n >= 5 group by doc_id""")
def t8(t):
    hits = overlap_hits(t).filter(F.col("n") >= 5).select("doc_id", F.col("query_id").alias("first_round"))
    return K.merge_rounds(hits, ["doc_id"], "first_round")


def docs_v1(t):
    """First snapshot: everything that is not Spanish."""
    return t.documents.filter(F.col("lang") != "es").select("doc_id", "text", "source", F.md5("text").alias("fp"))


def docs_v2(t):
    """Second snapshot: low-quality documents are gone, toxic ones rewritten, Spanish ones new."""
    marked = t.documents.join(t.labels, "doc_id", "left").filter(F.coalesce("quality", F.lit(1)) == 1)
    text = F.when(F.coalesce("toxic", F.lit(0)) == 1, F.concat(F.lit("edited "), "text")).otherwise(F.col("text"))
    return marked.select("doc_id", text.alias("text"), "source").withColumn("fp", F.md5("text"))


SNAPSHOT_SQL = """v1 as (select doc_id, text, source, md5(text) as fp from documents where lang <> 'es'),
 v2 as (select doc_id, case when coalesce(toxic, 0) = 1 then 'edited ' || text else text end as text, source,
   md5(case when coalesce(toxic, 0) = 1 then 'edited ' || text else text end) as fp from documents left join labels using (doc_id) where coalesce(quality, 1) = 1),
 diff as (select coalesce(v1.doc_id, v2.doc_id) as doc_id, case when v1.doc_id is null then 'added' when v2.doc_id is null then 'removed'
   when v1.fp = v2.fp then 'unchanged' else 'updated' end as status from v1 full join v2 on v1.doc_id = v2.doc_id)"""


@query("t9_key_set_diff", f"with {SNAPSHOT_SQL} select doc_id, status from diff")
def t9(t):
    return K.key_diff(docs_v1(t), docs_v2(t), "doc_id", "fp")


@query("t10_set_algebra", """
select doc_id, 'and' as op from labels where quality = 1 intersect select doc_id, 'and' from documents where lang = 'en'
union all (select doc_id, 'minus' from documents except select doc_id, 'minus' from labels)
union all (select doc_id, 'or' from labels where toxic = 1 union select doc_id, 'or' from documents where lang = 'fr')""")
def t10(t):
    docs, labels = t.documents, t.labels
    both = labels.filter("quality = 1").select("doc_id").intersect(docs.filter("lang = 'en'").select("doc_id"))
    minus = docs.select("doc_id").subtract(labels.select("doc_id"))
    either = labels.filter("toxic = 1").select("doc_id").union(docs.filter("lang = 'fr'").select("doc_id")).distinct()
    tag = lambda df, op: df.withColumn("op", F.lit(op))
    return A.union_all([tag(both, "and"), tag(minus, "minus"), tag(either, "or")])


@query("t11_chunk_listing", f"""with {LINES_SQL}
select doc_id, pos, n from li where kind = 'text' order by doc_id, pos, n limit 128 offset 16""")
def t11(t):
    chunks = doc_lines(t).filter(F.col("kind") == "text")
    return chunks.select("doc_id", "pos", "n").orderBy("doc_id", "pos", "n").offset(16).limit(128)


# --- joins ------------------------------------------------------------------------------------------------


@query("j1_catalog_join", """
select o_orderkey, c_name, n_name, case when r_name = 'ASIA' then r_name end as region from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def j1(t):
    asia = t.region.filter(F.col("r_name") == "ASIA")
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(asia, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", F.col("r_name").alias("region")))


@query("j3_outer_merge", """
select coalesce(s.k, c.k, n_nationkey) as k, suppliers, customers, n_name from (select s_nationkey as k, count(*) as suppliers from supplier where s_acctbal > 5000 group by 1) s
full join (select c_nationkey as k, count(*) as customers from customer where c_acctbal > 9000 group by 1) c on s.k = c.k full join nation on coalesce(s.k, c.k) = n_nationkey""")
def j3(t):
    s = t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    c = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    return L.outer_merge([s, c, t.nation.select(F.col("n_nationkey").alias("k"), "n_name")], "k")


@query("j4_semi_join_prune", "select doc_id, quality from labels semi join (select doc_id from documents where lang <> 'fr') using (doc_id)")
def j4(t):
    alive = t.documents.filter(F.col("lang") != "fr").select("doc_id")
    return t.labels.join(alive, "doc_id", "left_semi").select("doc_id", "quality")


@query("j5_anti_join", "select doc_id, source from documents anti join labels using (doc_id)")
def j5(t):
    return t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left_anti")


@query("j6_metadata_enrichment", f"""with {LINES_SQL}
select doc_id, pos, case when quality is not null then quality || '|' || toxic end as meta from li left join labels using (doc_id)""")
def j6(t):
    meta = t.labels.select("doc_id", F.create_map(F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.col("toxic").cast("string"), F.lit("skip"), F.lit("x")).alias("m"))
    rows = L.attach_metadata(doc_lines(t).select("doc_id", "pos"), meta, "doc_id", "m", ["quality", "toxic"], "meta")
    return rows.select("doc_id", "pos", F.when(F.col("meta").isNotNull(), F.concat_ws("|", F.col("meta")["quality"], F.col("meta")["toxic"])).alias("meta"))


@query("j7_parent_child", f"""with {LINES_SQL}
select distinct md5(text) as id, null as parent_id, 0 as available, length(text) as size from documents
union all select md5(line || doc_id || '#' || pos), md5(text), 1, length(line) from li join documents using (doc_id)""")
def j7(t):
    children = doc_lines(t).select("doc_id", F.md5(F.concat("line", "doc_id", F.lit("#"), "pos")).alias("id"), "line")
    rows = L.with_parents(children, t.documents.select("doc_id", "text"), "doc_id", "id", "text", "line")
    return rows.select("id", "parent_id", "available", F.length("text").alias("size"))


@query("j9_message_extracts", f"""with {MESSAGES_SQL}
select m.id, m.conv_id, e.id as extract_id, row_number() over (partition by m.id order by e.id) as ordinal from msg m join msg e on e.role = 'assistant' and e.conv_id = m.conv_id and e.turn = m.turn + 1
where m.role = 'user' union all select m.id, m.conv_id, null, null from msg m anti join (select conv_id, turn - 1 as turn from msg where role = 'assistant') x using (conv_id, turn) where m.role = 'user'""")
def j9(t):
    raw = messages(t).filter(F.col("role") == "user").select("id", "conv_id")
    extracts = messages(t).filter(F.col("role") == "assistant").select((F.col("id") - 1).alias("source_id"), F.col("id").alias("extract_id"))
    return L.nest_extracts(raw, extracts, "id", "source_id", "extract_id")


@query("j12_interval_condition", """
with l as (select event_type, user_id, max(ts) as last from events group by all), c as (select distinct event_type, length(event_type) * 1440 as freq from events)
select event_type, user_id, strftime(last, '%Y-%m-%d %H:%M:%S') as last from l join c using (event_type) where last < timestamp '2024-01-31 00:00:00' - to_minutes(freq::bigint)""")
def j12(t):
    last = t.events.groupBy("event_type", "user_id").agg(F.max("ts").alias("last"))
    config = t.events.select("event_type", (F.length("event_type") * 1440).alias("freq")).distinct()
    due = K.due_tasks(last, config, "event_type", "last", "freq", "2024-01-31 00:00:00")
    return due.select("event_type", "user_id", F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last"))


TREE_SQL = """nodes as (select 'r' || r_regionkey as id, null as parent, 1 as size from region union all select 'n' || n_nationkey, 'r' || n_regionkey, 10 from nation
 union all select 'c' || c_custkey, 'n' || c_nationkey, 1000 + c_custkey from customer)"""


def tree_nodes(t):
    node = lambda df, id, parent, size: df.select(id.alias("id"), parent.alias("parent"), size.cast("long").alias("size"))
    p = lambda prefix, c: F.concat(F.lit(prefix), c)
    return A.union_all([
        node(t.region, p("r", "r_regionkey"), F.lit(None).cast("string"), F.lit(1)), node(t.nation, p("n", "n_nationkey"), p("r", "n_regionkey"), F.lit(10)),
        node(t.customer, p("c", "c_custkey"), p("n", "c_nationkey"), F.col("c_custkey") + 1000)])


@query("j17_tree_walk", f"""with recursive {TREE_SQL},
 walk as (select id, id as ancestor, 0 as depth from nodes union all select w.id, n.parent, depth + 1 from walk w join nodes n on n.id = w.ancestor where n.parent is not null)
select ancestor, sum(size)::bigint as size, count(*) as n from walk join nodes using (id) group by ancestor""")
def j17(t):
    return K.subtree_sizes(tree_nodes(t), "size")


@query("j17_tree_ancestors", f"""with recursive {TREE_SQL},
 walk as (select id, id as ancestor, 0 as depth from nodes union all select w.id, n.parent, depth + 1 from walk w join nodes n on n.id = w.ancestor where n.parent is not null)
select id, ancestor, depth from walk""")
def j17_ancestors(t):
    return K.ancestors(tree_nodes(t))
