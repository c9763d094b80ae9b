"""Embedding and enrichment over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X, vectors as VEC
from corpusloom.operators import aggregates as A, chunking as C, enrich as E, retrieval as V
from corpusloom.plans.aggregates import TAG_SQL
from corpusloom.plans.chunking import MERGED
from corpusloom.plans.ranking import LINES_SQL, doc_lines
from corpusloom.plans.retrieval import STATS
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query


@query("e1_embedding_input", r"""
select page_id, md5(case when page_id % 3 = 0 then 'None' when page_id % 3 = 1 then 'Q ' || url else regexp_replace(html, '</?(table|td|caption|tr|th)( [^<>]{0,12})?>', ' ', 'g') end) as input from pages""")
def e1(t):
    text = F.when(F.col("page_id") % 3 == 0, F.lit("<table> </table>")).otherwise(F.col("html"))
    questions = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("Q "), "url")).otherwise("")
    return t.pages.select("page_id", F.md5(E.embedding_input(text, questions)).alias("input"))


@query("e2_batch_embedding")
def e2(t):
    """Unit TF-IDF vectors; the norm is 1 for every text that has a term (checked in the tests)."""
    vectors = E.tfidf_embedding(t.documents, "doc_id", "text", 128)
    return vectors.select("doc_id", "vector", F.size("vector").alias("dim"), F.round(VEC.norm(F.col("vector")), 6).alias("norm"))


def _toy_model(texts):
    return [[float(len(x)), float(x.count(" "))] for x in texts]


@query("e2_model_plug_in", f"""select doc_id, length(h)::double as a, (length(h) - length(replace(h, ' ', '')))::double as b from (select doc_id, array_to_string({sql_tokens('text')}, ' ') as h from documents)""")
def e2_plug_in(t):
    out = E.encode_batches(t.documents, "doc_id", "text", _toy_model)
    return out.select("doc_id", F.col("vector")[0].alias("a"), F.col("vector")[1].alias("b"))


@query("e3_title_blend", """
select vec_id, d as dim, round(0.1::double * embedding[d + 1]::double + 0.9::double * embedding[d + 2]::double, 6) as value from embeddings, lateral (select unnest(range(63))::int as d)""")
def e3(t):
    blended = E.title_blend(F.slice("embedding", 1, 63), F.slice("embedding", 2, 63))
    return t.embeddings.select("vec_id", F.posexplode(blended).alias("dim", "value")).withColumn("value", F.round("value", 6))


def _measure(texts):
    return [str(len(x)) for x in texts]


@query("e4_cached_enrichment", """
select cast(doc_id as varchar) as id, case when lang = 'es' then 'cached' else cast(length(text) as varchar) end as result, 'row' as kind from documents
union all select md5(concat_ws(chr(1), 'm', text, 'shout', '')), cast(length(text) as varchar), 'fresh' from (select distinct text from documents where text not in (select text from documents where lang = 'es'))""")
def e4(t):
    cache = t.documents.filter(F.col("lang") == "es").select(E.work_key("m", F.col("text"), "shout", "").alias("work_key"), F.lit("cached").alias("result")).distinct()
    rows, fresh = E.cached_enrichment(t.documents.select("doc_id", "text"), "text", cache, _measure, "m", "shout")
    return rows.select(F.col("doc_id").cast("string").alias("id"), "result", F.lit("row").alias("kind")).unionByName(
        fresh.select(F.col("work_key").alias("id"), "result", F.lit("fresh").alias("kind")))


@query("e5_keywords", f"""with {STATS}, c as (select doc_id, term, count(*) as tf from de group by all),
 s as (select doc_id, term, round(tf * ln((select count(*) from documents) / df), 6) as score from c join st using (term)),
 r as (select *, row_number() over (partition by doc_id order by score desc, term) as rank from s)
select doc_id, term, score, rank from r where rank <= 5
union all select doc_id, lang || '|' || source, 0, 0 from documents""")
def e5(t):
    best = E.top_keywords(t.documents, "doc_id", "text", V.term_statistics(t.documents, "doc_id"), 5)
    given = F.array_join(E.keyword_list(F.concat("lang", F.lit(" ；, "), "source", F.lit(";"), "lang")), "|")
    return best.unionByName(t.documents.select("doc_id", given.alias("term"), F.lit(0.0).alias("score"), F.lit(0).alias("rank")))


@query("e6_questions", f"""
select conv_id, turn, len(l) as n, md5(array_to_string(l, '|')) as questions, len({sql_tokens("array_to_string(l, ' ')")}) as tokens
from (select conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(s, E' \\t\\n\\r')), lambda s: s <> '') as l from conversations)""")
def e6(t):
    rows = t.conversations.select("conv_id", "turn", E.question_list(F.col("text")).alias("l"))
    return rows.select(
        "conv_id", "turn", F.size("l").cast("long").alias("n"), F.md5(F.array_join("l", "|")).alias("questions"),
        X.token_count(F.array_join("l", " ")).cast("long").alias("tokens"))


@query("e7_index_fields", f"""
select doc_id, array_to_string({sql_tokens('source')}, ' ') as title, lang as important, len({sql_tokens("case when lang = 'fr' then 'a summary' else text end")}) as n_content from documents""")
def e7(t):
    summary = F.when(F.col("lang") == "fr", "a summary").otherwise("")
    fields = E.index_fields(F.concat("source", F.lit(".txt")), F.col("text"), summary, F.array("lang"), F.array().cast("array<string>"))
    rows = t.documents.select("doc_id", *[c.alias(n) for n, c in fields.items()])
    return rows.select(
        "doc_id", F.array_join("title_tks", " ").alias("title"), F.array_join("important_tks", " ").alias("important"), F.size("content_ltks").cast("long").alias("n_content"))


@query("e8_metadata_roll_up", f"""with {LINES_SQL}, u as (select doc_id, kind as value, min(pos) as first from li group by all)
select doc_id, 'kinds' as key, row_number() over (partition by doc_id order by first) as ordinal, value from u
union all select doc_id, 'lang', 1, lang from documents""")
def e8(t):
    chunk_level = doc_lines(t).select("doc_id", F.col("pos").cast("int").alias("pos"), F.lit(0).alias("idx"), F.lit("kinds").alias("key"), F.col("kind").alias("value"), F.lit(True).alias("is_list"))
    stored = t.documents.select("doc_id", F.lit(-1).alias("pos"), F.lit(0).alias("idx"), F.lit("lang").alias("key"), F.col("lang").alias("value"), F.lit(False).alias("is_list"))
    return A.merge_metadata(chunk_level.unionByName(stored))


@query("e9_tag_propagation", f"""with {TAG_SQL}, good as (select item_id, tag, score from r where rank <= 3 and score > 0)
select item_id, tag, score, 'tag' as kind from good union all select item_id, '', 0, 'untagged' from benchmark where item_id not in (select item_id from good)""")
def e9(t):
    priors = A.tag_priors(t.documents, "source", 10)
    tags, rest = E.propagate_tags(t.benchmark, "item_id", t.documents, "doc_id", "source", priors, 0.7, smoothing=10)
    return tags.select("item_id", "tag", "score", F.lit("tag").alias("kind")).unionByName(
        rest.select("item_id", F.lit("").alias("tag"), F.lit(0).cast("long").alias("score"), F.lit("untagged").alias("kind")))


@query("e10_insert_counters", MERGED + f"""o as (select f.doc_id, g, string_agg(s, '' order by pos) as text from f group by all), k as (select o.*, source, md5(o.text || o.doc_id) as id from o join documents d using (doc_id) where trim(o.text, E' \\t\\n\\r\\x0b\\x0c') <> ''),
 once as (select source, doc_id, id, max(len({sql_tokens('text')})) as tokens, sum(0.5) as sec from k group by all)
select source, count(*) as chunk_num, sum(tokens)::bigint as token_num, sum(sec)::double as duration from once group by source""")
def e10(t):
    chunks = C.merge_sections(t.documents, "doc_id", "text", 128, keep=["source"])
    rows = chunks.withColumn("id", X.content_id(F.col("text"), F.col("doc_id"))).withColumn("sec", F.lit(0.5))
    return E.insert_counters(rows, ["source"], "id", "tokens", "sec")
