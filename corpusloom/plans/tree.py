"""Summary trees over whole embedding tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import enrich as E, tree as H
from corpusloom.operators.running import row_numbers
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query


def vectors(t):
    return t.embeddings.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("vector"))


@query("h1_mixture_clusters")
def h1(t):
    return H.mixture_clusters(vectors(t), "vec_id", "vector", max_clusters=5, dims=4)


@query("h2_gap_clusters")
def h2(t):
    return H.gap_clusters(vectors(t), "vec_id", "vector", max_clusters=5)


def _round_sql(i: int) -> str:
    return f"""c{i} as (select label, list(m order by d) as v from (select label, d, avg(x) as m from r{i} join dims using (vec_id) group by all) group by label),
 r{i + 1} as (select vec_id, arg_min(label, struct_pack(s := dist, l := label)) as label from (select vec_id, c{i}.label, list_sum(list_transform(range(1, 65), lambda k: (vec[k] - v[k]) ** 2)) as dist from ev cross join c{i}) group by vec_id)"""


@query("h3_centroid_refinement", f"""with ev as (select vec_id, list_transform(embedding, lambda x: x::double) as vec from embeddings), dims as (select vec_id, unnest(vec) as x, generate_subscripts(vec, 1) as d from ev),
 r0 as (select vec_id, label from embeddings), {', '.join(_round_sql(i) for i in range(5))}
select vec_id, (dense_rank() over (order by label) - 1)::int as cluster from r5""")
def h3(t):
    return H.refine_labels(vectors(t), "vec_id", "vector", "label")


def small_buckets(t):
    """Vectors of one label in runs of 32."""
    numbered = row_numbers(vectors(t), "label", ["vec_id"], "__r")
    return numbered.select("vec_id", "vector", F.concat_ws("-", "label", F.floor((F.col("__r") - 1) / 32)).alias("bucket"))


@query("h4_ranked_pairs", """with b as (select vec_id, list_transform(embedding, lambda x: x::double) as v, label || '-' || ((row_number() over (partition by label order by vec_id) - 1) // 32) as bucket from embeddings),
 p as (select x.bucket, x.vec_id as a, y.vec_id as b, round(list_cosine_similarity(x.v, y.v), 6) as similarity from b x join b y on x.bucket = y.bucket and x.vec_id > y.vec_id)
select bucket, a, b, similarity, row_number() over (partition by bucket order by similarity desc, a, b) as rank from p""")
def h4(t):
    return H.ranked_pairs(small_buckets(t), "bucket", "vec_id", "vector")


@query("h5_bounded_buckets")
def h5(t):
    """Bucket sizes are checked in the tests."""
    return H.bounded_buckets(vectors(t), "vec_id", "vector", 64).select("vec_id", "bucket")


@query("h6_merge_tree")
def h6(t):
    return H.merge_tree(vectors(t), "vec_id", "vector", 64).select("node", "parent", "level", "leaf")


@query("h7_fan_out_rebalance", """
with r0 as (select cast(c_nationkey as varchar) as parent, cast(c_custkey as varchar) as child, row_number() over (partition by c_nationkey order by c_custkey) as pos from customer),
 s0 as (select *, count(*) over (partition by parent) as n, (pos - 1) // 8 as b from r0), a0 as (select *, n > 8 and b = (n - 1) // 8 and n % 8 = 1 as alone from s0),
 r1 as (select distinct parent, parent || '/0/' || b as child, b + 1 as pos from a0 where n > 8 and not alone union all select parent, child, b + 1 from a0 where n > 8 and alone),
 s1 as (select *, count(*) over (partition by parent) as n, (pos - 1) // 8 as b from r1), a1 as (select *, n > 8 and b = (n - 1) // 8 and n % 8 = 1 as alone from s1),
 r2 as (select distinct parent, parent || '/1/' || b as child, b + 1 as pos from a1 where n > 8 and not alone union all select parent, child, b + 1 from a1 where n > 8 and alone),
 s2 as (select *, count(*) over (partition by parent) as n, (pos - 1) // 8 as b from r2), a2 as (select *, n > 8 and b = (n - 1) // 8 and n % 8 = 1 as alone from s2),
 r3 as (select distinct parent, parent || '/2/' || b as child, b + 1 as pos from a2 where n > 8 and not alone union all select parent, child, b + 1 from a2 where n > 8 and alone)
select parent, child, pos from a0 where n <= 8 union all select parent || '/0/' || b, child, pos - b * 8 from a0 where n > 8 and not alone
union all select parent, child, pos from a1 where n <= 8 union all select parent || '/1/' || b, child, pos - b * 8 from a1 where n > 8 and not alone
union all select parent, child, pos from a2 where n <= 8 union all select parent || '/2/' || b, child, pos - b * 8 from a2 where n > 8 and not alone union all select parent, child, pos from r3""")
def h7(t):
    return H.rebalance(t.customer, "c_nationkey", "c_custkey", "c_custkey", 8)


@query("h8_prototypes", """
with l as (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from embeddings), a as (select 'L' || label as node, label, d, avg(x) as x from l group by all),
 m as (select 'M' || (label % 3) as node, d, avg(x) as x from a group by all), r as (select 'R' as node, d, avg(x) as x from m group by all)
select node, d::int - 1 as dim, round(x, 6) as value from a union all select node, d::int - 1, round(x, 6) from m union all select node, d::int - 1, round(x, 6) from r""")
def h8(t):
    label = F.col("label")
    leaves = vectors(t).select(F.concat(F.lit("v"), "vec_id").alias("node"), "vector", F.concat(F.lit("L"), "label").alias("parent"))
    labels = t.embeddings.select("label").distinct()
    tree = leaves.select("node", "parent", F.lit(0).alias("height")).unionByName(
        labels.select(F.concat(F.lit("L"), label).alias("node"), F.concat(F.lit("M"), label % 3).alias("parent"), F.lit(1).alias("height"))).unionByName(
        labels.select(F.concat(F.lit("M"), label % 3).alias("node"), F.lit("R").alias("parent"), F.lit(2).alias("height")).distinct()).unionByName(
        labels.select(F.lit("R").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(3).alias("height")).distinct())
    known = H.prototypes(tree, leaves)
    return known.filter(~F.startswith("node", F.lit("v"))).select("node", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 6))


@query("h9_summary_layers")
def h9(t):
    rows = vectors(t).join(t.documents.select(F.col("doc_id").alias("vec_id"), "text"), "vec_id")
    layers = H.summary_layers(rows, "vec_id", "vector", "text", lambda df: H.gap_clusters(df, "id", "vector", 4))
    return layers.select("layer", "id", "text", "vector")


@query("h10_cluster_summary", rf"""with w as (select source, doc_id, regexp_replace(text, '[ \t\r\n]+', ' ', 'g') as body from documents),
 p as (select source, doc_id, unnest(l) as sentence, generate_subscripts(l, 1) - 1 as spos from (select source, doc_id, string_split(regexp_replace(body, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) as l from w)),
 q as (select * from p where trim(sentence, E' \t\n\r\x0b\x0c') <> ''), tm as (select source, doc_id, spos, unnest(list_distinct({sql_tokens('sentence')})) as term from q), df as (select source, term, count(*) as df from tm group by all),
 sc as (select source, doc_id, spos, round(avg(ln(1 + df)), 6) as score from tm join df using (source, term) group by all)
select source, doc_id, spos, score, row_number() over (partition by source order by score desc, doc_id, spos) as rank, md5(sentence) as sentence from sc join q using (source, doc_id, spos)
qualify row_number() over (partition by source order by score desc, doc_id, spos) <= 3""")
def h10(t):
    out = E.cluster_summary(t.documents, "source", "doc_id", "text")
    return out.select("source", "doc_id", F.col("spos").cast("long").alias("spos"), "score", "rank", F.md5("sentence").alias("sentence"))


@query("h11_skip_and_resume", """
with d as (select doc_id, case lang when 'en' then 'txt' when 'fr' then '.PDF' when 'de' then 'xlsx' else 'csv' end as type, source, n_chars from documents),
 k as (select doc_id, case when n_chars < 300 then false when type in ('xlsx', 'csv') then true when type = '.PDF' and source in ('src1', 'src2') then true else false end as skip from d)
select doc_id, 'todo' as kind from k where not skip and doc_id not in (select doc_id from labels where quality = 1) union all select doc_id, 'clean' from labels where quality = 0""")
def h11(t):
    lang, source = F.col("lang"), F.col("source")
    kind = F.when(lang == "en", "txt").when(lang == "fr", ".PDF").when(lang == "de", "xlsx").otherwise("csv")
    parser = F.when(source == "src1", "Table").otherwise("naive")
    skip = H.skips_summaries(kind, parser, source == "src2", F.when(F.col("n_chars") < 300, F.lit(False)))
    wanted = t.documents.filter(~skip).select("doc_id")
    stored = t.labels.select("doc_id", F.when(F.col("quality") == 1, "tree").otherwise("other").alias("method"))
    todo, clean = H.pending_summaries(wanted, stored, "tree")
    return todo.select("doc_id", F.lit("todo").alias("kind")).unionByName(clean.select("doc_id", F.lit("clean").alias("kind")))
