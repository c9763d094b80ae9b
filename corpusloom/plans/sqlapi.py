"""SQL surface over whole tables (Q1-Q9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import sqlapi as Q
from corpusloom.plans.chunking import MERGED
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query


def session(t, *tables, **kwargs):
    s = Q.SqlSession(t.spark, **kwargs)
    for name in tables:
        s.view(f"q_{name}", getattr(t, name))
    return s


_CUBE = """select {nation}.n_name as nation, {orders}.o_orderstatus as status, count(*) as n, round(sum({orders}.o_totalprice), 2) as total
 from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey group by rollup ({nation}.n_name, {orders}.o_orderstatus)"""


@query("q1_sql_views", _CUBE.format(orders="orders", customer="customer", nation="nation"))
def q1(t):
    return session(t, "orders", "customer", "nation").run(_CUBE.format(orders="q_orders", customer="q_customer", nation="q_nation"))


@query("q2_json_sql", """
select o_orderkey, o_orderpriority as priority, cast(o_totalprice as double) as price, o_orderstatus = 'P' as no_status from orders where o_totalprice > 100000""")
def q2(t):
    s = Q.SqlSession(t.spark)
    s.functions()
    body = F.to_json(F.struct(
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")))
    s.view("q_order_rows", t.orders.select("o_orderkey", body.alias("chunk_data")))
    return s.run("""
        select o_orderkey, json_extract_string(chunk_data, '$.priority') as priority, cast(json_extract_string(chunk_data, '$.price') as double) as price,
               json_extract_isnull(chunk_data, '$.status') as no_status
        from q_order_rows where cast(json_extract_string(chunk_data, '$.price') as double) > 100000;""")


@query("q3_statement_guard", """(select o_orderkey as key, 'capped' as kind from orders order by o_orderkey limit 100) union all (select r_regionkey, 'all' from region)""")
def q3(t):
    s = session(t, "orders", "region", row_limit=100)
    frames = s.run_all("select o_orderkey as key, 'capped' as kind from q_orders order by o_orderkey; delete from q_orders; select cast(r_regionkey as bigint) as key, 'all' as kind from q_region;")
    return frames[0].unionByName(frames[1])


@query("q4_scope_filter", "select source, lang, count(*) as n from documents where source in ('src1', 'src2') group by all")
def q4(t):
    s = Q.SqlSession(t.spark)
    s.view("q_scoped", t.documents, scope=F.col("source").isin("src1", "src2"))
    return s.run("select source, lang, count(*) as n from q_scoped where 1 = 1 or source = 'src3' group by source, lang")


@query("q5_alias_views", "select p_brand as brand, count(*) as parts, max(p_retailprice) as price from part group by 1")
def q5(t):
    s = Q.SqlSession(t.spark)
    s.view("q_catalog", t.part, names={"brand": "p_brand", "name": "p_name", "cost": "p_retailprice"})
    return s.run("select brand, count(name) as parts, max(cost) as price from q_catalog group by brand")


@query("q6_text_match", f"""
with q as (select list_distinct({sql_tokens("'the of and erthing zzz'")}) as w), d as (select doc_id, list_distinct({sql_tokens('text')}) as t from documents)
select doc_id, round(len(list_intersect(t, w)) / len(w), 6) as share from d, q where len(list_intersect(t, w)) / len(w) >= 0.3""")
def q6(t):
    s = Q.SqlSession(t.spark)
    s.functions()
    s.view("q_tokens", t.documents.select("doc_id", X.tokens(F.col("text")).alias("content_ltks")))
    return s.run("select doc_id, round(match_share(content_ltks, :q), 6) as share from q_tokens where match_share(content_ltks, :q) >= 0.3", {"q": "the of and erthing zzz"})


@query("q7_source_rows", """(select cast(c_custkey as varchar) as key, c_name as name from (select distinct c_custkey, c_name from customer join orders on c_custkey = o_custkey where o_totalprice > 400000))
union all select 'total', cast(count(*) as varchar) from orders where o_totalprice > 400000""")
def q7(t):
    filtered = t.orders.filter("o_totalprice > 400000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = Q.source_rows(filtered, "c_custkey", "c_name").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"))
    return rows.unionByName(filtered.agg(F.count("*").cast("string").alias("name")).select(F.lit("total").alias("key"), "name"))


@query("q8_display_cleaning", """
select o_orderkey, o_totalprice as price, case when o_orderstatus = 'O' then o_totalprice end as ratio, strftime(o_orderdate, '%Y-%m-%d') as day from orders""")
def q8(t):
    status = F.col("o_orderstatus")
    ratio = F.when(status == "F", float("nan")).when(status == "P", float("-inf")).otherwise(F.col("o_totalprice"))
    return Q.display(t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(20,2)").alias("price"), ratio.alias("ratio"), F.col("o_orderdate").alias("day")))


@query("q9_strategy_registry", MERGED + f"""o as (select f.doc_id, g, string_agg(s, '' order by pos) as text from f group by all), k as (select o.* from o join documents d using (doc_id) where d.lang <> 'en' and trim(o.text, E' \\t\\n\\r\\x0b\\x0c') <> ''),
 every as (select doc_id, row_number() over (partition by doc_id order by g) - 1 as pos, text, 'naive' as strategy from k union all select doc_id, 0, text, 'one' from documents where lang = 'en' and trim(text, E' \\t\\n\\r') <> '')
select doc_id, pos, md5(text) as text, strategy, len({sql_tokens('text')}) as tokens from every""")
def q9(t):
    rows = t.documents.withColumn("parser", F.when(F.col("lang") == "en", "one").otherwise("naive"))
    chunks = Q.chunk_by_strategy(rows, "doc_id", "text", "parser", {"naive": {"budget": 128}, "one": {}})
    return chunks.select("doc_id", F.col("pos").cast("long").alias("pos"), F.md5("text").alias("text"), "strategy", F.col("tokens").cast("long").alias("tokens"))
