"""Knowledge graph over whole tables.

Graph: parts and suppliers, an edge per pair that occurs together on order lines, weighted by the number of lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import chunking as C, graph as G, ranking as K, vector_search as S
from corpusloom.plans.ranking import LINES_SQL
from corpusloom.plans.text import sql_tokens
from corpusloom.registry import query

EDGES_SQL = "ed as (select 'P' || l_partkey as src, 'S' || l_suppkey as dst, count(*)::double as weight from lineitem group by all)"
BOTH_SQL = "lk as (select src, dst, weight from {0} union all select dst, src, weight from {0})"
# The second graph: customers and suppliers in nations, nations in regions, weighted by their orders and order lines.
PLACES_SQL = """pl as (select 'C' || c_custkey as src, 'N' || c_nationkey as dst, 1.0::double + coalesce(n, 0) as weight from customer left join (select o_custkey, count(*) as n from orders group by 1) on o_custkey = c_custkey
 union all select 'S' || s_suppkey, 'N' || s_nationkey, 1.0::double + coalesce(n, 0) from supplier left join (select l_suppkey, count(*) as n from lineitem group by 1) on l_suppkey = s_suppkey
 union all select 'N' || n_nationkey, 'R' || n_regionkey, 1.0::double from nation)"""


def line_edges(t):
    return t.lineitem.select(F.concat(F.lit("P"), "l_partkey").alias("src"), F.concat(F.lit("S"), "l_suppkey").alias("dst"), "l_orderkey", "l_returnflag", "l_linestatus")


def edges(t):
    return line_edges(t).groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def places(t):
    name = lambda letter, key: F.concat(F.lit(letter), key)
    orders, lines = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")), t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    weight = (F.coalesce("n", F.lit(0)) + 1).cast("double").alias("weight")
    customers = t.customer.join(orders, F.col("o_custkey") == F.col("c_custkey"), "left").select(name("C", "c_custkey").alias("src"), name("N", "c_nationkey").alias("dst"), weight)
    suppliers = t.supplier.join(lines, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(name("S", "s_suppkey").alias("src"), name("N", "s_nationkey").alias("dst"), weight)
    nations = t.nation.select(name("N", "n_nationkey").alias("src"), name("R", "n_regionkey").alias("dst"), F.lit(1.0).alias("weight"))
    return customers.unionByName(suppliers).unionByName(nations)


def graph_nodes(t):
    part = t.part.select(F.concat(F.lit("P"), "p_partkey").alias("name"), F.lit("PART").alias("type"), F.col("p_name").alias("description"), F.col("p_brand").alias("source"))
    supplier = t.supplier.select(F.concat(F.lit("S"), "s_suppkey").alias("name"), F.lit("SUPPLIER").alias("type"), F.col("s_name").alias("description"), F.lit("s").alias("source"))
    return part.unionByName(supplier)


NODES_SQL = """nd as (select 'P' || p_partkey as name, 'PART' as type, p_name as description, p_brand as source from part union all select 'S' || s_suppkey, 'SUPPLIER', s_name, 's' from supplier)"""


@query("n1_record_parse", """
select 'entity' as kind, upper(p_name) as a, 'PART' as b, 1.0::double as weight, p_type as description, p_partkey as source from part where p_size <= 40
union all select 'relation', least(upper(p_name), p_brand_u), greatest(upper(p_name), p_brand_u), case when p_size > 25 then p_size else 1 end, 'made by', p_partkey from (select *, upper(p_brand) as p_brand_u from part)""")
def n1(t):
    """Delimited records rendered from the parts: an entity of a wanted or unwanted type, a relation, and noise."""
    d = F.lit("<|>")
    kind = F.when(F.col("p_size") <= 40, "part").otherwise("colour")
    entity = F.concat(F.lit('"entity"'), d, "p_name", d, kind, d, "p_type")
    relation = F.concat(F.lit('"relationship"'), d, "p_name", d, "p_brand", d, F.lit("made by"), d, F.lit("brand"), F.when(F.col("p_size") > 25, F.concat(d, "p_size")).otherwise(""))
    rows = t.part.select("p_partkey", F.explode(F.array(entity, relation, F.lit('"entity"<|>short'), F.lit('"entity"<|>"<|>part<|>x'))).alias("record"))
    entities, relations = G.parse_records(rows, "p_partkey", "record", "<|>", ["Part"])
    a = entities.select(F.lit("entity").alias("kind"), F.col("name").alias("a"), F.col("type").alias("b"), F.lit(1.0).alias("weight"), "description", "source")
    return a.unionByName(relations.select(F.lit("relation").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "weight", "description", "source"))


_RUN = r"\p{Lu}[\p{L}\p{N}-]*(?: (?:(?:of|in|on|at|for|and|or|the|a|an|to) )*\p{Lu}[\p{L}\p{N}-]*)*"
MENTIONS_SQL = rf"""{LINES_SQL}, ch as (select doc_id || '-' || pos as chunk, line from li),
 sn as (select chunk, unnest(l) as s, generate_subscripts(l, 1) - 1 as sent from (select chunk, regexp_split_to_array(line, '[.!?。！？\n]') as l from ch)),
 rn as (select chunk, sent, unnest(regexp_extract_all(s, '{_RUN}')) as run from sn),
 mn as (select distinct chunk, sent, replace(upper(name), 'ẞ', 'SS') as name from (select chunk, sent, unnest([run] || regexp_split_to_array(run, ' (?:and|or) (?:the |a |an )?')) as name from rn))"""


def line_chunks(t):
    lines = C.lines_of(t.documents, "doc_id", "text").filter(~X.is_blank(F.col("line")))
    return lines.select(F.concat_ws("-", "doc_id", "pos").alias("chunk"), "line")


def line_mentions(t):
    return G.mentions(line_chunks(t), "chunk", "line")


@query("n2_entity_mentions", f"with {MENTIONS_SQL} select chunk, sent, name from mn")
def n2(t):
    return line_mentions(t).select("chunk", F.col("sent").cast("long").alias("sent"), "name")


@query("n3_sentence_cooccurrence", f"""with {MENTIONS_SQL},
 pr as (select distinct a.chunk, a.name as src, b.name as dst from mn a join mn b on a.chunk = b.chunk and abs(a.sent - b.sent) <= 1 and a.name < b.name)
select chunk, md5(src || '|' || dst) as pair, 2.0::double as weight from pr""")
def n3(t):
    pairs = G.cooccurrences(line_mentions(t), "chunk", 1, 2.0)
    return pairs.select("chunk", F.md5(F.concat_ws("|", "src", "dst")).alias("pair"), "weight")


@query("n3_cooccurrence_shares", f"""with {MENTIONS_SQL},
 mm as (select * from mn), up as (select chunk, replace(upper(line), 'ẞ', 'SS') as u from ch),
 ct as (select chunk, name, (length(u) - length(replace(u, name, ''))) / length(name) as c from (select distinct chunk, name from mm) join up using (chunk)),
 sh as (select *, c / sum(c) over (partition by chunk) as tf from ct),
 pr as (select distinct a.chunk, a.name as src, b.name as dst from mm a join mm b on a.chunk = b.chunk and a.sent = b.sent and a.name < b.name)
select pr.chunk, md5(src || '|' || dst) as pair, round(greatest(x.tf + y.tf, 0.01), 6) as weight from pr join sh x on x.chunk = pr.chunk and x.name = src join sh y on y.chunk = pr.chunk and y.name = dst""")
def n3_shares(t):
    pairs = G.cooccurrences(line_mentions(t), "chunk", 0, None, line_chunks(t), "line")
    return pairs.select("chunk", F.md5(F.concat_ws("|", "src", "dst")).alias("pair"), F.round("weight", 6).alias("weight"))


@query("g23_entity_merge", """
with f as (select 'B' || p_brand as name, p_type as type, p_name as description, p_partkey as source from part),
 tp as (select name, type, count(*) as n from f group by all), best as (select * from tp qualify row_number() over (partition by name order by n desc, type) = 1),
 d as (select distinct name, description from f)
select b.name, b.type, (select count(distinct source) from f where f.name = b.name) as sources, row_number() over (partition by d.name order by description) as ordinal, description from best b join d on d.name = b.name""")
def g23(t):
    found = t.part.select(F.concat(F.lit("B"), "p_brand").alias("name"), F.col("p_type").alias("type"), F.col("p_name").alias("description"), F.col("p_partkey").alias("source"))
    nodes, parts = G.merge_entities(found)
    return nodes.join(parts, "name").select("name", "type", "sources", "ordinal", "description")


RELATIONS_SQL = "rl as (select 'S' || l_suppkey as a, 'P' || l_partkey as b, l_quantity as weight, l_returnflag || l_linestatus as description, l_linestatus as keyword, l_orderkey as source from lineitem)"


def relation_mentions(t):
    return t.lineitem.select(
        F.concat(F.lit("S"), "l_suppkey").alias("src"), F.concat(F.lit("P"), "l_partkey").alias("dst"), F.col("l_quantity").alias("weight"),
        F.concat("l_returnflag", "l_linestatus").alias("description"), F.col("l_linestatus").alias("keyword"), F.col("l_orderkey").alias("source"))


@query("g24_relation_merge", f"""with {RELATIONS_SQL}, e as (select least(a, b) as src, greatest(a, b) as dst, sum(weight) as weight, count(distinct keyword) as keywords, count(distinct source) as sources from rl group by all),
 d as (select distinct least(a, b) as src, greatest(a, b) as dst, description from rl)
select src, dst, weight, keywords, sources, row_number() over (partition by src, dst order by description) as ordinal, description from e join d using (src, dst)""")
def g24(t):
    merged, parts = G.merge_relations(relation_mentions(t))
    return merged.join(parts, ["src", "dst"])


def halves(t):
    """Two graphs: lines of finished orders and of all others."""
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    count = lambda df: df.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    return count(line_edges(t).join(done, "l_orderkey", "left_semi")), count(line_edges(t).join(done, "l_orderkey", "left_anti"))


HALVES_SQL = """ln2 as (select 'P' || l_partkey as src, 'S' || l_suppkey as dst, l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F') as fin from lineitem),
 h1 as (select src, dst, count(*)::double as weight from ln2 where fin group by all), h2 as (select src, dst, count(*)::double as weight from ln2 where not fin group by all)"""


@query("n4_graph_merge", f"with {EDGES_SQL} select src, dst, weight from ed")
def n4(t):
    return G.merge_edges(*halves(t))


@query("n5_tidy_graph", f"""with {NODES_SQL}, {EDGES_SQL}, good as (select name from nd where not (type = 'PART' and source = 'Brand#1'))
select name as a, '' as b, 'node' as kind, 0 as n from good union all
select src, dst, 'edge', case when weight > 1 then 1 else 0 end from ed where weight <> 2 and src in (select name from good) and dst in (select name from good)""")
def n5(t):
    nodes = graph_nodes(t).withColumn("source", F.when((F.col("type") == "PART") & (F.col("source") == "Brand#1"), None).otherwise(F.col("source")))
    rows = edges(t).select(
        "src", "dst", F.when(F.col("weight") != 2, "d").alias("description"), F.lit("s").alias("source"), F.when(F.col("weight") > 1, F.array(F.lit("k"))).alias("keywords"))
    good, kept = G.tidy(nodes, rows)
    return good.select(F.col("name").alias("a"), F.lit("").alias("b"), F.lit("node").alias("kind"), F.lit(0).alias("n")).unionByName(
        kept.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit("edge").alias("kind"), F.size("keywords").alias("n")))


@query("j15_edge_validation", f"""with {EDGES_SQL}, nn as (select 'P' || p_partkey as name from part where p_size > 20 union all select 'S' || s_suppkey from supplier where s_acctbal > 0)
select src, dst from ed where src in (select name from nn) and dst in (select name from nn)""")
def j15(t):
    parts = t.part.filter("p_size > 20").select(F.concat(F.lit("P"), "p_partkey").alias("name"))
    suppliers = t.supplier.filter("s_acctbal > 0").select(F.concat(F.lit("S"), "s_suppkey").alias("name"))
    return G.valid_edges(edges(t), parts.unionByName(suppliers)).select("src", "dst")


@query("n6_degree", f"with {EDGES_SQL}, {BOTH_SQL.format('ed')} select src as name, count(*) as rank from lk group by src")
def n6(t):
    return G.degrees(edges(t))


def pagerank_sql(edge_table: str, iterations: int) -> str:
    parts = [f"{BOTH_SQL.format(edge_table)}, ws as (select src, dst, weight / sum(weight) over (partition by src) as share from lk)",
             "al as (select name, name not in (select src from ws) as alone from nd)", "p0 as (select name, alone, 1.0::double / (select count(*) from al) as r from al)"]
    for i in range(iterations):
        parts.append(f"""p{i + 1} as (select a.name, a.alone, 0.85 * (coalesce(f.s, 0) + (select coalesce(sum(r), 0) from p{i} where alone) / (select count(*) from al)) + 0.15 / (select count(*) from al) as r
   from al a left join (select dst, sum(r * share) as s from p{i} join ws on src = name group by dst) f on f.dst = a.name)""")
    return ", ".join(parts)


@query("n7_pagerank", f"with {EDGES_SQL}, {NODES_SQL}, {pagerank_sql('ed', 8)} select name, round(r, 10) as pagerank from p8")
def n7(t):
    return G.pagerank(graph_nodes(t), edges(t), 8).select("name", F.round("pagerank", 10).alias("pagerank"))


NAMES_SQL = """nm as (select distinct p_brand as block, n from (select p_brand, p_name as n from part union all select p_brand, p_name || ' ' || p_size % 4 from part)),
 cand as (select x.block, x.n as a, y.n as b from nm x join nm y on x.block = y.block and x.n < y.n),
 gr as (select n, list_sort(list_distinct(list_filter(list_transform(range(1, length(n)), lambda i: substr(n, cast(i as int), 2)), lambda g: regexp_matches(g, '[0-9]')))) as dg,
   length(regexp_replace(n, '[^`a-zA-Z0-9.,'':;/"?<>!()\\-]', '', 'g')) / length(n) > 0.8 as eng, list_distinct(string_split(n, '')) as cs from (select distinct n from nm)),
 pairs as (select block, a, b from cand join gr x on x.n = a join gr y on y.n = b where x.dg = y.dg and case when x.eng and y.eng then levenshtein(a, b) <= least(length(a), length(b)) // 2
   when greatest(len(x.cs), len(y.cs)) < 4 then len(list_intersect(x.cs, y.cs)) > 1 else len(list_intersect(x.cs, y.cs)) / greatest(len(x.cs), len(y.cs)) >= 0.8 end)"""


def part_names(t):
    """Part names, plain and with a number, per brand; names of large parts are new."""
    size = F.col("p_size")
    names = F.explode(F.array("p_name", F.concat_ws(" ", "p_name", size % 4)))
    return t.part.select(F.col("p_brand").alias("brand"), names.alias("name"), (size > 25).alias("new"))


@query("j10_blocked_similarity_join", f"""with {NAMES_SQL}, fr as (select p_brand as block, unnest([p_name, p_name || ' ' || p_size % 4]) as n, p_size > 25 as new from part),
 fx as (select block, n, bool_or(new) as new from fr group by all)
select pairs.block, a, b from pairs join fx x on x.block = pairs.block and x.n = a join fx y on y.block = pairs.block and y.n = b where x.new or y.new""")
def j10(t):
    return G.similar_names(part_names(t), "name", "brand", "new")


@query("n8_duplicate_candidates", f"with {NAMES_SQL} select block, a, b from pairs")
def n8(t):
    return G.similar_names(part_names(t), "name", "brand")


def components_sql(rounds: int) -> str:
    """The least name within so many steps of each node; the graph's longest shortest path is shorter."""
    parts = ["l0 as materialized (select distinct src as name, src as c from lk)"]
    for i in range(rounds):
        parts.append(f"l{i + 1} as materialized (select l.name, least(l.c, min(m.c)) as c from l{i} l join lk on lk.src = l.name join l{i} m on m.name = lk.dst group by l.name, l.c)")
    return ", ".join(parts) + f", cc as (select name, c as component from l{rounds})"


WHOLE_CC = f"{EDGES_SQL}, {BOTH_SQL.format('ed')}, {components_sql(8)}"


@query("n9_connected_components", f"with {WHOLE_CC} select name, component from cc")
def n9(t):
    return G.components(edges(t))


MERGE_SQL = """gp as (select 'P' || p_partkey as name, 'P' || min(p_partkey) over (partition by p_name, p_brand) as component from part)"""


def merge_groups(t):
    """Parts of the same name and brand are one entity."""
    least = t.part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("m"))
    return t.part.join(least, ["p_name", "p_brand"]).select(F.concat(F.lit("P"), "p_partkey").alias("name"), F.concat(F.lit("P"), "m").alias("component"))


CONTRACTED_SQL = f"""{NODES_SQL}, {EDGES_SQL}, {MERGE_SQL}, cn as (select coalesce(component, nd.name) as name, count(*) as merged from nd left join gp using (name) group by 1),
 ce as (select coalesce(component, src) as src, dst, sum(weight) as weight from ed left join gp on gp.name = src group by 1, 2)"""


@query("n10_node_contraction", f"with {CONTRACTED_SQL} select name as a, '' as b, merged::double as value from cn union all select src, dst, weight from ce")
def n10(t):
    nodes, merged = G.contract(graph_nodes(t), edges(t), merge_groups(t))
    return nodes.select(F.col("name").alias("a"), F.lit("").alias("b"), F.col("merged").cast("double").alias("value")).unionByName(
        merged.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("value")))


@query("n11_change_set", f"""with {CONTRACTED_SQL}, j as (select coalesce(ed.src, ce.src) as src, coalesce(ed.dst, ce.dst) as dst, ed.weight as x, ce.weight as y from ed full join ce on ed.src = ce.src and ed.dst = ce.dst)
select src, dst, case when x is null then 'added' when y is null then 'removed' else 'updated' end as change from j where x is distinct from y""")
def n11(t):
    _, merged = G.contract(graph_nodes(t), edges(t), merge_groups(t))
    return G.change_set(edges(t), merged, ["src", "dst"], "weight")


@query("n12_largest_component", f"""with {WHOLE_CC}, big as (select component from cc group by 1 order by count(*) desc, component limit 1)
select src, dst, weight from ed where src in (select name from cc where component = (select component from big))""")
def n12(t):
    quoted = edges(t).select(F.concat(F.lit(" "), F.lower("src")).alias("src"), F.lower("dst").alias("dst"), "weight")
    return G.largest_component(quoted)


@query("n13_hierarchical_communities")
def n13(t):
    """Community sizes and modularity are checked in the tests against label propagation."""
    return G.hierarchical_communities(edges(t))


COMM_SQL = """cm as (select 0 as level, p_brand as community, 'P' || p_partkey as name from part union all select 1, p_brand || '/' || p_type, 'P' || p_partkey from part
 union all select 0, 'N' || s_nationkey, 'S' || s_suppkey from supplier union all select 1, 'Brand#1/' || s_nationkey, 'S' || s_suppkey from supplier)"""


def members(t):
    """Two levels of communities: brands and nations, then brands and types."""
    name = F.concat(F.lit("P"), "p_partkey")
    supplier = F.concat(F.lit("S"), "s_suppkey")
    row = lambda df, level, community, n: df.select(F.lit(level).alias("level"), community.alias("community"), n.alias("name"))
    frames = [
        row(t.part, 0, F.col("p_brand"), name), row(t.part, 1, F.concat_ws("/", "p_brand", "p_type"), name),
        row(t.supplier, 0, F.concat(F.lit("N"), "s_nationkey"), supplier), row(t.supplier, 1, F.concat(F.lit("Brand#1/"), "s_nationkey"), supplier)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


WEIGHT_SQL = f"""{EDGES_SQL}, {BOTH_SQL.format('ed')}, {COMM_SQL}, dg as (select src as name, count(*) as rank from lk group by src),
 cs as (select level, community, sum(coalesce(rank, 0))::double as s from cm left join dg using (name) group by all), cw as (select level, community, s / max(s) over (partition by level) as weight from cs)"""


@query("n14_community_weight", f"with {WEIGHT_SQL} select level, community, round(weight, 9) as weight from cw")
def n14(t):
    return G.community_weights(members(t), G.degrees(edges(t))).withColumn("weight", F.round("weight", 9))


@query("n15_community_tables", f"""with {EDGES_SQL}, {COMM_SQL}, sz as (select level, community from cm group by all having count(*) >= 2), km as (select cm.* from cm join sz using (level, community)),
 ie as (select a.level, a.community, src, dst, row_number() over (partition by a.level, a.community order by src, dst) as line from ed join km a on a.name = src join km b on b.name = dst and b.level = a.level and b.community = a.community)
select level, community, name as a, '' as b, 0 as line from km union all select level, community, src, dst, line from ie """)
def n15(t):
    kept, inside = G.community_tables(members(t), edges(t))
    return kept.select("level", "community", F.col("name").alias("a"), F.lit("").alias("b"), F.lit(0).cast("long").alias("line")).unionByName(
        inside.select("level", "community", F.col("src").alias("a"), F.col("dst").alias("b"), "line"))


@query("n16_membership_titles", f"with {COMM_SQL} select distinct name, 'T ' || split_part(community, '/', 1) as title from cm")
def n16(t):
    titles = members(t).select("level", "community").distinct().withColumn("title", F.concat(F.lit("T "), F.split_part("community", F.lit("/"), F.lit(1))))
    return G.membership_titles(members(t), titles)


SOURCES_SQL = """es as (select 'P' || l_partkey as src, 'S' || l_suppkey as dst, o_custkey % 20 as source from lineitem join orders on l_orderkey = o_orderkey),
 ns as (select distinct source, src as name from es union select distinct source, dst from es where source <> 3)"""


def edge_sources(t):
    """Edges with their source: one of twenty customer groups."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 20).alias("source"))
    return line_edges(t).join(orders, "l_orderkey").select("src", "dst", "source")


@query("n17_source_subgraph", f"with {SOURCES_SQL} select distinct source, src, dst from es where source <> 3 or false")
def n17(t):
    rows = edge_sources(t)
    nodes = rows.select("source", F.col("src").alias("name")).unionByName(rows.filter("source <> 3").select("source", F.col("dst").alias("name")))
    return G.induced_by_source(nodes, rows)[1].select("source", "src", "dst")


@query("n18_rebuild_without_sources", f"with {SOURCES_SQL} select src, dst, count(*)::double as weight from es where source not in (select n_nationkey from nation where n_regionkey = 1) group by all")
def n18(t):
    excluded = t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").cast("long").alias("source"))
    return G.rebuild_without(edge_sources(t).withColumn("weight", F.lit(1.0)), excluded)


def paths_sql(seeds: str, hops: int) -> str:
    """Maximal paths ``pth(seed, path, weights)``; ``g`` holds every path that repeats no edge."""
    return f"""g as (select src as seed, [src, dst] as path, [weight] as weights, 1 as n from lk where src in ({seeds}) union all
  select g.seed, g.path || [lk.dst], g.weights || [lk.weight], n + 1 from g join lk on lk.src = g.path[-1] where n < {hops} and not list_contains(g.path[1:-2], g.path[-1])
   and len(list_filter(range(1, len(g.path)), lambda i: (g.path[i] = lk.src and g.path[i + 1] = lk.dst) or (g.path[i] = lk.dst and g.path[i + 1] = lk.src))) = 0),
 pth as (select seed, path, weights from g where n = {hops} or path not in (select path[1:-2] from g))"""


PATHS = f"{PLACES_SQL}, {BOTH_SQL.format('pl')}, {paths_sql('''select 'N' || n_nationkey from nation''', 3)}"


def nation_nodes(t):
    return t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("name"))


REGION_SEEDS = "select 'R' || r_regionkey from region union all select 'N' || n_nationkey from nation"


@query("j11_path_join", f"with recursive {PLACES_SQL}, {BOTH_SQL.format('pl')}, {paths_sql(REGION_SEEDS, 2)} select seed, array_to_string(path, '>') as path from pth")
def j11(t):
    seeds = t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("name")).unionByName(nation_nodes(t))
    return G.n_hop_paths(places(t), seeds, 2).select("seed", F.array_join("path", ">").alias("path"))


@query("n19_n_hop_neighbourhoods", f"with recursive {PATHS} select seed, array_to_string(path, '>') as path, array_to_string(list_transform(weights, lambda w: cast(w::int as varchar)), '>') as weights from pth")
def n19(t):
    paths = G.n_hop_paths(places(t), nation_nodes(t), 3)
    return paths.select("seed", F.array_join("path", ">").alias("path"), F.array_join(F.transform("weights", lambda w: w.cast("int").cast("string")), ">").alias("weights"))


HITS_SQL = """eh as (select n_regionkey as query_id, 'N' || n_nationkey as name, round((n_nationkey + 1) / 50, 4) as sim from nation),
 ty as (select n_regionkey as query_id, 'N' || n_nationkey as name from nation where n_nationkey % 2 = 0 union all select n_regionkey, 'S' || s_suppkey from supplier join nation on n_nationkey = s_nationkey where s_acctbal > 7000)"""
HOPS_SQL = f"""{PATHS}, {HITS_SQL}, hp as (select query_id, path[i] as src, path[i + 1] as dst, sum(sim / (1 + i)) as sim, max(weights[i]) as pagerank
  from pth join eh on eh.name = pth.seed, lateral (select unnest(range(1, len(path))) as i) group by all)"""


def entity_hits(t):
    return t.nation.select(F.col("n_regionkey").alias("query_id"), F.concat(F.lit("N"), "n_nationkey").alias("name"), F.round((F.col("n_nationkey") + 1) / 50, 4).alias("sim"))


def type_hits(t):
    """Entities of the types each query, a region, asks for: every other nation of it and its rich suppliers."""
    nations = t.nation.filter("n_nationkey % 2 = 0").select(F.col("n_regionkey").alias("query_id"), F.concat(F.lit("N"), "n_nationkey").alias("name"))
    rich = t.supplier.filter("s_acctbal > 7000").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return nations.unionByName(rich.select(F.col("n_regionkey").alias("query_id"), F.concat(F.lit("S"), "s_suppkey").alias("name")))


def hop_scores(t):
    return G.path_scores(G.n_hop_paths(places(t), nation_nodes(t), 3), entity_hits(t))


@query("n20_path_scores", f"with recursive {HOPS_SQL} select query_id, src, dst, round(sim, 6) as sim, pagerank from hp")
def n20(t):
    return hop_scores(t).withColumn("sim", F.round("sim", 6))


@query("n21_graph_search_entities", f"""with recursive {HOPS_SQL}, dg as (select src as name, count(*) as d from lk group by src),
 sc as (select eh.query_id, eh.name, round(sim * case when ty.name is not null then 2 else 1 end * (coalesce(d, 0) + 1.0::double), 9) as score from eh left join (select distinct * from ty) ty using (query_id, name) left join dg on dg.name = eh.name)
select query_id, name, score, row_number() over (partition by query_id order by score desc, name) as rank from sc qualify row_number() over (partition by query_id order by score desc, name) <= 3""")
def n21_entities(t):
    return ranked_entities(t).select("query_id", "name", "score", "rank")


def ranked_entities(t, n=3):
    degree = G.degrees(places(t))
    hits = entity_hits(t).join(degree, "name", "left").withColumn("pagerank", F.coalesce("rank", F.lit(0)) + 1.0).drop("rank")
    return G.rank_entities(hits, type_hits(t), n)


@query("n21_graph_search_relations", f"""with recursive {HOPS_SQL}, rh as (select n_regionkey as query_id, dst as src, src as dst, 0.5::double as sim, weight as pagerank from pl join nation on dst = 'N' || n_nationkey where weight > 1),
 tz as (select distinct * from ty),
 j as (select coalesce(rh.query_id, hp.query_id) as query_id, coalesce(rh.src, hp.src) as src, coalesce(rh.dst, hp.dst) as dst, rh.sim as h, rh.pagerank as hpr, hp.sim as p, hp.pagerank as ppr from rh full join hp on rh.query_id = hp.query_id and rh.src = hp.src and rh.dst = hp.dst),
 k as (select j.*, case when a.name is not null then 1 else 0 end + case when b.name is not null then 1 else 0 end as ends from j left join tz a on a.query_id = j.query_id and a.name = src left join tz b on b.query_id = j.query_id and b.name = dst),
 sc as (select query_id, src, dst, round(case when h is not null then h * (coalesce(p, 0) + ends + 1) else p * (ends + 1) end * coalesce(hpr, ppr), 6) as score from k)
select query_id, src, dst, score, row_number() over (partition by query_id order by score desc, src, dst) as rank from sc qualify row_number() over (partition by query_id order by score desc, src, dst) <= 4""")
def n21_relations(t):
    nation = t.nation.select(F.col("n_regionkey").alias("query_id"), F.concat(F.lit("N"), "n_nationkey").alias("dst"))
    hits = places(t).filter("weight > 1").join(nation, "dst").select("query_id", F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.5).alias("sim"), F.col("weight").alias("pagerank"))
    every = G.rank_relations(hits, hop_scores(t), type_hits(t), 1000).drop("rank").withColumn("score", F.round("score", 6))
    return G.top_k(every, "query_id", [F.col("score").desc(), F.col("src"), F.col("dst")], 4)


@query("n21_token_budget", f"""with recursive {HOPS_SQL}, pt as (select query_id, src, dst, round(sim, 6) as score from hp),
 ln as (select *, len({sql_tokens("src || ' ' || dst")}) as n from pt),
 ru as (select *, sum(n) over (partition by query_id order by score desc, src, dst) as used from ln)
select query_id, src, dst, used::bigint as used from ru where used <= 400""")
def n21_budget(t):
    """The best relations of each query as lines, as many as fit the budget."""
    lines = hop_scores(t).withColumn("score", F.round("sim", 6)).withColumn("n", X.token_count(F.concat_ws(" ", "src", "dst")))
    return K.pack_budget(lines, "query_id", [F.col("score").desc(), F.col("src"), F.col("dst")], "n", 400, "memory").select("query_id", "src", "dst", "used")


@query("n22_entity_by_vector", """
with q as (select vec_id as query_id, embedding as v from embeddings where vec_id % 100 = 0), p as (select query_id, vec_id, label, round(list_cosine_similarity(q.v::double[], e.embedding::double[]), 6) as sim from q cross join embeddings e)
select query_id, 'E' || vec_id as name, sim, row_number() over (partition by query_id order by sim desc, vec_id) as rank from p where sim >= 0.3 qualify row_number() over (partition by query_id order by sim desc, vec_id) <= 56""")
def n22_vector(t):
    vectors = t.embeddings.select("vec_id", F.col("embedding").alias("vector"))
    asked = vectors.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    found = S.nearest(asked, vectors, 56, 0.3, item="vec_id")
    return found.select("query_id", F.concat(F.lit("E"), "vec_id").alias("name"), F.col("similarity").alias("sim"), "rank")


@query("n22_entity_lookup", f"""with {EDGES_SQL}, {BOTH_SQL.format('ed')}, {NODES_SQL}, dg as (select src as name, count(*) as rank from lk group by src)
select name, rank from nd join dg using (name) where type = 'SUPPLIER' order by rank desc, name limit 56""")
def n22(t):
    """By type, best ranks first."""
    wanted = graph_nodes(t).filter(F.col("type").isin("SUPPLIER")).join(G.degrees(edges(t)), "name")
    return wanted.orderBy(F.col("rank").desc(), "name").limit(56).select("name", "rank")


@query("n23_community_lookup", f"""with {WEIGHT_SQL}, {HITS_SQL}, f as (select distinct query_id, level, community from eh join cm using (name)), r as (select f.*, round(weight, 9) as weight from f join cw using (level, community))
select query_id, level, community, weight, row_number() over (partition by query_id order by weight desc, level, community) as rank from r qualify row_number() over (partition by query_id order by weight desc, level, community) <= 2""")
def n23(t):
    weights = G.community_weights(members(t), G.degrees(edges(t)))
    return G.communities_of(entity_hits(t), members(t), weights, 2).withColumn("weight", F.round("weight", 9))


@query("n24_node_embeddings")
def n24(t):
    """Vector sizes and repeatable walks are checked in the tests."""
    return G.node_embeddings(edges(t), 16, walks=2, length=6, iterations=1).select("name", "vector")


@query("n25_tree_merge", f"""
select event_id, 'k' as path, 1 as ordinal, event_type as value from events union all select event_id, 'tags.list', 1, 'first' from events
union all select event_id, 'tags.list', 2, {"cast(user_id as varchar)"} from events union all select event_id, 'only', 1, cast(json_extract(props, '$.k') as varchar) from events""")
def n25(t):
    leaf = lambda path, value, is_list: t.events.select("event_id", F.lit(path).alias("path"), F.lit(0).alias("pos"), value.cast("string").alias("value"), F.lit(is_list).alias("is_list"))
    k = F.get_json_object("props", "$.k")
    a = leaf("k", k, False).unionByName(leaf("tags.list", F.lit("first"), True)).unionByName(leaf("only", k, False))
    b = leaf("k", F.col("event_type"), False).unionByName(leaf("tags.list", F.col("user_id"), True))
    return G.merge_trees(a, b, "event_id")


@query("n26_search_rows", f"""with {NODES_SQL}, {EDGES_SQL}
select name as id, 'entity' as kind, array_to_string({sql_tokens('name')}, ' ') as title, array_to_string({sql_tokens('description')}, ' ') as content from nd
union all select src || '->' || dst, 'relation', lower(src) || ' ' || lower(dst), 'lines ' || weight::int from ed""")
def n26(t):
    rows = G.search_rows(graph_nodes(t), edges(t).withColumn("description", F.concat(F.lit("Lines "), F.col("weight").cast("int"))))
    return rows.select("id", "kind", F.array_join("title_tks", " ").alias("title"), F.array_join("content_ltks", " ").alias("content"))


@query("n27_stale_reports", """
with old as (select distinct md5('community_report::' || p_type || 'kb') as id from part where p_size <= 25 union select md5('community_report::gone' || n_name || 'kb') from nation),
 cur as (select distinct p_type as title, md5('community_report::' || p_type || 'kb') as id from part where p_size > 10)
select id, case when id in (select id from old) then 'replaced' else 'new' end as change from cur union all select id, 'stale' from old where id not in (select id from cur)""")
def n27(t):
    name = lambda c: F.md5(F.concat(F.lit("community_report::"), c, F.lit("kb")))
    stored = t.part.filter("p_size <= 25").select(name(F.col("p_type")).alias("id")).unionByName(t.nation.select(name(F.concat(F.lit("gone"), "n_name")).alias("id"))).distinct()
    reports = t.part.filter("p_size > 10").select(F.col("p_type").alias("title")).distinct()
    current = G.prune_stale_reports(stored, reports, "kb")
    return current.select("id", "change").unionByName(G.stale_reports(stored, current).withColumn("change", F.lit("stale")))


@query("n28_graph_preview", f"""with {NODES_SQL}, {EDGES_SQL}, {BOTH_SQL.format('ed')}, dg as (select src as name, count(*) / 1000 as pagerank from lk group by src),
 top as (select name from nd join dg using (name) order by pagerank desc, name limit 256)
select src, dst, weight from ed where src in (select name from top) and dst in (select name from top) order by weight desc, src, dst limit 128""")
def n28(t):
    nodes = graph_nodes(t).join(G.degrees(edges(t)), "name").withColumn("pagerank", F.col("rank") / 1000)
    return G.preview(nodes, edges(t))[1]


@query("g27_type_samples", f"""with {NODES_SQL}, {EDGES_SQL}, {BOTH_SQL.format('ed')}, dg as (select src as name, count(*) as rank from lk group by src)
select case when type = 'PART' then source else type end as type, name, row_number() over (partition by case when type = 'PART' then source else type end order by rank desc, name) as place from nd join dg using (name)
qualify row_number() over (partition by case when type = 'PART' then source else type end order by rank desc, name) <= 5""")
def g27(t):
    kind = F.when(F.col("type") == "PART", F.col("source")).otherwise(F.col("type"))
    nodes = graph_nodes(t).withColumn("type", kind).join(G.degrees(edges(t)), "name")
    return G.type_samples(nodes, 5).select("type", "name", "place")
