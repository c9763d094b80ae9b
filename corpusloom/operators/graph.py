"""Knowledge graphs as DataFrames: mentions, merging, ranking, components, communities, paths, search.

Nodes and edges are separate tables; an undirected edge has ``src < dst``. What a document store keeps as one growing
record per entity (descriptions, sources) is kept in long form, so an entity named in a third of all chunks never has
to fit one row. Iterative algorithms loop on the driver over iterations only and cut their lineage into the shared
checkpoint folder, so a lost executor costs one round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import text as X
from corpusloom.operators.running import row_numbers, running_sum, top_k
from corpusloom.session import cut_lineage, replaced, settle

# --- records and mentions -----------------------------------------------------------------------------------


def parse_records(df: DataFrame, chunk: str, record: str, delimiter: str, types: list[str]) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) from delimited extraction records; malformed records and unwanted types are dropped."""
    base = df.select(chunk, X.split_by_markers(F.col(record), [delimiter]).alias("p"))
    part = lambda i: X.clean_string(F.get("p", F.lit(i)))
    upper = lambda i: F.upper(X.clean_string(F.upper(F.get("p", F.lit(i)))))
    entities = base.filter((F.size("p") >= 4) & (F.col("p")[0] == '"entity"')).select(
        upper(1).alias("name"), upper(2).alias("type"), part(3).alias("description"), F.col(chunk).alias("source"))
    entities = entities.filter((X.strip(F.col("name")) != "") & F.lower("type").isin([t.lower() for t in types]))
    last = F.element_at("p", F.when(F.size("p") > 0, -1))
    weight = F.when(last.rlike(r"^[-+]?[0-9]*\.?[0-9]+$"), last.try_cast("double")).otherwise(1.0)
    relations = base.filter((F.size("p") >= 5) & (F.col("p")[0] == '"relationship"')).select(
        F.least(upper(1), upper(2)).alias("src"), F.greatest(upper(1), upper(2)).alias("dst"), weight.alias("weight"), part(3).alias("description"),
        part(4).alias("keyword"), F.col(chunk).alias("source"))
    return entities, relations


CONNECTORS = "of|in|on|at|for|and|or|the|a|an|to"  # words a capitalised run may pass over
RUN = rf"\p{{Lu}}[\p{{L}}\p{{N}}-]*(?: (?:(?:{CONNECTORS}) )*\p{{Lu}}[\p{{L}}\p{{N}}-]*)*"


def mentions(chunks: DataFrame, chunk: str, text: str) -> DataFrame:
    """``(chunk, sent, name)``: capitalised runs per sentence, and their parts around conjunctions."""
    sentences = chunks.select(chunk, F.posexplode(F.split(text, r"[.!?。！？\n]")).alias("sent", "s"))
    runs = sentences.select(chunk, "sent", F.explode(F.regexp_extract_all("s", F.lit(RUN), F.lit(0))).alias("run"))
    names = F.array_distinct(F.concat(F.array("run"), F.split("run", " (?:and|or) (?:the |a |an )?")))
    return runs.select(chunk, "sent", F.explode(names).alias("name")).select(chunk, "sent", F.upper("name").alias("name")).distinct()


def cooccurrences(found: DataFrame, chunk: str, distance: int = 0, strength: float | None = 1.0, texts: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``(chunk, src, dst, weight)``: names in the same or up to ``distance`` neighbouring sentences, once per chunk.

    The join key holds the sentence, so a name meets its neighbourhood, not its whole chunk. ``strength=None`` weighs
    an edge by the share of both names among all name occurrences of the chunk, at least 0.01.
    """
    left = found.select(chunk, F.col("name").alias("src"), F.explode(F.sequence(F.col("sent") - distance, F.col("sent") + distance)).alias("sent"))
    right = found.select(chunk, F.col("name").alias("dst"), "sent")
    pairs = left.join(right, [chunk, "sent"]).filter(F.col("src") < F.col("dst")).select(chunk, "src", "dst").distinct()
    if strength is not None:
        return pairs.withColumn("weight", F.lit(strength))
    upper = texts.select(chunk, F.upper(text).alias("__t"))
    counts = found.select(chunk, "name").distinct().join(upper, chunk).select(
        chunk, "name", ((F.length("__t") - F.length(F.replace("__t", F.col("name"), F.lit("")))) / F.length("name")).alias("__c"))
    total = counts.groupBy(chunk).agg(F.sum("__c").alias("__n"))
    share = counts.join(total, chunk).select(chunk, "name", F.coalesce(F.try_divide("__c", "__n"), F.lit(0.0)).alias("tf"))
    a = share.select(chunk, F.col("name").alias("src"), F.col("tf").alias("__a"))
    b = share.select(chunk, F.col("name").alias("dst"), F.col("tf").alias("__b"))
    return pairs.join(a, [chunk, "src"]).join(b, [chunk, "dst"]).select(chunk, "src", "dst", F.greatest(F.col("__a") + F.col("__b"), F.lit(0.01)).alias("weight"))


# --- merging ----------------------------------------------------------------------------------------------------


def merge_entities(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, descriptions) from ``(name, type, description, source)``.

    Type is the most frequent one (ties by name); descriptions are distinct and numbered in sorted order.
    """
    types = found.groupBy("name", "type").agg(F.count("*").alias("n"))
    best = types.groupBy("name").agg(F.min_by("type", F.struct(-F.col("n"), F.col("type"))).alias("type"))
    sources = found.groupBy("name").agg(F.count_distinct("source").alias("sources"))
    parts = row_numbers(found.select("name", "description").distinct(), "name", ["description"], "ordinal")
    return best.join(sources, "name"), parts


def merge_relations(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, descriptions) from ``(src, dst, weight, description, keyword, source)``; endpoints in any order."""
    flat = found.withColumns({"__a": F.least("src", "dst"), "__b": F.greatest("src", "dst")})
    flat = flat.select(F.col("__a").alias("src"), F.col("__b").alias("dst"), "weight", "description", "keyword", "source")
    edges = flat.groupBy("src", "dst").agg(
        F.sum("weight").alias("weight"), F.count_distinct("keyword").alias("keywords"), F.count_distinct("source").alias("sources"))
    parts = row_numbers(flat.select("src", "dst", "description").distinct(), ["src", "dst"], ["description"], "ordinal")
    return edges, parts


def merge_edges(*graphs: DataFrame) -> DataFrame:
    """Edge weights of several graphs added up."""
    every = reduce(lambda a, b: a.unionByName(b), [g.select("src", "dst", "weight") for g in graphs])
    return every.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def tidy(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop nodes and edges without a description or source, edges of dropped nodes; missing keywords become empty."""
    whole = F.col("description").isNotNull() & F.col("source").isNotNull()
    good = nodes.filter(whole)
    kept = valid_edges(edges.filter(whole), good)
    return good, kept.withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))


def valid_edges(edges: DataFrame, nodes: DataFrame, name: str = "name") -> DataFrame:
    """Edges whose two ends are nodes."""
    names = nodes.select(F.col(name).alias("__n")).distinct()
    return edges.join(names, F.col("src") == F.col("__n"), "left_semi").join(names, F.col("dst") == F.col("__n"), "left_semi")


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


#: Links of a node that lie in one row.
BUNCH = 32


def _dealt(links: DataFrame, value: Column) -> DataFrame:
    """``(src, bunch, link)``: the links ``(dst, value)`` of a node dealt out by hash to bunches of about ``BUNCH``, so a hot node is many bunches.

    ``value`` may use the node's summed weight ``__s``.
    """
    ends = links.groupBy("src").agg(F.sum("weight").alias("__s"), F.ceil(F.count("*") / BUNCH).alias("__k"))
    return links.join(ends, "src").select("src", F.pmod(F.xxhash64("dst"), F.col("__k")).alias("bunch"), F.struct("dst", value.alias("value")).alias("link"))


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("name"))
    return ends.groupBy("name").agg(F.count("*").alias("rank"))


def induced_by_source(node_sources: DataFrame, edge_sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per source: its nodes ``(source, name)`` and its edges ``(source, src, dst)`` with both ends among them."""
    nodes = node_sources.select("source", "name").distinct()
    end = lambda c: nodes.select("source", F.col("name").alias(c))
    edges = edge_sources.select("source", "src", "dst").distinct()
    return nodes, edges.join(end("src"), ["source", "src"], "left_semi").join(end("dst"), ["source", "dst"], "left_semi")


def rebuild_without(edge_sources: DataFrame, excluded: DataFrame) -> DataFrame:
    """Edge weights from every source but the excluded ones."""
    return merge_edges(edge_sources.join(excluded.select("source").distinct(), "source", "left_anti"))


# --- ranking ------------------------------------------------------------------------------------------------


def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int = 20, damping: float = 0.85, tolerance: float | None = None, name: str = "name") -> DataFrame:
    """Weighted, undirected PageRank ``(name, pagerank)``; isolated nodes spread their mass evenly.

    The links of a node lie in bunches, so a rank meets few rows; contributions are summed on the map side before they travel, and a hot
    node is many bunches. Stops early when the total change falls under ``tolerance`` times the node count.
    """
    flat = settle(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    links = both_ways(flat)
    strength = settle(links.groupBy("src").agg(F.sum("weight").alias("__s")))
    shares = settle(_dealt(links, F.col("weight") / F.col("__s")).groupBy("src", "bunch").agg(F.collect_list("link").alias("links")).drop("bunch"))
    base = settle(nodes.select(F.col(name).alias("name")).distinct().join(strength.withColumnRenamed("src", "name"), "name", "left").select(
        "name", F.col("__s").isNull().alias("__alone")))
    replaced(flat, strength)
    n, lonely = base.count(), not base.filter("__alone").isEmpty()
    ranks = base.withColumn("pagerank", F.lit(1.0 / n))
    for i in range(iterations):
        flow = ranks.join(shares, ranks["name"] == shares["src"]).select("pagerank", F.inline("links")).groupBy(F.col("dst").alias("name")).agg(F.sum(F.col("pagerank") * F.col("value")).alias("__in"))
        lost = ranks.filter("__alone").agg(F.sum("pagerank")).scalar() if lonely else F.lit(0.0)
        new = base.join(flow, "name", "left").select(
            "name", "__alone", (damping * (F.coalesce("__in", F.lit(0.0)) + lost / n) + (1 - damping) / n).alias("pagerank"))
        new, old = settle(new), ranks
        change = None
        if tolerance is not None:
            change = new.alias("a").join(old.alias("b"), "name").agg(F.sum(F.abs(F.col("a.pagerank") - F.col("b.pagerank")))).first()[0]
        ranks = new
        replaced(old)
        if change is not None and change < n * tolerance:
            break
    return ranks.select("name", "pagerank")


# --- duplicates and components -----------------------------------------------------------------------------------



def digit_signature(name: Column) -> Column:
    """The two-character pieces of a name that hold a digit; similar names must agree on all of them."""
    return F.array_join(F.array_sort(F.filter(X.bigrams(name), lambda g: g.rlike("[0-9]"))), "\u0001")


def names_similar(a: Column, b: Column) -> Column:
    """Same digit pieces, and a small edit distance (Latin names) or nearly the same characters (others)."""
    english = X.is_english(a) & X.is_english(b)
    limit = F.floor(F.least(F.length(a), F.length(b)) / 2).cast("int")
    chars = lambda c: F.array_distinct(F.split(c, ""))
    shared = F.size(F.array_intersect(chars(a), chars(b)))
    most = F.greatest(F.size(chars(a)), F.size(chars(b)))
    loose = F.when(most < 4, shared > 1).otherwise(shared / most >= 0.8)
    return (digit_signature(a) == digit_signature(b)) & F.when(english, F.levenshtein(a, b) <= limit).otherwise(loose)


#: Names of a tile; two tiles are compared by one matrix product.
TILE = 1024


def _survivors(a: list[str], b: list[str], a_latin: np.ndarray, b_latin: np.ndarray) -> np.ndarray:
    """Which names of two tiles can be similar: Latin pairs by their letters with repeats, others by their distinct characters.

    Names of lengths m <= n within edit distance ``⌊m/2⌋`` share at least ``n - ⌊m/2⌋`` letters.
    """
    seen: dict[tuple[str, int], int] = {}
    marks: list[tuple[np.ndarray, np.ndarray]] = []
    for names in (a, b):
        rows, cols = [], []
        for i, name in enumerate(names):
            used: dict[str, int] = {}
            for c in name:
                used[c] = used.get(c, 0) + 1
                rows.append(i)
                cols.append(seen.setdefault((c, used[c]), len(seen)))
        marks.append((np.array(rows, int), np.array(cols, int)))
    once = np.array([k[1] == 1 for k in seen], bool)
    bags = []
    for names, (rows, cols) in zip((a, b), marks):
        m = np.zeros((len(names), len(seen)), np.float32)
        m[rows, cols] = 1
        bags.append(m)
    m, n = np.array([len(x) for x in a])[:, None], np.array([len(x) for x in b])[None]
    bag = bags[0] @ bags[1].T >= np.maximum(m, n) - np.minimum(m, n) // 2
    sets = [x[:, once] for x in bags]
    shared, most = sets[0] @ sets[1].T, np.maximum(sets[0].sum(1)[:, None], sets[1].sum(1)[None])
    loose = np.where(most < 4, shared > 1, shared >= 0.8 * most - 1e-3)
    return np.where(a_latin[:, None] & b_latin[None], bag, loose)


def similar_candidates(nodes: DataFrame, name: str, block: str, new: str | None = None) -> DataFrame:
    """``(block, a, b)`` with ``a < b``: pairs of names of one block that no bound rules out.

    Repeated names are merged first, so a hot name is one row. The names of a block and digit signature are dealt to tiles
    of about ``TILE`` names; each pair of tiles is one row, so a hot block spreads over many tasks.
    """
    fresh = F.max(F.col(new)) if new else F.lit(True)
    names = nodes.groupBy(F.col(block).alias("block"), F.col(name).alias("n")).agg(fresh.alias("fresh")).filter(F.col("block").isNotNull() & F.col("n").isNotNull())
    names = cut_lineage(names.withColumn("e", X.is_english(F.col("n"))).withColumn("sig", digit_signature(F.col("n"))))
    sizes = names.groupBy("block", "sig").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    dealt = names.join(sizes, ["block", "sig"]).withColumn("tile", F.pmod(F.xxhash64("n"), F.col("tiles")))
    tiles = cut_lineage(dealt.groupBy("block", "sig", "tile").agg(F.collect_list(F.struct("n", "fresh", "e")).alias("names")))
    left, right = tiles.select("block", "sig", F.col("tile").alias("t"), F.col("names").alias("x")), tiles.select("block", "sig", F.col("tile").alias("u"), F.col("names").alias("y"))
    both = left.join(right, ["block", "sig"]).filter("t <= u").select("block", (F.col("t") == F.col("u")).alias("same"), *[F.col(s)[f].alias(f"{s}_{f}") for s in "xy" for f in ("n", "fresh", "e")])
    kind = both.schema["block"].dataType.simpleString()

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                keep = _survivors(r["x_n"], r["y_n"], np.array(r["x_e"], bool), np.array(r["y_e"], bool))
                keep &= np.array(r["x_fresh"], bool)[:, None] | np.array(r["y_fresh"], bool)[None]
                if r["same"]:
                    keep = np.triu(keep, 1)
                at = np.argwhere(keep)
                if len(at):
                    found = [sorted((r["x_n"][p], r["y_n"][q])) for p, q in at]
                    yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(at), batch.schema.field("block").type), *(pa.array([f[j] for f in found], pa.string()) for j in (0, 1))], names=["block", "a", "b"])

    # A row is two tiles: spread the pairs, and keep few of them in one Arrow batch.
    return both.repartition(F.xxhash64("block", "x_n", "y_n")).mapInArrow(compare, f"block {kind}, a string, b string")


def similar_names(nodes: DataFrame, name: str, block: str, new: str | None = None) -> DataFrame:
    """``(block, a, b)`` with ``a < b``: names of one block that pass :func:`names_similar`, exactly. With ``new``, at least one of the two must be new."""
    return similar_candidates(nodes, name, block, new).filter(names_similar(F.col("a"), F.col("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(name, component)``: the least name reachable. Rounds take the least neighbour label, then follow it, until nothing changes."""
    links = cut_lineage(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut_lineage(links.groupBy(F.col("src").alias("name")).agg(F.least(F.first("src"), F.min("dst")).alias("component")))
    while True:
        near = links.join(labels, links["dst"] == labels["name"]).groupBy(F.col("src").alias("name")).agg(F.min("component").alias("__m"))
        step = labels.join(near, "name").select("name", F.col("component").alias("__old"), F.least("component", "__m").alias("component"))
        target = step.select(F.col("name").alias("__t"), F.col("component").alias("__next"))
        new = step.join(target, step["component"] == target["__t"]).select("name", "__old", F.least("component", "__next").alias("component"))
        new = cut_lineage(new)
        labels = new.select("name", "component")
        if new.filter(F.col("__old") != F.col("component")).isEmpty():
            return labels


def contract(nodes: DataFrame, edges: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge the nodes of each group ``(name, component)`` into the component's name.

    Returns the remaining nodes ``(name, merged)`` and edges with redirected ends, parallel weights added, loops gone.
    """
    to = groups.select(F.col("name").alias("__n"), "component")
    moved = nodes.join(to, nodes["name"] == to["__n"], "left").select(F.coalesce("component", "name").alias("name"))
    end = lambda df, c: df.join(to, df[c] == to["__n"], "left").withColumn(c, F.coalesce("component", c)).drop("__n", "component")
    redirected = end(end(edges.select("src", "dst", "weight"), "src"), "dst").filter(F.col("src") != F.col("dst"))
    flat = redirected.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "weight")
    return moved.groupBy("name").agg(F.count("*").alias("merged")), flat.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight"))


def change_set(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """added / updated / removed rows between two versions of a node or edge table."""
    a = old.select(*keys, F.col(value).alias("__a"), F.lit(1).alias("__x"))
    b = new.select(*keys, F.col(value).alias("__b"), F.lit(1).alias("__y"))
    both = a.join(b, keys, "full")
    kind = F.when(F.col("__x").isNull(), "added").when(F.col("__y").isNull(), "removed").when(~F.col("__a").eqNullSafe(F.col("__b")), "updated")
    return both.select(*keys, kind.alias("change")).filter(F.col("change").isNotNull())


def largest_component(edges: DataFrame) -> DataFrame:
    """Edges of the largest component; names upper-cased and unescaped, ties to the smaller component name."""
    clean = lambda c: F.upper(X.strip(X.unescape_entities(F.col(c))))
    norm = edges.select(clean("src").alias("src"), clean("dst").alias("dst"), "weight")
    labels = components(norm)
    sizes = labels.groupBy("component").agg(F.count("*").alias("n"))
    best = sizes.agg(F.min_by("component", F.struct(-F.col("n"), F.col("component")))).scalar()
    members = labels.filter(F.col("component") == best).select(F.col("name").alias("src"))
    return norm.join(members, "src", "left_semi").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight")


# --- communities ---------------------------------------------------------------------------------------------------


#: Links of a node that one task weighs; a node of more is several pieces.
PIECE = 1 << 16


def _moved(links: DataFrame, strength: DataFrame, total: float, rounds: int, seed: int) -> DataFrame:
    """``(name, own, community, k)`` after rounds of moves, or fewer if a whole pair of rounds moves nothing; ``strength``: ``(name, k, n)``.

    A round moves the links twice: to the label of their end, with the weight of its community, and to the node that chooses. What a node
    of more than ``PIECE`` links chooses from is dealt out by community.
    """
    labels, still = strength.select("name", F.col("name").alias("community"), "k"), 0
    # At most one row for each PIECE of links.
    hubs = F.broadcast(strength.filter(F.col("n") > PIECE).select("name", F.ceil(F.col("n") / PIECE).alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1).cast("long"))
    for i in range(rounds):
        mass = labels.groupBy("community").agg(F.sum("k").alias("tot"))
        own = labels.select("name", "community", "k").join(mass, "community")
        toward = links.join(own.select(F.col("name").alias("dst"), "community", "tot"), "dst").select(F.col("src").alias("name"), "community", "tot", F.col("weight").alias("into"))
        # Staying is always a choice, also where no neighbour shares the community.
        options = toward.unionByName(own.select("name", "community", "tot", F.lit(0.0).alias("into")))
        options = options.join(hubs, "name", "left").select("name", F.pmod(F.xxhash64("community"), pieces).alias("piece"), "community", "tot", "into")
        options = options.repartition("name", "piece").groupBy("name", "piece", "community").agg(F.sum("into").alias("into"), F.max("tot").alias("tot"))
        chooses = own.join(hubs, "name", "left").select("name", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"), F.col("community").alias("own"), "k")
        options = options.join(chooses, ["name", "piece"])
        rest = F.col("tot") - F.when(F.col("community") == F.col("own"), F.col("k")).otherwise(0.0)
        gain = F.round(F.col("into") - rest * F.col("k") / total, 9)
        choice = F.struct(gain.alias("gain"), (F.col("community") == F.col("own")).alias("stays"), F.col("community"))
        found = options.groupBy("name", "piece").agg(F.max(choice).alias("__best"), F.max("own").alias("own"), F.max("k").alias("k"))
        found = found.groupBy("name").agg(F.max("__best").alias("__best"), F.max("own").alias("own"), F.max("k").alias("k"))
        turn = F.pmod(F.xxhash64("name", F.lit(seed + i // 2)), F.lit(2)) == i % 2  # each node once in two rounds
        new = settle(found.select("name", "own", F.when(turn, F.col("__best.community")).otherwise(F.col("own")).alias("community"), "k"))
        replaced(labels)
        labels = new
        still = still + 1 if new.filter("own <> community").isEmpty() else 0
        if still == 2:
            break
    return labels


def modularity_communities(edges: DataFrame, rounds: int = 4, seed: int = 7, gain: float = 1e-3) -> DataFrame:
    """``(name, community)``: nodes move to the neighbouring community of the best modularity gain, then communities become the nodes
    of a smaller weighted graph, on which the same is done, until a level gains no more than ``gain``.

    In every round a seeded hash lets one half of the nodes move, which stops neighbours from swapping for ever. The weight inside a
    community is kept as its node's loop. What a round or level replaces is deleted.
    """
    flat = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), F.col("weight").cast("double").alias("weight"))
    graph = settle(flat.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    total = 2.0 * (graph.agg(F.sum("weight")).first()[0] or 0.5)
    members, best, level = None, None, 0
    while True:
        links = both_ways(graph.filter("src <> dst"))
        ends = graph.select(F.col("src").alias("name"), "weight").unionByName(graph.select(F.col("dst").alias("name"), "weight"))
        strength = settle(ends.groupBy("name").agg(F.sum("weight").alias("k"), F.count("*").alias("n")))
        found = _moved(links, strength, total, rounds, seed + 10 * level)
        replaced(strength)
        to = found.select("name", "community")
        joined = to if members is None else members.join(to.select(F.col("name").alias("community"), F.col("community").alias("__c")), "community").select("name", F.col("__c").alias("community"))
        joined = settle(joined)
        a, b = to.select(F.col("name").alias("src"), F.col("community").alias("__a")), to.select(F.col("name").alias("dst"), F.col("community").alias("__b"))
        smaller = graph.join(a, "src").join(b, "dst").groupBy(F.least("__a", "__b").alias("src"), F.greatest("__a", "__b").alias("dst")).agg(F.sum("weight").alias("weight"))
        smaller = settle(smaller)
        inside = smaller.filter("src = dst").agg(F.sum("weight")).first()[0] or 0.0
        squares = found.groupBy("community").agg(F.sum("k").alias("t")).agg(F.sum(F.col("t") * F.col("t"))).first()[0] or 0.0
        score = 2 * inside / total - squares / (total * total)
        if best is not None and score <= best + gain:
            replaced(found, graph, joined, smaller)
            return members
        replaced(found, graph, members)
        members, best, graph, level = joined, score, smaller, level + 1


def hierarchical_communities(edges: DataFrame, max_size: int = 12, levels: int = 2, rounds: int = 4, seed: int = 7) -> DataFrame:
    """``(level, community, name)``: communities, and again inside those larger than ``max_size``."""
    out, inside, prefix = [], edges, None
    for level in range(levels):
        flat = modularity_communities(inside, rounds, seed + 100 * level)
        found = flat if prefix is None else flat.join(prefix, "name").select("name", F.concat_ws("/", "__p", "community").alias("community"))
        found = settle(found)
        replaced(flat)
        out.append(found.select(F.lit(level).alias("level"), "community", "name"))
        large = found.groupBy("community").agg(F.count("*").alias("n")).filter(F.col("n") > max_size).select("community")
        members = found.join(large, "community", "left_semi")
        a, b = members.select(F.col("name").alias("src"), F.col("community").alias("__a")), members.select(F.col("name").alias("dst"), F.col("community").alias("__b"))
        old, inside = inside, settle(inside.join(a, "src").join(b, "dst").filter(F.col("__a") == F.col("__b")).select("src", "dst", "weight"))
        replaced(old)
        prefix = members.select("name", F.col("community").alias("__p"))
        if inside.isEmpty():
            break
    replaced(inside)
    return reduce(lambda x, y: x.unionByName(y), out)


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Modularity of a partition, one row."""
    m = edges.agg(F.sum("weight")).scalar()
    a, b = labels.select(F.col("name").alias("src"), F.col("community").alias("__a")), labels.select(F.col("name").alias("dst"), F.col("community").alias("__b"))
    inside = edges.join(a, "src").join(b, "dst").filter(F.col("__a") == F.col("__b")).agg(F.sum("weight").alias("w"))
    k = both_ways(edges).groupBy(F.col("src").alias("name")).agg(F.sum("weight").alias("k"))
    squares = k.join(labels, "name").groupBy("community").agg(F.sum("k").alias("t")).agg(F.sum(F.col("t") * F.col("t")).alias("q"))
    return inside.select((F.coalesce("w", F.lit(0.0)) / m - squares.scalar() / (4 * m * m)).alias("modularity"))


def community_weights(members: DataFrame, ranks: DataFrame, rank: str = "rank", weight: Column | None = None) -> DataFrame:
    """Sum of rank times weight per community, divided by the largest of its level."""
    scored = members.join(ranks, "name", "left").withColumn("__w", F.coalesce(F.col(rank), F.lit(0)) * (F.lit(1.0) if weight is None else weight))
    sums = scored.groupBy("level", "community").agg(F.sum("__w").alias("__s"))
    top = sums.groupBy("level").agg(F.max("__s").alias("__m"))
    return sums.join(top, "level").select("level", "community", F.coalesce(F.try_divide("__s", "__m"), F.lit(0.0)).alias("weight"))


def community_tables(members: DataFrame, edges: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, edges inside) of the communities of at least two nodes; with ``limit``, a report lists so many edges."""
    sizes = members.groupBy("level", "community").agg(F.count("*").alias("n")).filter(F.col("n") >= 2)
    kept = members.join(sizes.drop("n"), ["level", "community"], "left_semi")
    a = kept.select("level", "community", F.col("name").alias("src"))
    b = kept.select("level", "community", F.col("name").alias("dst"))
    inside = edges.join(a, "src").join(b, ["level", "community", "dst"]).select("level", "community", "src", "dst", "weight")
    ranked = row_numbers(inside, ["level", "community"], ["src", "dst"], "line")
    return kept, ranked if limit is None else ranked.filter(F.col("line") <= limit)


def membership_titles(members: DataFrame, titles: DataFrame) -> DataFrame:
    """``(name, title)``: the distinct community titles of every node."""
    return members.join(titles, ["level", "community"]).select("name", "title").distinct()


def prune_stale_reports(stored: DataFrame, reports: DataFrame, scope: str, title: str = "title") -> DataFrame:
    """Reports get ids from their title; new ones replace old ones, old ones not produced again disappear."""
    return reports.withColumn("id", F.md5(F.concat(F.lit("community_report::"), F.col(title), F.lit(scope)))).join(
        stored.select("id", F.lit(True).alias("__old")), "id", "left").withColumn("change", F.when(F.col("__old"), "replaced").otherwise("new")).drop("__old")


def stale_reports(stored: DataFrame, current: DataFrame) -> DataFrame:
    return stored.join(current.select("id"), "id", "left_anti")


# --- paths ------------------------------------------------------------------------------------------------------------


def extend_paths(paths: DataFrame, links: DataFrame, weights: bool = False) -> DataFrame:
    """One more hop for every path that can take one; a path ends at a cycle or when every step would repeat an edge."""
    last = F.element_at("path", -1)
    closed = F.array_contains(F.slice("path", F.lit(1), F.size("path") - 1), last)
    steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.element_at("path", i).alias("a"), F.element_at("path", i + 1).alias("b")))
    ended = paths.filter(closed)
    open_paths = paths.filter(~closed).withColumn("__last", last)
    nxt = links.select(F.col("src").alias("__last"), F.col("dst").alias("__to"), F.col("weight").alias("__w"))
    joined = open_paths.join(nxt, "__last")
    repeated = F.exists(steps, lambda s: ((s["a"] == F.col("__last")) & (s["b"] == F.col("__to"))) | ((s["b"] == F.col("__last")) & (s["a"] == F.col("__to"))))
    grown = joined.filter(~repeated)
    longer = {"path": F.array_append("path", F.col("__to"))}
    if weights:
        longer["weights"] = F.array_append("weights", F.col("__w"))
    grown = grown.withColumns(longer)
    stuck = open_paths.join(grown.select(F.slice("path", F.lit(1), F.size("path") - 1).alias("path")).distinct(), "path", "left_anti")
    cols = paths.columns
    return ended.select(cols).unionByName(grown.select(cols)).unionByName(stuck.select(cols))


def n_hop_paths(edges: DataFrame, seeds: DataFrame, hops: int = 2, seed: str = "name") -> DataFrame:
    """``(seed, path, weights)``: maximal paths of at most ``hops`` edges from every seed."""
    links = cut_lineage(both_ways(edges))
    starts = links.join(seeds.select(F.col(seed).alias("src")).distinct(), "src", "left_semi")
    paths = starts.select(F.col("src").alias("seed"), F.array("src", "dst").alias("path"), F.array("weight").alias("weights"))
    for _ in range(hops - 1):
        # Each hop reads the paths so far three times.
        paths = cut_lineage(extend_paths(cut_lineage(paths), links, weights=True))
    return paths


def path_scores(paths: DataFrame, hits: DataFrame, query: str = "query_id") -> DataFrame:
    """``(query, src, dst, sim, pagerank)``: each step of a path adds the seed's similarity over its depth plus two."""
    joined = paths.join(hits.select(query, F.col("name").alias("seed"), "sim"), "seed")
    steps = F.transform("weights", lambda w, i: F.struct(i.alias("i"), F.get("path", i).alias("src"), F.get("path", i + 1).alias("dst"), w.alias("w")))
    rows = joined.select(query, "sim", F.inline(steps))
    return rows.groupBy(query, "src", "dst").agg(F.sum(F.col("sim") / (2 + F.col("i"))).alias("sim"), F.max("w").alias("pagerank"))


# --- search ------------------------------------------------------------------------------------------------------------


def rank_entities(hits: DataFrame, typed: DataFrame, n: int, query: str = "query_id") -> DataFrame:
    """Entity hits, doubled when their type was asked for, by similarity times page rank."""
    marked = hits.join(typed.select(query, "name").distinct().withColumn("__t", F.lit(True)), [query, "name"], "left")
    scored = marked.withColumn("score", F.round(F.col("sim") * F.when(F.col("__t"), 2).otherwise(1) * F.col("pagerank"), 9)).drop("__t")
    return top_k(scored, query, [F.col("score").desc(), F.col("name")], n)


def rank_relations(hits: DataFrame, hops: DataFrame, typed: DataFrame, n: int, query: str = "query_id") -> DataFrame:
    """Relation hits raised by hop scores and asked-for end types; relations known only from hops join in."""
    a = hits.select(query, "src", "dst", F.col("sim").alias("__h"), F.col("pagerank").alias("__hp"))
    b = hops.select(query, "src", "dst", F.col("sim").alias("__p"), F.col("pagerank").alias("__pp"))
    both = a.join(b, [query, "src", "dst"], "full")
    for end in ("src", "dst"):
        asked = typed.select(query, F.col("name").alias(end)).distinct().withColumn(f"__{end}", F.lit(1))
        both = both.join(asked, [query, end], "left")
    ends = F.coalesce("__src", F.lit(0)) + F.coalesce("__dst", F.lit(0))
    sim = F.when(F.col("__h").isNotNull(), F.col("__h") * (F.coalesce("__p", F.lit(0.0)) + ends + 1)).otherwise(F.col("__p") * (ends + 1))
    scored = both.select(query, "src", "dst", F.round(sim * F.coalesce("__hp", "__pp"), 9).alias("score"))
    return top_k(scored, query, [F.col("score").desc(), F.col("src"), F.col("dst")], n)


def communities_of(entities: DataFrame, members: DataFrame, weights: DataFrame, n: int, query: str = "query_id") -> DataFrame:
    """Communities that hold any hit entity, by weight."""
    found = entities.select(query, "name").join(members, "name").select(query, "level", "community").distinct().join(weights, ["level", "community"])
    return top_k(found, query, [F.round("weight", 9).desc(), F.col("level"), F.col("community")], n)


def type_samples(nodes: DataFrame, k: int) -> DataFrame:
    """The ``k`` best-ranked entities of every type."""
    return top_k(nodes, "type", [F.col("rank").desc(), F.col("name")], k, "place")


def preview(nodes: DataFrame, edges: DataFrame, n_nodes: int = 256, n_edges: int = 128) -> tuple[DataFrame, DataFrame]:
    """Top nodes by page rank, and the heaviest edges between them."""
    best = nodes.orderBy(F.col("pagerank").desc(), "name").limit(n_nodes)
    inside = valid_edges(edges.filter(F.col("src") != F.col("dst")), best)
    return best, inside.orderBy(F.col("weight").desc(), "src", "dst").limit(n_edges)


def search_rows(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Entities and relations as searchable rows with tokens."""
    entity = nodes.select(
        F.col("name").alias("id"), F.lit("entity").alias("kind"), X.tokens(F.col("name")).alias("title_tks"), X.tokens(F.col("description")).alias("content_ltks"),
        F.to_json(F.struct("name", "type", "description")).alias("content"), F.lit(0).alias("available"))
    relation = edges.select(
        F.concat_ws("->", "src", "dst").alias("id"), F.lit("relation").alias("kind"), X.tokens(F.concat_ws(" ", "src", "dst")).alias("title_tks"),
        X.tokens(F.col("description")).alias("content_ltks"), F.to_json(F.struct("src", "dst", "weight", "description")).alias("content"), F.lit(0).alias("available"))
    return entity.unionByName(relation)


def merge_trees(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Nested maps in leaf form ``(key, path, pos, value, is_list)``: lists extend, the second scalar wins."""
    both = a.withColumn("__s", F.lit(0)).unionByName(b.withColumn("__s", F.lit(1)))
    state = both.groupBy(key, "path").agg(F.max("__s").alias("__last"), F.bool_and("is_list").alias("__lists"))
    kept = both.join(state, [key, "path"]).filter(F.col("__lists") | (F.col("__s") == F.col("__last")))
    return row_numbers(kept, [key, "path"], ["__s", "pos", "value"], "ordinal").select(key, "path", "ordinal", "value")


#: Positions of a node's links on an axis of about this length: shares of the node's weight as whole numbers, whose sums are exact.
AXIS = 1 << 40


def random_walks(edges: DataFrame, walks: int, length: int, seed: int = 86) -> DataFrame:
    """``(name, walk, path)``: each step draws a neighbour by its weight with a seeded hash, so a walk can be repeated exactly.

    The links of a node lie one after the other on an axis, each as long as its share of the weight; a hash of the walk and the step is
    a place on it. A node's axis has as many cells of one width as it has bunches of links, so a place is found in the few bunches that
    reach into its cell, however many neighbours the node has. Parallel edges count as their heaviest; edges without a positive weight are never drawn.
    """
    swap = F.col("src").isNull() | (F.col("src") > F.col("dst"))
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("src", "dst"), ("dst", "src"))]
    edges = settle(edges.select(*ends, "weight").groupBy("src", "dst").agg(F.max("weight").cast("double").alias("weight")))
    links = edges.unionByName(edges.filter(~F.col("src").eqNullSafe(F.col("dst"))).select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    starts = links.select(F.col("src").alias("name")).distinct()
    walk = starts.select("name", F.explode(F.sequence(F.lit(1), F.lit(walks))).alias("walk")).withColumn("path", F.array("name"))
    if length == 1:
        return walk
    dealt = _dealt(links.filter(F.col("weight") > 0), F.ceil(F.col("weight") * float(AXIS) / F.col("__s")).cast("long"))
    bunches = settle(dealt.groupBy("src", "bunch").agg(F.sort_array(F.collect_list("link")).alias("links"), F.sum("link.value").alias("total")))
    placed = running_sum(bunches.select("src", "bunch", "total"), "src", ["bunch"], F.col("total"), "end")
    nodes = settle(placed.groupBy("src").agg(F.max("end").alias("whole"), F.count("*").alias("cells")))
    cell = lambda place: F.floor(place * (F.col("cells") / float(AXIS)))
    spans = placed.join(nodes, "src").select("src", "bunch", (F.col("end") - F.col("total")).alias("begin"), "end", "cells")
    spans = settle(spans.select("src", "bunch", "begin", "end", F.explode(F.sequence(cell(F.col("begin")), cell(F.col("end") - 1))).alias("cell")))
    for step in range(length - 1):
        here = walk.withColumn("src", F.element_at("path", -1)).join(nodes, "src")
        here = here.withColumn("place", F.pmod(F.xxhash64("name", "walk", F.lit(seed + step)), F.col("whole")))
        here = here.select("name", "walk", "path", "src", "place", cell(F.col("place")).alias("cell"))
        here = here.join(spans, ["src", "cell"]).filter("begin <= place and place < end")
        here = here.select("name", "walk", "path", "src", "bunch", (F.col("place") - F.col("begin")).alias("place"))
        # Along the bunch: what is left of the place, until a link holds it.
        found = F.aggregate(
            "links", F.struct(F.col("place").alias("left"), F.lit(None).cast(edges.schema["dst"].dataType).alias("dst")),
            lambda s, e: F.when(s["left"] < 0, s).otherwise(F.struct((s["left"] - e["value"]).alias("left"), e["dst"].alias("dst"))))
        walk = settle(here.join(bunches.select("src", "bunch", "links"), ["src", "bunch"]).select("name", "walk", F.array_append("path", found["dst"]).alias("path")))
    return walk


#: Words of random walks that one task trains on.
TRAINED_WORDS = 1 << 22


def node_embeddings(edges: DataFrame, dimensions: int = 64, walks: int = 10, length: int = 40, window: int = 2, iterations: int = 3, seed: int = 86) -> DataFrame:
    """Skip-gram vectors of the nodes over their random walks; walks of more than ``TRAINED_WORDS`` nodes are trained on by several tasks."""
    paths = random_walks(edges, walks, length, seed).select("path")
    parts = -(-paths.count() * length // TRAINED_WORDS) or 1
    model = Word2Vec(vectorSize=dimensions, minCount=0, windowSize=window, maxIter=iterations, seed=seed, numPartitions=parts, inputCol="path", outputCol="v").fit(paths)
    return model.getVectors().select(F.col("word").alias("name"), vector_to_array("vector").alias("vector"))
