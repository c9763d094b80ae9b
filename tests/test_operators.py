"""Brute-force and property checks, including groups that hold a large share of all rows."""

import hashlib
import itertools
import json
import math
import random
import re
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusloom import session
from corpusloom.functions import text as X, vectors as VEC
from corpusloom.operators import chunking as C, graph as G, layout as L, ranking as K, retrieval as V, running as RUN, sqlapi as Q, tree as H, vector_search as S
from corpusloom.registry import Tables
from corpusloom.session import settle
from corpusloom.streaming import incremental as I


def test_running_sum_over_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"k{i % 50}", i, i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    got = {(r.k, r.pos): r.total for r in RUN.running_sum(df, "k", ["pos"], F.col("v"), "total").collect()}
    sums, want = {}, {}
    for k, pos, v in rows:
        sums[k] = sums.get(k, 0) + v
        want[(k, pos)] = sums[k]
    assert got == want


def test_nearest_rank(spark):
    values = [random.Random(5).randint(0, 40) / 2 for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = RUN.nearest_rank(df, [], "v", {"p50": 0.5, "p95": 0.95}).first()
    ordered = sorted(values)
    assert (row.p50, row.p95) == (ordered[int(np.ceil(0.5 * 501)) - 1], ordered[int(np.ceil(0.95 * 501)) - 1])


def test_similar_names_equals_all_pairs(spark):
    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abcde12 ") for _ in range(rng.randint(1, 6))).strip() or "x" for _ in range(90)} | {"中文名", "中文", "中文名字"})
    df = spark.createDataFrame([("b", n) for n in names for _ in range(2)], "block string, name string")
    got = {(r.a, r.b) for r in G.similar_names(df, "name", "block").collect()}
    pairs = spark.createDataFrame([p for p in itertools.product(names, names) if p[0] < p[1]], "a string, b string")
    want = {(r.a, r.b) for r in pairs.filter(G.names_similar(F.col("a"), F.col("b"))).collect()}
    assert got == want and want


def test_components_of_chains(spark):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60) if i % 20 != 19]
    df = spark.createDataFrame(edges, "src string, dst string")
    labels = {r.name: r.component for r in G.components(df).collect()}
    assert {labels[f"n{i:03d}"] for i in range(20)} == {"n000"} and len(set(labels.values())) == 3


def test_pagerank_sums_to_one_with_isolated_nodes(spark):
    edges = spark.createDataFrame([("a", "b", 2.0), ("b", "c", 1.0)], "src string, dst string, weight double")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("lone",)], "name string")
    ranks = {r.name: r.pagerank for r in G.pagerank(nodes, edges, 60, tolerance=1e-10).collect()}
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-6) and ranks["b"] > ranks["a"] > ranks["lone"]


def test_communities_beat_singletons(spark):
    inside = [(f"{g}{i}", f"{g}{j}", 1.0) for g in "abcd" for i in range(5) for j in range(i + 1, 5)]
    edges = spark.createDataFrame(inside + [("a0", "b0", 1.0), ("c0", "d0", 1.0)], "src string, dst string, weight double")
    labels = G.modularity_communities(edges, 8)
    assert labels.count() == 20
    assert G.modularity(edges, labels).first()[0] > 0.5


def test_communities_of_a_hub_in_several_pieces(spark, monkeypatch, tmp_path):
    """What a node of many links chooses from is weighed in pieces with the same result, and files of finished rounds are deleted."""
    rng = random.Random(8)
    rows = [("hub", f"n{i}", 1.0 + i % 3) for i in range(60)] + [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}", 2.0) for _ in range(150)] + [(None, "n1", 1.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    whole = sorted(G.modularity_communities(edges).collect())
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(G, "PIECE", 7)
    assert sorted(G.modularity_communities(edges).collect()) == whole and len(whole) == 61
    assert len(list(tmp_path.iterdir())) == 1


def test_hierarchy_covers_every_node_once_per_level(spark, data):
    found = entry.queries()["n13_hierarchical_communities"](spark, data).collect()
    top = [r.name for r in found if r.level == 0]
    assert len(top) == len(set(top)) > 0


def test_settled_rows_forget_the_estimates_of_their_plan(spark, capsys):
    rows = spark.range(10)
    for _ in range(5):  # a checkpoint would multiply the estimate by itself in every round
        rows = settle(rows.join(rows.withColumnRenamed("id", "a"), F.col("id") == F.col("a")).join(rows.withColumnRenamed("id", "b"), F.col("id") == F.col("b")).select("id"))
    rows.explain(mode="cost")
    size = capsys.readouterr().out.split("sizeInBytes=")[1].split(")")[0]
    assert rows.count() == 10 and size.endswith((" B", "KiB"))


def test_pagerank_keeps_no_files_of_finished_rounds(spark, tmp_path, monkeypatch):
    """After twelve rounds only the links, the nodes and the last ranks lie in the shared folder, and shuffle files are gone."""
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(session, "FORGET_SECONDS", 0.0)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum(b.toString().startswith("shuffle_") for b in map(blocks.getAllBlocks().apply, range(blocks.getAllBlocks().size())))
    edges = spark.createDataFrame([(f"a{i}", f"b{i * 7 % 90}", 1.0) for i in range(300)], "src string, dst string, weight double")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("name"))
    session.forget(spark)
    time.sleep(2)
    before = shuffled()
    ranks = G.pagerank(nodes, edges, 12)
    assert len(list(tmp_path.iterdir())) <= 3
    deadline = time.monotonic() + 20
    while (now := shuffled()) > before + 16 and time.monotonic() < deadline:
        time.sleep(0.5)
    assert now <= before + 16
    assert sum(r.pagerank for r in ranks.collect()) == pytest.approx(1.0, abs=1e-6)


def test_random_walks_repeat(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 2.0), ("a", "c", 1.0)], "src string, dst string, weight double")
    first = sorted(map(str, G.random_walks(edges, 2, 4).collect()))
    assert first == sorted(map(str, G.random_walks(edges, 2, 4).collect()))
    links = {("a", "b"), ("b", "c"), ("a", "c")}
    for row in G.random_walks(edges, 2, 4).collect():
        assert len(row.path) == 4 and all(tuple(sorted(p)) in links for p in zip(row.path, row.path[1:]))


def test_exact_neighbours_match_numpy_for_many_query_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    queries, items = rng.normal(size=(30, 8)), rng.normal(size=(200, 8))
    monkeypatch.setattr(S, "QUERY_BLOCK", 8)
    frame = lambda m, k: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{k} long, vector array<double>")
    got = {(r.query_id, r["rank"]): r.item_id for r in S.nearest(frame(queries, "query_id"), frame(items, "item_id"), 5).collect()}
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit(queries) @ unit(items).T, 6)
    for q in range(30):
        order = sorted(range(200), key=lambda i: (-sims[q, i], i))[:5]
        assert [got[(q, k + 1)] for k in range(5)] == order


def test_approximate_neighbours_have_recall(spark, data):
    t = Tables(spark, data)
    items = t.embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    queries = items.withColumnRenamed("vec_id", "query_id")
    exact = S.nearest(queries, items, 3, item="vec_id")
    near = S.nearest_approximate(queries, items, 3, item="vec_id", bucket_length=2.0, max_distance=1.5)
    hit = exact.join(near.select("query_id", "vec_id"), ["query_id", "vec_id"]).count()
    assert hit >= 0.8 * exact.count()


def test_containment_finds_short_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "xalpha betax"), (3, "zzz")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "alpha beta gamma"), (2, "lpha"), (3, "a b"), (4, "ta")], "item_id long, text string")
    got = {(r.item_id, r.doc_id) for r in V.containment_judgments(asked, "item_id", docs, "doc_id").collect()}
    assert got == {(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (4, 1), (4, 2)}


def test_tfidf_vectors_are_unit(spark, data):
    rows = entry.queries()["e2_batch_embedding"](spark, data).collect()
    assert rows and all(r.dim == 128 and (r.norm == pytest.approx(1.0) or r.norm == 0.0) for r in rows)


def test_buckets_are_bounded_and_complete(spark, data):
    t = Tables(spark, data)
    out = H.bounded_buckets(t.embeddings, "vec_id", "embedding", 16)
    sizes = [r.n for r in out.groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 16 and sum(sizes) == t.embeddings.count()


def test_equal_vectors_are_cut_into_slices(spark):
    df = spark.range(50).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    sizes = [r["count"] for r in H.bounded_buckets(df, "id", "v", 8).groupBy("bucket").count().collect()]
    assert max(sizes) <= 8 and sum(sizes) == 50


def test_matching_in_blocks_equals_plain_sums(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(c, f, f"t{t}", int(f == "a")) for c in range(60) for f in ("a", "b") for t in rng.sample(range(25), 8)]
    asked = [(q, f"t{t}", 1.0 + t / 7) for q in range(9) for t in rng.sample(range(30), 6)]
    postings = spark.createDataFrame(rows, "chunk long, field string, term string, first int")
    weighted = spark.createDataFrame(asked, "query_id long, term string, weight double")
    df, want = {}, {}
    for _, f, t, _ in rows:
        df[f, t] = df.get((f, t), 0) + 1
    idf = lambda f, t: np.log(1 + (60 - df[f, t] + 0.5) / (df[f, t] + 0.5)) / np.log(1 + 59.5 / 1.5)
    for q, t, w in asked:
        for c, f, u, first in rows:
            if t == u:
                cell = want.setdefault((q, c), {"a": 0.0, "b": 0.0, "n": 0})
                cell[f] += w * idf(f, t) * {"a": 3.0, "b": 2.0}[f]
                cell["n"] += first
    want = {k: (round(max(v["a"], v["b"]), 9), v["n"]) for k, v in want.items() if v["n"] >= 6 * 0.3}
    monkeypatch.setattr(V, "TERM_BLOCK", 60)
    monkeypatch.setattr(V, "MATCH_CELLS", 30)
    match = lambda **more: {(r.query_id, r.chunk): (round(r.score, 9), r.matched) for r in V.match_text(
        weighted, postings, F.lit(60), "chunk", boosts={"a": 3.0, "b": 2.0}, min_match=0.3, **more).collect()}
    assert match() == want
    top = match(best=2)
    for q in range(9):
        tops = sorted((k for k in want if k[0] == q), key=lambda k: (-want[k][0], k))[:2]
        assert all(top[k] == want[k] for k in tops)


def test_hashed_counts_match_plain_python(spark):
    words = ["alpha", "beta", "gamma", "beta", "x1", "alpha", "beta"]
    row = spark.createDataFrame([(" ".join(words),), (None,), ("",)], "text string").select(VEC.hash_embedding(F.col("text")).alias("v"), VEC.hash_embedding(F.col("text"), 100).alias("w")).collect()[0]
    for v, dim in ((row.v, 64), (row.w, 100)):
        want = [0.0] * dim
        for w in words:
            want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim] += 1
        assert list(v) == want


def test_buckets_are_the_same_split_in_one_task_or_over_all(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(600, 6)))], "id long, v array<double>")
    whole, spread = ({r.id: r.bucket for r in H.bounded_buckets(df, "id", "v", 16, group=g).collect()} for g in (8192, 64))
    assert whole == spread and len(whole) == 600 and max(np.unique(list(whole.values()), return_counts=True)[1]) <= 16


def test_merge_tree_is_one_tree(spark, data):
    t = Tables(spark, data)
    rows = H.merge_tree(t.embeddings, "vec_id", "embedding", 16).collect()
    parents = {r.node: r.parent for r in rows}
    assert len(parents) == len(rows) and sum(p is None for p in parents.values()) == 1
    assert sum(r.leaf for r in rows) == t.embeddings.count()
    for node in parents:
        seen = set()
        while parents[node] is not None:
            assert node not in seen and parents[node] in parents
            seen.add(node)
            node = parents[node]


def test_merge_tree_of_near_vectors():
    parent = H._merge_tree(np.array([[1, 0], [0, 1], [0.99, 0.01], [-1, 0]], dtype=float))
    assert parent[0] == parent[2] and parent.count(-1) == 1


def test_clusters_cover_all_rows(spark, data):
    for name in ("h1_mixture_clusters", "h2_gap_clusters"):
        rows = entry.queries()[name](spark, data).collect()
        assert len({r.vec_id for r in rows}) == len(rows) == Tables(spark, data).embeddings.count()


def test_summary_layers_end_in_one_row(spark, data):
    rows = entry.queries()["h9_summary_layers"](spark, data).collect()
    last = max(r.layer for r in rows)
    assert sum(r.layer == last for r in rows) == 1


def brute_ancestors(rows, depth, n_ranks, budget):
    """Nearest preceding titles by plain loops, for one document of ``(rank, tokens, line)``."""
    used, chunks = set(), []
    for rank in range(depth):
        for j, (r, _, _) in enumerate(rows):
            if r != rank or j in used:
                continue
            path = [j]
            if rank + 1 != n_ranks - 1:
                for up in range(rank + 1, n_ranks):
                    earlier = [i for i in range(j) if rows[i][0] == up]
                    if not earlier:
                        continue
                    if earlier[-1] > path[-1]:
                        path.pop()
                    path.append(earlier[-1])
            used.update(path)
            used.add(j)
            chunks.append(sorted(path))
    out, size = [], None
    for path in chunks:
        n = sum(rows[i][1] for i in path)
        if len(path) == 1 and (size is None or n + size < budget):
            if size is None:
                out.append([])
                size = 0
            out[-1].append(rows[path[0]][2])
            size += n
        else:
            out.append([rows[i][2] for i in path])
            size = n if len(path) == 1 else budget
    return ["\n".join(c) for c in out]


def test_ancestor_chunks_match_brute_force(spark):
    rng = random.Random(11)
    docs = {d: [(rng.choice([0, 0, 0, 1, 2, 3]), rng.randint(1, 90)) for _ in range(rng.randint(1, 25))] for d in range(12)}
    lines = {d: [(r, n, " ".join([f"w{d}x{i}"] * n)) for i, (r, n) in enumerate(rows)] for d, rows in docs.items()}
    df = spark.createDataFrame([(d, i, r, line) for d, rows in lines.items() for i, (r, n, line) in enumerate(rows)], "doc_id long, pos long, rank int, line string")
    got = {}
    for r in C.ancestor_chunks(df, "doc_id", "rank", 3, 5).orderBy("doc_id", "pos").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for d, rows in lines.items():
        assert got.get(d, []) == brute_ancestors(rows, 3, 5, 218), d


def test_neighbour_context_cuts_at_sentences(spark):
    rows = [(1, 0, "One two. Three four five.", 5, "text"), (1, 1, "x | y", 2, "table"), (1, 2, "Six seven. Eight.", 3, "text")]
    df = spark.createDataFrame(rows, "doc_id long, pos long, line string, n int, kind string")
    got = {(r.side): r.part for r in L.neighbour_context(df, "doc_id", "pos", "line", "n", "kind", 2).collect()}
    assert got == {"above": "Three four five.", "below": "Six seven. "}


def test_cursor_ignores_failed_batches(spark):
    log = spark.createDataFrame([("2024-01-02", 5, 0), ("2024-01-09", 5, 2)], "ts string, rows long, failed long")
    assert I.cursor(log).first().cursor == "2024-01-02"


def test_stream_equals_batch(spark, data):
    t = Tables(spark, data)
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    path = I.stage_files(events, F.to_date("ts"))
    streamed = I.upsert_batches(I.file_stream(spark, path, events.schema, 4), "user_id", "event_id")
    batch = RUN.latest(events, "user_id", F.col("event_id"))
    assert sorted(map(str, streamed.select("user_id", "event_id").collect())) == sorted(map(str, batch.select("user_id", "event_id").collect()))


def test_sql_session_refuses_changes(spark):
    s = Q.SqlSession(spark, row_limit=3)
    s.view("numbers", spark.range(10).toDF("n"), scope=F.col("n") < 8)
    assert s.run("select n from numbers").count() == 3
    assert s.run("select max(n) as m from numbers where 1 = 1").first().m == 7
    for bad in ("delete from numbers", "INSERT into numbers values (1)", "drop view numbers", "create table x as select 1"):
        with pytest.raises(Q.RefusedStatement):
            s.run(bad)


def test_free_names_skip_taken_counters(spark):
    new = spark.createDataFrame([(i, "a.txt") for i in range(4)] + [(9, "b.txt")], "id long, name string")
    taken = spark.createDataFrame([("a.txt",), ("a(2).txt",)], "name string")
    got = {r.id: r.free_name for r in K.free_names(new, taken, "name", "id").collect()}
    assert got == {0: "a(1).txt", 1: "a(3).txt", 2: "a(4).txt", 3: "a(5).txt", 9: "b.txt"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_predicates_reach_the_scan(spark, data):
    from corpusloom.functions import predicates as P

    t = Tables(spark, data)
    df = P.native_filter(t.orders, [{"key": "o_totalprice", "op": ">", "value": "100000"}]).select("o_orderkey")
    text = plan(df)
    assert "GreaterThan(o_totalprice" in text and "o_orderpriority" not in text


def test_top_k_prunes_before_the_shuffle(spark, data):
    t = Tables(spark, data)
    assert plan(RUN.top_k(t.events, "event_type", [F.col("value").desc()], 3)).count("WindowGroupLimit") == 2


def test_no_cross_joins_in_search(spark, data):
    for name in ("r3_full_text_match", "r12_token_similarity", "n8_duplicate_candidates", "g12_retrieval_metrics"):
        text = plan(entry.queries()[name](spark, data))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_unit_vectors(spark):
    got = spark.range(1).select(VEC.unit(F.array(F.lit(3.0), F.lit(4.0))).alias("u")).first().u
    assert got == [0.6, 0.8]


def test_merged_metadata_over_a_union_of_repartitioned_inputs(spark, data):
    t = Tables(spark, data)
    row = lambda pos, value, is_list: t.documents.select(
        "doc_id", F.lit(pos).alias("pos"), F.lit(0).alias("idx"), F.lit("k").alias("key"), F.lit(value).alias("value"), F.lit(is_list).alias("is_list"))
    out = entry_merge(row(1, "gone", False).unionByName(row(2, "a", True)).unionByName(row(3, "b", False)))
    n = t.documents.count()
    assert sorted((r["value"], r["count"]) for r in out.groupBy("value").count().collect()) == [("a", n), ("b", n)]


def entry_merge(entries):
    from corpusloom.operators.aggregates import merge_metadata

    return merge_metadata(entries)


def test_json_is_opened_to_any_depth(spark):
    def leaves(v, path=""):
        if isinstance(v, dict):
            return [x for k in sorted(v) for x in leaves(v[k], f"{path}.{k}" if path else k)]
        if isinstance(v, list):
            return [x for i, w in enumerate(v) for x in leaves(w, f"{path}.{i}" if path else str(i))]
        return [(path, json.dumps(v))]

    def nested(depth, v):
        for i in range(depth):
            v = {"k": v, "n": i} if i % 3 else [v, "x"]
        return v

    bodies = [nested(d, {"a": 1, "b": [True, "q"]}) for d in (0, 1, 3, 4, 5, 10, 25)] + [{}, [], {"a": {}, "b": [[]]}, 7]
    rows = [(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(99, None)]
    docs = spark.createDataFrame(rows, "id long, body string").select("id", F.parse_json("body").alias("v"))
    got = {r.id: r.leaves and [tuple(x) for x in r.leaves] for r in C.json_leaves(docs, "id", "v").collect()}
    assert got.pop(99) is None
    assert {k: v or [] for k, v in got.items()} == {i: leaves(b) for i, b in enumerate(bodies)}
    assert C.json_leaves(docs.filter("id < 0"), "id", "v").count() == 0
    chunks = C.split_json(C.json_leaves(docs.filter("id = 6"), "id", "v"), "id", "leaves", 120, 50).collect()
    parts = [x for c in sorted(chunks, key=lambda c: c.pos) for x in json.loads(c.text).items()]
    assert [(k, json.dumps(v)) for k, v in parts] == leaves(bodies[6])


def test_children_meet_the_id_of_their_parent_and_not_its_text(spark):
    parents = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "no child"), (4, "c"), (4, "d"), (None, "n")], "doc long, body string")
    children = spark.createDataFrame([(1, "x", "a"), (1, "y", "b"), (2, "z", "a"), (4, "w", "c"), (None, "v", "n")], "doc long, id string, line string")
    found = L.with_parents(children, parents, "doc", "id", "body", "line")
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    wanted = [("x", md5("a b"), 1, "a"), ("y", md5("a b"), 1, "b"), ("z", md5("a b"), 1, "a"), ("w", md5("c"), 1, "c"), ("w", md5("d"), 1, "c")]
    wanted += [(md5(b), None, 0, b) for b in ("a b", "c", "d")]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, wanted))
    # Above the projection that makes the id, the children's join knows no parent text.
    plan = found.filter("available = 1")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(plan) if "md5(" in line)
    assert any("Join Inner" in line for line in plan[:made]) and not any("body#" in line for line in plan[:made])


def test_pagerank_of_a_hub_and_parallel_edges_over_bunches_of_links(spark):
    n = 5_000
    edges = spark.range(n).select(F.concat(F.lit("L"), "id").alias("src"), F.lit("HUB").alias("dst"), (F.col("id") % 3 + 1).cast("double").alias("weight"))
    edges = edges.unionByName(edges.filter("weight = 1")).unionByName(edges.filter("weight = 2").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    sizes = G._dealt(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight").filter("src = 'HUB'"), F.lit(1)).groupBy("src", "bunch").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] > 100 and sizes[1] < 100  # the hub is many short rows
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    got = {r.name: r.pagerank for r in G.pagerank(nodes, edges, 3).collect()}
    weight = {f"L{i}": (2.0, 4.0, 3.0)[i % 3] for i in range(n)}
    total, hub, leaf = sum(weight.values()), 1 / (n + 1), dict.fromkeys(weight, 1 / (n + 1))
    for _ in range(3):
        hub, leaf = 0.85 * sum(leaf.values()) + 0.15 / (n + 1), {k: 0.85 * hub * w / total + 0.15 / (n + 1) for k, w in weight.items()}
    assert abs(got["HUB"] - hub) < 1e-12 and all(abs(got[k] - v) < 1e-12 for k, v in leaf.items())


def test_random_walks_over_a_hub_draw_by_weight_and_form_no_row_for_each_neighbour(spark):
    """40 000 walkers at a hub of 20 000 neighbours: a row for each of them and neighbour would be 800 million rows a step."""
    n = 20_000
    edges = spark.range(n).select(F.concat(F.lit("L"), "id").alias("src"), F.lit("HUB").alias("dst"), F.when(F.col("id") < n // 2, 1.0).otherwise(3.0).alias("weight"))
    begin = time.time()
    ends = G.random_walks(edges, 2, 3).filter("name <> 'HUB'").select(F.size("path").alias("n"), F.get("path", F.lit(1)).alias("hub"), F.expr("cast(substr(path[2], 2) as long)").alias("leaf"))
    row = ends.agg(F.count("*").alias("rows"), F.min("n").alias("n"), F.count_if(F.col("hub") == "HUB").alias("hub"), F.count_if(F.col("leaf") >= n // 2).alias("heavy"), F.count_distinct("leaf").alias("leaves")).first()
    assert (row["rows"], row["n"], row["hub"]) == (2 * n, 3, 2 * n)
    assert abs(row["heavy"] / (2 * n) - 0.75) < 0.015
    # A light leaf is missed with probability e^-1, a heavy one with e^-3.
    assert abs(row["leaves"] / n - (1 - (math.exp(-1) + math.exp(-3)) / 2)) < 0.02
    assert time.time() - begin < 120


def test_random_walks_use_the_heavier_of_parallel_edges_and_never_one_without_weight(spark):
    edges = spark.createDataFrame([("A", "B", 1.0), ("B", "A", 2.0), ("A", "B", 0.5), ("A", "A", 3.0), ("A", "C", 0.0)], "src string, dst string, weight double")
    walks = G.random_walks(edges, 400, 2).collect()
    assert not [r for r in walks if r["name"] == "C"] and all(len(r["path"]) == 2 for r in walks)
    share = sum(r["path"][1] == "A" for r in walks if r["name"] == "A") / 400
    assert abs(share - 0.6) < 0.08


def test_phrase_boost_sends_asked_pairs_only(spark, monkeypatch):
    weighted = spark.createDataFrame([(1, 0, "a", 0.5), (1, 1, "b", 0.3), (1, 2, "c", 0.2), (2, 0, "c", 1.0), (3, 0, "b", 0.6), (3, 1, "a", 0.4), (4, 0, "a", 0.7), (4, 1, "b", 0.3)], "query_id long, pos int, term string, weight double")
    texts = [(1, "a b c"), (2, "a x b a b"), (3, "b"), (4, None), (5, "x y z"), (6, "a x x b a"), (7, ""), (None, "b c"), (7, "c a"), (7, "b c")]
    chunks = spark.createDataFrame(texts, "chunk long, text string")
    words, want = {1: ["a b", "b c"], 3: ["b a"], 4: ["a b"]}, {}
    weight = {(1, "a b"): 1.0, (1, "b c"): 0.6, (3, "b a"): 1.2, (4, "a b"): 1.4}
    monkeypatch.setattr(V, "MATCH_CELLS", 4)
    for size in (1 << 20, 1):
        monkeypatch.setattr(V, "TERM_BLOCK", size)
        for slop in (0, 2):
            want = {}
            for chunk, text in texts:
                t = (text or "").split()
                held = {f"{x} {y}" for i, x in enumerate(t) for y in t[i + 1:i + 2 + slop]}
                for q in words:
                    for p in words[q]:
                        if p in held:
                            want[(q, chunk)] = want.get((q, chunk), 0) + weight[(q, p)]
            rows = V.phrase_boost(weighted, chunks, "chunk", slop=slop)
            assert {(r.query_id, r.chunk): round(r.phrase_score, 9) for r in rows.collect()} == {k: round(v, 9) for k, v in want.items()}
    # No list of all pairs of a text is exploded into rows.
    assert "Generate" not in rows._jdf.queryExecution().optimizedPlan().toString()


ODD_TEXTS = ["The cat, the CAT\tsat", "", None, "  ", "日本語 text 42x", "Ünï code-é Σς", "a\x00b\x1fc_d", "one\ntwo one", "K 東a京", "the end"]


def test_asked_terms_agree_with_the_whole_corpus(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS + ODD_TEXTS[:2])], "doc_id long, text string")
    asked = spark.createDataFrame([("the",), ("cat",), ("one",), ("é",), ("日",), ("k",), ("c",), ("absent",), ("the",)], "term string")
    once = asked.distinct()
    stats = V.term_statistics(docs, "doc_id").join(once, "term", "left_semi").select("term", "df", "cf")
    assert sorted(map(tuple, V.asked_statistics(docs, asked).collect())) == sorted(map(tuple, stats.collect())) and stats.count() == 7
    fields = {"title_tks": F.split("text", "\n")[0], "content_ltks": F.col("text")}
    whole = V.field_postings(docs, "doc_id", {n: X.tokens(c) for n, c in fields.items()}).join(once, "term", "left_semi").select("doc_id", "field", "term", "first")
    assert sorted(map(tuple, V.asked_postings(docs, "doc_id", fields, asked).collect())) == sorted(map(tuple, whole.collect()))
    vectors = docs.select("doc_id", VEC.hash_embedding(F.col("text")).alias("vector"))
    assert sorted(map(str, S.hashed_vectors(docs, "doc_id").collect())) == sorted(map(str, vectors.collect()))


def test_hybrid_search_makes_tokens_for_pool_chunks_only(spark):
    docs = spark.createDataFrame([(i, f"w{i} common x{i % 3}") for i in range(40)], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "w7 common x1"), (2, "w8 common")], "query_id long, text string")
    weighted = V.term_weights(V.query_terms(queries), V.term_statistics(docs, "doc_id")).localCheckpoint()
    hits = weighted.filter(F.col("term").startswith("w")).select("query_id", F.substring("term", 2, 9).cast("long").alias("doc_id"), F.lit(1.0).alias("score"))
    tokens = lambda rows: rows.select("doc_id", X.tokens(F.col("text")).alias("tokens"))
    vectors = S.hashed_vectors(docs, "doc_id")
    asked = queries.select("query_id", VEC.hash_embedding(F.col("text")).alias("vector"))
    seen = []

    def pool_tokens(ids):
        seen.extend(r[0] for r in ids.collect())
        return tokens(docs.join(ids, "doc_id", "left_semi"))

    some = V.hybrid_search(weighted, hits, asked, vectors, "doc_id", pool=3, pool_tokens=pool_tokens)
    every = V.hybrid_search(weighted, hits, asked, vectors.join(tokens(docs), "doc_id"), "doc_id", pool=3)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.collect()))
    assert 0 < len(seen) <= 6 and len(set(seen)) == len(seen)


def test_weights_of_whole_texts_with_few_terms_sent_to_the_tasks(spark):
    """Frequent terms by broadcast and the others by shuffle have the weights of the plain join, also of texts whose id repeats, and tokens are not shuffled."""
    rng = random.Random(19)
    words = [f"w{i}" for i in range(200)] + ["12", "ab", "7-x"]
    rows = [(i // 2 if i < 6 else None if i == 9 else i, " ".join(rng.choices(words, k=rng.randint(1, 60), weights=[1 / (j + 1) for j in range(len(words))]))) for i in range(40)] + [(50, None), (51, "")]
    docs = spark.createDataFrame(rows, "query_id long, text string")
    stats = V.term_statistics(docs.filter("query_id % 7 <> 3"), "query_id")
    weights = lambda got: sorted((r.query_id, r.pos, r.term, round(r.weight, 12)) for r in got.collect())
    plain = weights(V.term_weights(V.positions(docs, "query_id", X.tokens(F.col("text"))), stats))
    for frequent in (0, 8, 1000):
        assert weights(V.term_weights(V.positions(docs.repartition("query_id"), "query_id", X.tokens(F.col("text"))), stats, frequent=frequent)) == plain
    best = V.keyword_query(V.term_weights(V.positions(docs.repartition("query_id"), "query_id", X.tokens(F.col("text"))), stats, frequent=8), 5)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(query_id#\d+L, \d+\)", plan)) <= 3  # the texts twice (one is reused when run), and the maps of rare terms
    assert {(r.query_id, r.rank) for r in best.collect()} >= {(0, 1), (7, 1)}


@pytest.mark.parametrize("block, cells", [(1 << 20, 1 << 20), (7, 50)])
def test_token_similarity_makes_no_row_for_a_feature(spark, monkeypatch, block, cells):
    """All chunks that share a feature, as a join of the features scores them, with null and repeated ids, null texts and blocks of few features."""
    monkeypatch.setattr(V, "TERM_BLOCK", block)
    monkeypatch.setattr(V, "MATCH_CELLS", cells)
    rng = random.Random(20)
    words = lambda n: " ".join(rng.choices([f"w{i}" for i in range(25)], k=n))
    queries = [(i if i else None, words(rng.randint(1, 6))) for i in range(9)] + [(20, "nowhere")]
    docs = spark.createDataFrame([(i // 2 if i < 8 else None if i == 9 else i, None if i == 11 else words(rng.randint(0, 20))) for i in range(40)], "doc_id long, text string")
    weighted = V.term_weights(V.query_terms(spark.createDataFrame(queries, "query_id long, text string")), V.term_statistics(docs, "doc_id")).localCheckpoint()
    chunks = docs.select("doc_id", X.tokens(F.col("text")).alias("tokens"))
    asked = V.similarity_features(weighted)
    features = chunks.select("doc_id", F.explode(V.chunk_features(F.col("tokens"))).alias("feature"))
    covered = asked.join(features, "feature").groupBy("query_id", "doc_id").agg(F.sum("weight").alias("s"))
    want = covered.join(asked.groupBy("query_id").agg(F.sum("weight").alias("q")), "query_id").select("query_id", "doc_id", (F.col("s") + 1e-9) / (F.col("q") + 1e-9))
    found = V.token_similarity(weighted, chunks, "doc_id")
    rows = lambda df: sorted((r[0], -1 if r[1] is None else r[1], round(r[2], 12)) for r in df.collect())
    assert rows(found) == rows(want) and want.count() > 100
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    # Given pairs, zeros included: a chunk of many queries is several rows, one without text has null.
    monkeypatch.setattr(V, "PAIR_ROWS", 3)
    ids = [r[0] for r in docs.select("doc_id").distinct().collect()]
    pairs = spark.createDataFrame([(q, d) for q, _ in queries for d in [*ids, 999]], "query_id long, doc_id long")
    sums = asked.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("feature", "weight"))).alias("w"), F.sum("weight").alias("q"))
    both = pairs.join(sums, "query_id").join(chunks.select("doc_id", V.chunk_features(F.col("tokens")).alias("f")), "doc_id")
    inside = F.aggregate(F.array_intersect(F.map_keys("w"), "f"), F.lit(0.0), lambda s, x: s + F.element_at("w", x))
    values = lambda df: sorted((r[0], r[1], -1 if r[2] is None else round(r[2], 12)) for r in df.collect())
    some = values(V.token_similarity(weighted, chunks, "doc_id", pairs=pairs))
    assert some == values(both.select("query_id", "doc_id", (inside + 1e-9) / (F.col("q") + 1e-9))) and -1 in {r[2] for r in some}
