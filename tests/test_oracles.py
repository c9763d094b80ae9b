"""Every registered query has an oracle or a test here; a spread of them runs by default, ORACLES=all runs them all."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom.registry import QUERIES
from tools.check import TABLES, rows_of

SAMPLE = (
    "s7_row_documents s12_upsert p5_metadata_filter p21_routing j17_tree_walk g7_metadata_summary g15_ranking_metrics w2_fifo_eviction w11_largest_remainder "
    "w13_collision_names t4_rerank_window x13_short_token_merge x33_citation_repair k1_token_merge_overlap k8_markdown_elements k21_title_tree r3_full_text_match "
    "r6_exact_vector_top_k r16_full_retrieval e4_cached_enrichment n7_pagerank n8_duplicate_candidates n9_connected_components n21_graph_search_relations "
    "h3_centroid_refinement i2_cursor_advance q2_json_sql"
).split()
NO_ORACLE = {
    "k23_ancestor_merge", "r7_approximate_vector_top_k", "e2_batch_embedding", "n13_hierarchical_communities", "n24_node_embeddings", "h1_mixture_clusters",
    "h2_gap_clusters", "h5_bounded_buckets", "h6_merge_tree", "h9_summary_layers",
}


def test_registry_is_complete():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(QUERIES) - set(oracles) == NO_ORACLE
    sizes = {"s": 20, "p": 29, "j": 17, "g": 27, "w": 13, "t": 11, "x": 38, "k": 31, "r": 28, "e": 10, "n": 28, "h": 11, "i": 13, "q": 9}
    have = {name.split("_")[0] for name in queries}
    assert not [f"{a}{i}" for a, n in sizes.items() for i in range(1, n + 1) if f"{a}{i}" not in have]


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ORACLES") == "all" else SAMPLE)
def test_query_matches_oracle(spark, duck, data, name):
    df = entry.queries()[name](spark, data)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
