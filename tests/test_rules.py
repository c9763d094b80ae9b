"""Rules that a second run, a refused statement or an odd row must not break."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chunking, enrich, graph as G, ranking, sqlapi as Q, vector_search as S
from corpusloom.streaming import incremental as I


@pytest.fixture
def guarded(spark, tmp_path):
    spark.sql("drop table if exists guarded_rows")
    spark.range(50).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("guarded_rows")
    s = Q.SqlSession(spark, row_limit=5)
    s.view("guarded_view", spark.range(50))
    yield s
    spark.sql("drop table if exists guarded_rows")


@pytest.mark.parametrize("statement", [
    "create table guarded_new as select 1 as a", "with x as (select 1L as id) insert into guarded_rows select * from x", "/* c */ insert into guarded_rows values (1L)",
    "-- c\ndrop view guarded_view", "drop table guarded_rows", "delete from guarded_rows", "set spark.sql.ansi.enabled = false", "create or replace temp view guarded_view as select 1 as id",
    "truncate table guarded_rows", "from (select 1L as id) insert into guarded_rows select id", "explain select 1", "cache table guarded_rows",
])
def test_refused_statements_change_nothing(spark, guarded, statement):
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(Q.RefusedStatement):
        guarded.run(statement)
    assert guarded.run_all(statement) == []
    assert spark.table("guarded_rows").count() == 50 and spark.table("guarded_view").count() == 50
    assert not spark.catalog.tableExists("guarded_new") and spark.conf.get("spark.sql.ansi.enabled") == ansi


@pytest.mark.parametrize("statement", ["select * from guarded_view where 'limit' = 'limit'", "select * from (select * from guarded_view limit 30)", "with x as (select * from guarded_view) select * from x", "(select * from guarded_view) union all (select * from guarded_view)"])
def test_no_result_passes_the_row_limit(guarded, statement):
    assert guarded.run(statement).count() == 5
    assert guarded.run("select * from guarded_view limit 3").count() == 3


def test_statements_are_split_outside_quotes(guarded):
    frames = guarded.run_all("select 'a;b' as x; select \"c;'d\" as x -- no; end\n; /* a; b */ select id as `x;y` from guarded_view where id = 7; delete from guarded_rows;")
    assert [f.first()[0] for f in frames] == ["a;b", "c;'d", 7]


def test_a_second_run_reads_only_what_is_new(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(1000).write.parquet(f"{source}/a")
    schema = spark.range(1).schema
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    assert I.drain_to_table(stream(), path=sink).count() == 1000
    seen = []
    I.drain(stream(), lambda df, i: seen.append(df.count()), str(tmp_path / "check"))
    I.drain(stream(), lambda df, i: seen.append(df.count()), str(tmp_path / "check"))
    assert seen == [1000]
    spark.range(1000, 1010).write.parquet(f"{source}/b")
    got = I.drain_to_table(stream(), path=sink)
    assert got.count() == 1010 and got.select("id").distinct().count() == 1010
    assert sorted(r[0] for r in got.groupBy("batch").count().select("count").collect()) == [10, 1000]


def test_the_cursor_stays_before_the_first_failure(spark, tmp_path):
    log = str(tmp_path / "log")
    for i, (day, failed) in enumerate([("2024-01-01", False), ("2024-01-02", True), ("2024-01-03", False)]):
        batch = spark.sql(f"select timestamp '{day}' as ts, {str(failed).lower()} as failed")
        I.advance_cursor(spark, log, batch, i, "ts", F.col("failed"))
    row = I.cursor(spark.read.parquet(log)).first()
    assert (str(row["cursor"])[:10], row["rows"], row["failed"]) == ("2024-01-01", 3, 1)


def test_repair_leaves_no_row_out(spark):
    rows = spark.range(2000).withColumn("f", F.lit(None).cast("string"))
    assert I.repair(rows, "id", "f", F.lit("x"), [F.col("id")]).filter("f is null").count() == 0
    assert I.repair(rows, "id", "f", F.lit("x"), [F.col("id")], 512).filter("f is null").count() == 2000 - 512


def test_retention_stream_counts_a_replayed_message_once(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "memory_id long, id long, valid_at long, size long"
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, i, i, 10) for i in range(8)], schema).coalesce(1).write.parquet(f"{source}/a")
    stream = lambda: I.retention_stream(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source), 50)
    try:
        first = I.drain_to_table(stream(), "append", path=str(tmp_path / "out"))
        assert sorted(r["id"] for r in first.collect()) == [0, 1, 2]
        spark.createDataFrame([(1, 7, 7, 10), (1, 8, 8, 10)], schema).coalesce(1).write.parquet(f"{source}/b")
        again = I.drain_to_table(stream(), "append", path=str(tmp_path / "out"))
        assert sorted(r["id"] for r in again.collect()) == [0, 1, 2, 3]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_missing_vectors_are_near_to_nothing(spark):
    schema = "query_id long, vector array<double>"
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], schema)
    items = spark.createDataFrame([(1, [1.0, 0.1]), (2, None), (3, [0.0, 1.0])], "item_id long, vector array<double>")
    assert [(r["query_id"], r["item_id"]) for r in S.nearest(queries, items, 1).collect()] == [(1, 1)]
    ragged = spark.createDataFrame([(1, [1.0, 0.1]), (2, [1.0])], "item_id long, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        S.nearest(queries, ragged, 1).collect()


def test_approximate_search_returns_k_rows(spark):
    rng = random.Random(1)
    items = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)], "item_id long, vector array<double>")
    queries = items.limit(5).select(F.col("item_id").alias("query_id"), "vector")
    got = S.nearest_approximate(queries, items, 10, bucket_length=0.05, tables=1)
    assert {r["query_id"]: r["count"] for r in got.groupBy("query_id").count().collect()} == {r["query_id"]: 10 for r in queries.collect()}


def test_a_cycle_of_parents_raises(spark):
    with pytest.raises(ValueError):
        ranking.ancestors(spark.createDataFrame([(1, 2), (2, 1)], "id long, parent long"))


def test_long_chains_are_one_component(spark):
    chain = spark.range(300).select(F.format_string("n%04d", "id").alias("src"), F.format_string("n%04d", F.col("id") + 1).alias("dst"))
    assert {r["component"] for r in G.components(chain).collect()} == {"n0000"}


def test_communities_beat_label_propagation(spark):
    rng = random.Random(3)
    edges = set()
    for c in range(6):
        for _ in range(40):
            a, b = rng.sample(range(12), 2)
            edges.add((f"{c}-{min(a, b):02d}", f"{c}-{max(a, b):02d}"))
    edges |= {(f"{c}-00", f"{(c + 1) % 6}-05") for c in range(6)}
    frame = spark.createDataFrame([(a, b, 1.0) for a, b in sorted(edges)], "src string, dst string, weight double")
    found = G.modularity_communities(frame)
    near: dict[str, list[str]] = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    label = {n: n for n in near}
    for _ in range(30):  # plain label propagation: the most frequent label of the neighbours, ties to the least
        for n in sorted(near):
            counts = [label[m] for m in near[n]]
            label[n] = min(counts, key=lambda x: (-counts.count(x), x))
    other = spark.createDataFrame(sorted(label.items()), "name string, community string")
    ours, theirs = (G.modularity(frame, labels).first()[0] for labels in (found, other))
    assert ours >= theirs - 0.02 and ours > 0.6


def test_a_large_cluster_is_summarised_from_whole_texts(spark):
    texts = [(i, "c", f"Opening words number {i} here. " + "Shared closing sentence about storms.") for i in range(300)]
    out = enrich.cluster_summary(spark.createDataFrame(texts, "id long, cluster string, text string"), "cluster", "id", "text", 1).first()
    assert out["sentence"].startswith("Shared closing sentence")


def test_folds_cross_block_borders(spark):
    rng = random.Random(5)
    lines = [" ".join("abc" for _ in range(rng.randrange(1, 9))) for _ in range(3 * chunking.FOLD_BLOCK + 17)]
    want, open_, n = [], [], 0
    for line in lines:
        if open_ and n > 40:
            want.append("".join(open_))
            open_, n = [], 0
        open_.append("\n" + line)
        n += len(line.split())
    want.append("".join(open_))
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    assert [r["text"] for r in chunking.merge_sections(docs, "doc_id", "text", 40).orderBy("pos").collect()] == want


def test_names_are_compared_in_tiles(spark, monkeypatch):
    """Few pairs are left to compare by edit distance, whatever the tiles; the result is that of comparing all pairs."""
    monkeypatch.setattr(G, "TILE", 16)
    rng = random.Random(11)
    stems = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 12))) for _ in range(120)]
    names = stems + [s[:-1] + "q" for s in stems[:40]] + ["中文名字", "中文名", "名字", "a", "b", "ab", "x 1", "x 2", "Ünal", "", None] + stems[:5]
    df = spark.createDataFrame([(n, "hot" if i % 3 else "cold") for i, n in enumerate(names)] + [("abc", None)], "name string, block string")
    d = df.filter("name is not null and block is not null").distinct()
    every = d.alias("p").join(d.alias("q"), "block").filter(F.col("p.name") < F.col("q.name")).select("block", F.col("p.name").alias("a"), F.col("q.name").alias("b"))
    want = {tuple(r) for r in every.filter(G.names_similar(F.col("a"), F.col("b"))).collect()}
    assert {tuple(r) for r in G.similar_names(df, "name", "block").collect()} == want and len(want) > 20
    assert G.similar_candidates(df, "name", "block").count() < 0.3 * every.count()
