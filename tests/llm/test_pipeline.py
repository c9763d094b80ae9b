"""The pipeline stage by stage against plain Python on awkward rows."""

from collections import Counter

import corpus_pipeline
from corpusloom.llm import quality
from tests.llm import brute


def collected(df):
    return [r.asDict() for r in df.collect()]


def test_stages(spark, cases):
    folder, rows, bench, _ = cases
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert len(corpus_pipeline.STAGES) == 5
    kept = corpus_pipeline.quality_rules(spark, docs, folder).cache()
    want = {}
    for i, text, *_ in rows:
        verdict = quality.judge(text, quality.LineRules())
        if verdict[7]:
            want[i] = verdict[8]
    assert {r["doc_id"]: r["text"] for r in collected(kept)} == want and kept.columns == columns
    single = corpus_pipeline.ngram_jaccard(spark, kept, folder).cache()
    groups = brute.groups(sorted(want.items()), 5, 4, 5)
    left = {i for i in want if groups[i][1] == i}
    assert Counter(r["doc_id"] for r in collected(single)) == Counter(left) and single.columns == columns
    assert len(left) < len(want)
    clean = corpus_pipeline.benchmark_decontamination(spark, single, folder).cache()
    dirty = {w[0] for w in brute.contamination([(i, want[i]) for i in left], bench) if w[-1]}
    assert {r["doc_id"] for r in collected(clean)} == left - dirty and dirty and clean.columns == columns
    path = f"{folder}-clean"
    clean.write.mode("overwrite").parquet(path)
    clean = spark.read.parquet(path)
    mixed = corpus_pipeline.source_mix(spark, clean, folder)
    path = f"{folder}-mixed"
    mixed.write.mode("overwrite").parquet(path)
    mixed = spark.read.parquet(path)
    assert mixed.columns == columns
    copies = Counter(r["doc_id"] for r in collected(mixed))
    assert max(copies.values()) <= 2 and set(copies) <= left - dirty
    placed = collected(corpus_pipeline.shards(spark, mixed, folder))
    assert Counter(r["doc_id"] for r in placed) == copies
    sizes = Counter(r["shard"] for r in placed)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(24)) <= 1


def test_repeated_rows_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(90))
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (2, text, "b"), (3, "other " + text[:150], "c"), (None, text, "d")], "doc_id long, text string, extra string")
    got = collected(corpus_pipeline.ngram_jaccard(spark, docs, ""))
    assert sorted(r["doc_id"] for r in got) == [1, 3] and got[0].keys() == {"doc_id", "text", "extra"}


def test_groups_are_told_apart_by_their_texts(spark):
    """Null ids and ids that repeat do not make one group of different texts."""
    text = [" ".join(f"{c}{i}" for i in range(90)) for c in "abcdef"]
    near = [t.replace("89", "x") for t in text]
    rows = [(None, text[0]), (None, text[1]), (None, near[1]), (None, text[2]), (None, text[2]), (7, text[3]), (7, text[4]), (8, near[4]), (None, near[4]), (None, text[5]), (9, near[5]), (None, ""), (None, None)]
    got = collected(corpus_pipeline.ngram_jaccard(spark, spark.createDataFrame(rows, "doc_id long, text string"), ""))
    kept = Counter((r["doc_id"], r["text"]) for r in got)
    assert sum(kept[None, t] for t in (text[1], near[1])) == 1
    for t in (text[1], near[1]):
        kept.pop((None, t), None)
    assert kept == Counter([(None, text[0]), (None, text[2]), (7, text[3]), (7, text[4]), (9, near[5]), (None, ""), (None, None)])


def test_run_over_the_tables(spark, data):
    rows = collected(corpus_pipeline.run(spark, data))
    assert rows and {"doc_id", "shard", "slot"} <= rows[0].keys()


def test_run_over_empty_tables(spark, empty):
    assert collected(corpus_pipeline.run(spark, empty)) == []
