import random

import pytest

import __spark_entry__ as entry

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, size=4000):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def cases(tmp_path_factory, spark):
    """A folder with small tables of awkward rows: nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(7)
    passage = words(rng, 70)
    bench = [words(rng, 30), words(rng, 13), words(rng, 5), "", None, words(rng, 14)]
    texts = [None, "", "  \n ", "one", "one two", "One TWO", "É é " * 30, "a b a b a b a b " * 30]
    long = words(rng, 30_000)
    texts += [long, long]
    for k in range(40):
        base = words(rng, rng.randrange(60, 200))
        texts.append(base)
        for _ in range(k % 4):
            w = base.split()
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"w{rng.randrange(4000)}"
            texts.append(" ".join(w))
        if k % 3 == 0:
            texts.append(base)
        if k % 5 == 0:
            texts.append(words(rng, 40) + " " + passage + "\n" + words(rng, 60))
        if k % 7 == 0:
            texts.append(words(rng, 90) + " " + (bench[k % 2] or "").upper() + ", " + words(rng, 40))
        if k % 9 == 0:
            texts.append(words(rng, 80) + ". " + bench[2] + ". " + words(rng, 10))
    texts += [
        "card 4111 1111 1111 1111 and 4111111111111111 4111111111111111 mail a.b@c.example.org, ip 10.0.0.300 1.2.3.4, call +1 (212) 555-0187 now",
        "Released under the MIT License.\n" + words(rng, 60), "Licensed under the Apache License, Version 2.0", "a general public license b mit license mit license",
        "Licensed under CC BY-NC 4.0.", "MIT. License? general public apache", words(rng, 20) + "\n" + "Home | About | Shop | Blog | Login\n" * 10, words(rng, 80) + "\nHome | About | Shop | Blog\nAll rights reserved.",
    ]
    rows = [(i, t, "en", ["b", "a", None, "c", "a"][i % 5], 0 if t is None else len(t)) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("cases")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    html = [None, "", "<p>a</p>", "<p>a</p>", "x" * 200_000 + "é" * 50_000, "WARC/1.1\r\n\r\n\r\nWARC-Type: x", "<p>a</p>", "é" * 40_000, "0\r\n\r\n"]
    spark.createDataFrame([(9 - i, f"http://h/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string").coalesce(2).write.parquet(f"{folder}/pages.parquet")
    talk = [(c, t, ["system", "user", "assistant", None][(c + t) % 4], ["Yes.", "No", None, "Why?"][c * t % 4]) for c in range(12) for t in range(c)]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").coalesce(2).write.parquet(f"{folder}/conversations.parquet")
    return str(folder), rows, list(enumerate(bench)), [(9 - i, h) for i, h in enumerate(html)]


@pytest.fixture(scope="session")
def empty(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("pages", "page_id long, url string, html string"), ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def run(spark):
    def rows(name, folder):
        return [r.asDict() for r in entry.queries()[name](spark, folder).collect()]

    return rows
