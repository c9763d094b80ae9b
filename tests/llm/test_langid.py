"""Language identification: held-out accuracy, the network against a plain loop, awkward texts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusloom.llm import langid


def plain(net, text):
    """The answer for one text, filter by filter and byte by byte."""
    data = text.encode().lower()
    total = np.zeros(len(net.langs))
    for a in range(0, len(data), langid.WINDOW):
        window = data[a : a + langid.WINDOW]
        x = net.bytes[list(window.ljust(langid.WINDOW + max(langid.WIDTHS) - 1, b"\0"))]
        hidden = []
        for f in range(net.filters.shape[1]):
            width = langid.WIDTHS[f // langid.FILTERS]
            kernel = net.filters[: width * langid.DIM, f].reshape(width, langid.DIM)
            hidden.append(max(max(float((x[i : i + width] * kernel).sum()) for i in range(langid.WINDOW)) + net.shift[f], 0))
        z = np.exp(np.array(hidden) @ net.out + net.bias)
        total += z / z.sum() * len(window)
    return total / len(data)


@pytest.fixture(scope="module")
def net(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    return langid.learn(docs, ~langid.is_held_out(F.col("doc_id")), per_lang=60)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = entry.queries()["op11_language_id"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)


def test_awkward_texts(spark, net):
    texts = [None, "", " 12 + 3!", "é", "the", "the", "The cat sat on the mat and looked at the door.", "x" * 127, "y" * 128, "z" * 129, "\0", "words and more words " * 20_000]
    df = spark.createDataFrame([(i, t, "x", 1, 2.0, "q") for i, t in enumerate(texts)] + [(None, "the", None, 1, 2.0, "q")], "doc_id long, text string, lang string, c0 int, score double, letter string").repartition(2)
    rows = langid.identify(df, net, ["doc_id", "c0"]).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, [*range(len(texts)), None]))
    for r in rows:
        text = "the" if r["doc_id"] is None else texts[r["doc_id"]]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == (langid.UNKNOWN, 0)
            continue
        assert r["lang_pred"] in net.langs and 0 <= r["score"] <= 1
        if len(text) < 1000:
            want = plain(net, text)
            assert r["score"] == pytest.approx(want.max(), abs=1e-4) and r["lang_pred"] == net.langs[int(want.argmax())]


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "Some text.", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    assert langid.learn(none, F.lit(True)) is None
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(none, None, ["doc_id"]).collect()} == {(langid.UNKNOWN, 0.0)}


def test_the_sample_is_bounded(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(langid, "train", lambda texts, labels: sizes.append((len(texts), max(map(len, texts)))))
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("abc "), 1000), "id").alias("text"), F.when(F.col("id") < 450, "hot").otherwise("cold").alias("lang"))
    langid.learn(docs, F.lit(True), per_lang=20, excerpts=3)
    langid.learn(docs, F.lit(True), per_lang=20, sample=15, excerpts=3)
    assert sizes == [(120, 2 * langid.WINDOW), (45, 2 * langid.WINDOW)]
