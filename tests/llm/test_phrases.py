"""Phrase mining against plain counting, on awkward texts, with small blocks, and with bitmaps too small to tell phrases apart."""

import random

import pytest

from corpusloom.llm import phrases
from tests.llm import brute

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def texts(rng, n):
    words = [f"w{i}" for i in range(30)] + ["É", "don't", "a-b", "X", "x"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = [None, "", " \t", "...", "one", "One TWO", "w1\tw2 w3.w1 w2\x0bw3", "x" * 5000 + " w1 w2 " + "y z " * 3000]
    for _ in range(n):
        w = rng.choices(words, weights, k=rng.randrange(1, 60))
        out.append("".join(x + rng.choice([" ", " ", " ", " \t ", ". ", ",", "\n"]) for x in w))
    return out


@pytest.mark.parametrize("case", ["plain", "small blocks", "full bitmaps", "late phrases"])
def test_counts_match(spark, monkeypatch, case):
    rng = random.Random(4)
    if case == "small blocks":
        monkeypatch.setattr(phrases, "BLOCK", 7)
        monkeypatch.setattr(phrases, "HELD", 20)
    if case == "full bitmaps":
        monkeypatch.setattr(phrases, "MIN_BITS", 32768)
        monkeypatch.setattr(phrases, "MAX_BITS", 32768)
        monkeypatch.setattr(phrases, "_marks", lambda keys, bits: keys[0].astype("int64") & 7)
    docs = [(rng.choice(["en", "en", "en", "de", None, "und"]), t) for t in texts(rng, 120)]
    if case == "late phrases":  # reach the threshold only in their last shard
        monkeypatch.setattr(phrases, "BLOCK", 40)
        docs += [("en", f"rare{i} pair{i} more{i} end") for i in range(20) for _ in range(5)] * 1
        rng.shuffle(docs)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, k int, word string").repartition(3)
    got = [tuple(r[n] for n in NAMES) for r in phrases.collocations(df, least=5, longest=4, top=40).collect()]
    assert sorted(got) == sorted(brute.collocations(docs, 5, 4, 50, 40)) and got


def test_nothing(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).columns == list(NAMES) and phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).count() == 0
