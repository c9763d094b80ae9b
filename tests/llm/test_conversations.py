"""Conversation repair against a uniform-cost search, on random, awkward and very long conversations."""

import random

import pytest

import __spark_entry__ as entry
from corpusloom.llm import conversations
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def agree(spark, rows, folder, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    got = [r.asDict() for r in entry.queries()["op13_conversation_repair"](spark, str(folder)).collect()]
    want = {c: brute.repair(own) for c, own in brute.damaged([r[:4] for r in rows]).items()}
    assert len(got) == len(want)
    for r in got:
        c = r.pop("conv_id")
        assert r == want[c], c
    return got


def draw(rng, conv, n, roles=("user", "assistant", "system", "user", "assistant", "tool", "", None)):
    texts = ["Yes.", "No!", "Why?", "well", "", " \n", None, "So. ", "é?", "Ends.\t"]
    return [(conv, rng.choice([None, t, t, t, t + 3]), rng.choice(roles), rng.choice([*texts, f"Line {t}.", f"Line {t}.", f"Line {t}"])) for t in range(n)]


def test_random_conversations(spark, tmp_path):
    rng = random.Random(3)
    rows = [r for c in range(400) for r in draw(rng, c, rng.randrange(0, 14))]
    rows += [(None, t, "user", f"Null {t}.") for t in range(5)] + [(1000 + c, 0, "user", "Alone.") for c in range(60)]
    got = agree(spark, rows, tmp_path)
    assert any(r["audit"] == "" and r["cost"] == 0 for r in got) and {c for r in got for c in r["audit"]} == set("DIKR")


@pytest.mark.parametrize("kind", ["mixed", "one role", "alternating", "one text"])
def test_conversations_of_many_chunks(spark, tmp_path, monkeypatch, kind):
    """Chunks of four rows: costs cross many chunks, also where one role never lets them converge."""
    monkeypatch.setattr(conversations, "CHUNK", 4)
    rng = random.Random(5)
    if kind == "mixed":
        rows = [r for c in (1, 2, 3) for r in draw(rng, c, 150)]
    elif kind == "one role":
        rows = [(c, t, "user", f"Line {t}.") for c in (1, 2) for t in range(100 + c)]
    elif kind == "alternating":
        rows = [(1, t, ["user", "assistant"][t % 2], f"Line {t}.") for t in range(201)] + [(2, t, ["assistant", "user"][t % 2], f"Line {t}") for t in range(90)]
    else:
        rows = [(1, 7, "user", "Same.")] * 150 + [(1, t, "assistant", f"Line {t}.") for t in range(20)]
    agree(spark, rows, tmp_path)


def test_search_is_the_same_for_any_cut():
    """A chunk's table, put behind others, gives the costs of the whole."""
    rng = random.Random(9)
    for _ in range(200):
        codes = [rng.randrange(4) + rng.choice([0, 0, 0, 4, 8, 16]) for _ in range(rng.randrange(2, 40))]
        cut = rng.randrange(1, len(codes))
        whole = conversations.chunk_vectors(codes, (conversations.CLOSING,) * 4)
        right = conversations.chunk_vectors(codes[cut:], (conversations.CLOSING,) * 4)
        assert conversations.rerun(conversations.chunk_vectors(codes[:cut], conversations.SPECULATIVE), right) == whole


def test_nothing_and_extra_columns(spark, tmp_path):
    assert agree(spark, [], tmp_path / "a") == []
    rows = [(1, t, "user", "Hi.", "x", 3, 4) for t in range(3)]
    agree(spark, rows, tmp_path / "b", SCHEMA + ", c string, g long, pos long")


def test_messages_are_those_of_the_audit(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "More")]
    _, messages = conversations.repair_conversations(spark.createDataFrame(rows, SCHEMA))
    got = messages.collect()
    assert "".join(r["edit"] for r in got) == brute.repair([r[1:] for r in rows])["audit"]
    assert "".join(r["role"][0] for r in got if r["role"]) in ("", "ua", "uaua")
    assert all((r["role"] is None) == (r["edit"] == "D") and (r["text"] == "" or r["edit"] != "I") for r in got)
