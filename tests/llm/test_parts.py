"""Parts of the operators on their own: sequences, windows, draws, records, tags, schemes."""

import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, decontamination, jaccard, licenses, lm, passages, pii, quality, sharding, warc


def test_words_are_hashed_alike_wherever_they_stand():
    a, at = common.hash_words([b"The cat\tsat", b"", b"on THE  cat\n"])
    b, _ = common.hash_words([b"x" * 3_000_000 + b" the cat sat on " + b"y" * 200_000])
    assert at.tolist() == [0, 3, 3, 6]
    assert a[0] == a[4] == b[1] and a[1] == a[5] == b[2] and a[2] == b[3] and a[3] == b[4]
    assert len({int(x) for x in b}) == 6


def test_shingles_stay_inside_texts():
    words, first = common.hash_words([b"a b c d", b"a b", b"", b"b c d"])
    s, at = common.hash_shingles(words, first, 3)
    assert np.diff(at).tolist() == [2, 1, 0, 1] and s[1] == s[3] and len(set(s.tolist())) == 3


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 5), (10, 20), (5000, 1 << 64), (9000, 1 << 24), (4096, 1 << 40)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
    e = lm.EliasFano(v, universe)
    q = np.sort(np.concatenate([v, rng.integers(0, universe, 1000, dtype=np.uint64)]))
    index, equal = e.successors(q)
    assert (index == np.searchsorted(v, q)).all() and (equal == np.isin(q, v)).all()
    assert (e.at(np.arange(len(v))) == v).all()


def test_quantised_counts_are_near():
    c = np.concatenate([np.arange(300), [10**4, 10**5]])
    assert np.abs(lm.restored(lm.quantise(c)) - c).max() <= 0.035 * 10**5 and (lm.restored(lm.quantise(np.arange(64))) == np.arange(64)).all()


def test_no_count_saturates():
    c = np.array([5 * 10**6, 2 * 10**7, 10**8, 2**40, 2**63 - 1])
    level = lm.PairLevel(np.arange(len(c), dtype=np.uint64) << np.uint64(24), c)
    got = lm.restored(level.ask(np.arange(len(c), dtype=np.uint64) << np.uint64(24)))
    assert np.abs(got / c - 1).max() <= 0.001
    small = np.arange(1024)
    assert (lm.restored(lm.quantise(small)) == small).all()


def test_compact_windows_are_the_cartesian_tree():
    rng = np.random.default_rng(3)
    for trial in range(60):
        lens = rng.integers(0, 60, rng.integers(1, 6))
        first = np.concatenate([[0], np.cumsum(lens)])
        h = rng.integers(1 << 33, 1 << 63, int(first[-1]), dtype=np.uint64)
        if trial % 2:
            h = (h >> np.uint64(58)) << np.uint64(58) | np.uint64(1 << 40)
        least = int(rng.integers(1, 20))
        want = set()
        for d in range(len(lens)):
            x = (h[first[d] : first[d + 1]] >> np.uint64(32)).tolist()
            for i in range(len(x)):
                a = b = i
                while a > 0 and x[a - 1] > x[i]:
                    a -= 1
                while b + 1 < len(x) and x[b + 1] >= x[i]:
                    b += 1
                if b - a + 1 >= least:
                    want.add((first[d] + a, first[d] + i, first[d] + b))
        assert set(zip(*passages.compact_windows(h, first, least))) == want


def test_matching_parts_keep_the_similarity():
    same = np.array([True] * 60 + [False] + [True] * 60 + [False] * 30 + [True] * 20)
    assert passages.matching_parts(same, 5, 50, 0.8) == [(0, 121, 112)]
    assert passages.matching_parts(same[:49], 5, 50, 0.8) == []


@pytest.mark.parametrize("similarity", [Fraction(9, 10), Fraction(4, 5)])
def test_similar_sets_share_a_signature(similarity):
    rng = np.random.default_rng(1)
    schemes = jaccard.Schemes(similarity)
    for size in [1, 2, 5, 9, 10, 11, 20, 33, 60, 150, 400, 1200]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            worst = math.floor(len(a) * (1 - similarity) / (1 + similarity))  # replaced items
            b = np.unique(np.concatenate([a[worst:], rng.integers(0, 1 << 63, worst, dtype=np.uint64)]))
            c = a[math.floor(len(a) * (1 - similarity)) :]  # the smallest subset
            for other in (b, c):
                assert len(np.intersect1d(a, other)) >= similarity * len(np.union1d(a, other))
                assert np.intersect1d(schemes.signatures(a), schemes.signatures(other)).size


@pytest.mark.parametrize("kind", ["chain", "stars", "random", "none"])
def test_components(spark, kind):
    rng = np.random.default_rng(4)
    edges = {"chain": [(i, i + 1) for i in range(300)], "stars": [(9, -i) for i in range(200)] + [(500, 500 + i) for i in range(50)], "random": rng.integers(0, 400, (260, 2)).tolist(), "none": []}[kind]
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([tuple(map(int, e)) for e in edges] * 2, "a long, b long")
    rows = [tuple(r) for r in common.components(frame).collect()]
    assert sorted(rows) == sorted((n, find(n)) for n in root)


def test_common_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 80), dtype=np.uint64)) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    off = ~np.eye(30, dtype=bool)  # a set is not compared with itself
    assert (jaccard.common_counts(sets, 0) == want)[off].all() and (jaccard.common_counts(sets, 12) == want[:12, 12:]).all()


@pytest.mark.parametrize("similarity", [Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)])
def test_sketches_lose_no_similar_pair(similarity):
    rng = np.random.default_rng(6)
    sets = []
    for size in [1, 2, 7, 31, 32, 33, 60, 64, 65, 250, 900, 3000]:
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for share in (0, 0.05, 0.1, 0.2, 0.3, 0.6):
            cut = int(share * size)
            sets += [np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, cut, dtype=np.uint64)])), a[cut:]]
    n = np.array([len(s) for s in sets])
    both = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    similar = both >= similarity * (n[:, None] + n[None, :] - both)
    bits = [jaccard.sketch(s) for s in sets]
    may = jaccard.may_be_similar(bits, n, bits[5:], n[5:], similarity)
    assert may[similar[:, 5:]].all()
    far = both[:, 5:] < float(similarity) * 0.8 * (n[:, None] + n[None, 5:] - both[:, 5:])
    # The lower the similarity, the more bits may differ, and the less a sketch tells.
    assert may[far & (n[:, None] > 50)].mean() < (0.02 if similarity >= Fraction(4, 5) else 0.05)


def test_parts_of_marked_pairs_are_joined():
    rng = np.random.default_rng(7)
    for _ in range(30):
        n = int(rng.integers(1, 40))
        hit = rng.random((n, n)) < 0.03
        hit |= hit.T | np.eye(n, dtype=bool)
        part = np.arange(n)
        for _ in range(n):
            part = np.array([part[hit[i]].min() for i in range(n)])
        ids = np.arange(n)
        least = {int(i): int(i) for i in ids} | {b: a for a, b in jaccard.joined(hit, ids, ids)}
        assert least == dict(enumerate(part.tolist()))


def test_large_clusters_are_compared_in_blocks(spark, monkeypatch, tmp_path):
    from tests.llm import brute

    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "SKETCH_BLOCK", 2048)
    monkeypatch.setattr(jaccard, "STRIP", 3)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(0, 120))] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_groups(docs, size=3, similarity=Fraction(9, 10)).collect()}
    assert got == brute.groups(rows, 3, 90, 100)


def test_hypergeometric_draws(spark):
    n, total, good, drawn = 20_000, 60, 25, 14
    u = common.uniform(F.col("id"))
    got = spark.range(n).select(sharding.hypergeometric(*[F.lit(x).cast("long") for x in (total, good, drawn)], u).alias("x")).groupBy("x").count().collect()
    p = {k: math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn) for k in range(drawn + 1)}
    found = {r["x"]: r["count"] for r in got}
    assert set(found) <= set(p)
    chi = sum((found.get(k, 0) - n * p[k]) ** 2 / (n * p[k]) for k in p if n * p[k] > 5)
    assert chi < 45  # about 13 degrees of freedom


def test_communication_matrix_has_the_sums_it_must(spark):
    counts = [(p, r) for p, r in zip(range(300), itertools.cycle([7, 0, 1000, 33, 1]))]
    rows = sharding.communication_matrix(spark.createDataFrame(counts, "part long, rows long"), 24, 3).collect()
    assert {r["part"]: sum(r["line"]) for r in rows} == {p: n for p, n in counts if n}
    columns = [sum(c) for c in zip(*(r["line"] for r in rows))]
    assert max(columns) - min(columns) <= 1 and min(min(r["line"]) for r in rows) >= 0


def test_shards_keep_columns_with_clashing_names(spark):
    docs = spark.range(1000).select("id", F.lit("x").alias("__at"), F.lit("y").alias("__rank")).repartition(5)
    out = sharding.shuffle_into_shards(docs, 7, stable=False)
    assert out.columns == ["id", "__at", "__rank", "shard", "slot"] and out.select("id").distinct().count() == 1000
    first = [r["id"] for r in out.filter("shard = 0").orderBy("slot").collect()]
    again = [r["id"] for r in sharding.shuffle_into_shards(docs, 7, seed=9, stable=False).filter("shard = 0").orderBy("slot").collect()]
    assert first != sorted(first) and first != again


def test_chunked_framing():
    data = bytes(range(256)) * 70
    assert warc.unchunk(warc.chunked(data, 1000)) == data and warc.unchunk(warc.chunked(b"", 10)) == b""
    with pytest.raises(ValueError):
        warc.unchunk(warc.chunked(data, 1000)[:-900])


def test_segments_that_are_missing_or_wrong_are_faults(spark, tmp_path):
    payload = "z" * 100_000
    digest = warc.base64.b32encode(warc.hashlib.sha1(payload.encode()).digest()).decode()
    whole = warc.records_of(1, 1, "u", payload, digest, None, 32 << 10, 8 << 10)
    lost = warc.records_of(2, 2, "u", payload, digest, None, 32 << 10, 8 << 10)
    wrong = warc.records_of(3, 3, "u", payload, "A" * 32, None, 1 << 20, 8 << 10)
    records = whole[::-1] + lost[:1] + lost[2:] + wrong
    (tmp_path / "part-0.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in records))
    got = {warc_id(r["origin"]): (r["fault"], r["payload"] and len(r["payload"])) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {1: (None, 100_000), 2: ("segments missing", None), 3: ("digest differs", None)}


def warc_id(origin):
    return int(origin.split(":")[2])


def test_field_learns_its_examples():
    lines = pii.examples()
    field = pii.train([pii.tagged_line(t, s) for t, s in lines])
    wrong = sum(field_tags(field, t) != pii.tagged_line(t, s)[1] for t, s in lines)
    assert wrong <= 1
    assert ("card", 5, 21) in pii.tagged_spans(["card 4111111111111111 4111111111111111 there"], field)[0]
    assert pii.tagged_spans(["pages 12 and 14 of 1999, 3.5 kg, 42%", ""], field) == [[], []]


def field_tags(field, text):
    words, _ = pii.tagged_line(text, [])
    plain = np.full(len(pii.TAGS), -1e9)
    plain[0] = 0
    scores = np.array([[plain if pii.shape(w) == "plain" else field.scores(w) for w in words]])
    return pii.viterbi(field, scores, np.array([False]), np.array([False]))[0].tolist()


def test_line_rules():
    rules = quality.LineRules()
    fails = lambda s: quality.line_fails(s, s.split(), rules)
    assert fails("Home | About | Shop | Blog") and fails("*** ### ***") and fails("Accept all cookies to go on") and fails("----")
    assert not fails("A sentence with a | in it, and nothing else.") and not fails("Kurz.")
    assert quality.repeated_words("a b c a b c d".split()) == 6 and quality.repeated_words("a b c d".split()) == 0


def test_cleaned_documents_keep_their_columns(spark):
    good = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, good + "\nHome | About | Shop | Blog", 5), (2, "*** | *** | *** | ***", 6), (3, None, 7)], "doc_id int, text string, __quality int")
    rows = quality.clean_documents(docs).collect()
    assert [tuple(r) for r in rows] == [(1, good, 5)]


def test_licenses_of_a_file_with_several(spark):
    """Labels and scores against all positions of each template, in files that bundle licenses."""
    rng = np.random.default_rng(8)
    texts = [t.text for t in licenses.TEMPLATES]
    files = ["\n".join(texts), "\n".join(texts[::-1])]
    for _ in range(40):
        parts = [texts[i] for i in rng.permutation(len(texts))[: rng.integers(2, 6)]]
        for k, part in enumerate(parts):
            w = part.split()
            for _ in range(int(rng.integers(0, 8))):
                w[int(rng.integers(0, len(w)))] = "other"
            parts[k] = " ".join(w[int(rng.integers(0, 3)) :])
        files.append(" filler and words ".join(parts))
    files += ["permission is hereby granted " * 30, "of free and the in"] * 5
    docs = spark.createDataFrame(list(enumerate(files)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs).collect():
        w, labels, best = licenses.words_in(files[r["doc_id"]]), set(filter(None, r["base_labels"].split(","))), 0.0
        for t in licenses.TEMPLATES:
            own, key = licenses.words_in(t.text), licenses.words_in(t.key)
            at = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
            for s in range(-at, len(w)):
                if w[s + at : s + at + len(key)] == key:
                    score = sum(0 <= s + j < len(w) and w[s + j] == x for j, x in enumerate(own)) / len(own)
                    best = max(best, score)
                    labels |= {t.label} if score >= 0.6 else set()
        assert (r["labels"], r["score"]) == (",".join(sorted(labels)), pytest.approx(best))


def edited(rng, words, every, kind):
    """``words`` with one word inserted or deleted after each ``every`` words."""
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1 and i + 1 < len(words):
            if kind == "insert":
                out += [w, f"n{rng.integers(0, 10**9)}"]
        else:
            out.append(w)
    return out


@pytest.mark.parametrize("kind", ["insert", "delete"])
def test_passages_with_words_inserted_or_deleted(spark, kind):
    """Planted near copies whose token sets are similar by a brute-force count are found over their diagonals."""
    rng = np.random.default_rng(11)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    token_set = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, planted = [], {}
    for k in range(60):
        passage = text((70, 60, 400)[k % 3])
        copy = edited(rng, passage, (35, 30, 49)[k % 3], kind)
        both = token_set(passage) & token_set(copy)
        rows += [(2 * k, " ".join(text(int(rng.integers(0, 300))) + passage + text(40))), (2 * k + 1, " ".join(text(int(rng.integers(0, 300))) + copy + text(40)))]
        if len(both) >= 0.8 * len(token_set(passage) | token_set(copy)):
            planted[2 * k, 2 * k + 1] = len(passage)
    got = {}
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        a, b = (r["doc_id"], r["start_word"], r["n_words"]), (r["other_id"], r["other_start"], r["other_words"])
        x, y = (token_set(rows[i][1].split()[s : s + n]) for i, s, n in (a, b))
        assert min(r["n_words"], r["other_words"]) >= 50 and len(x & y) >= 0.8 * len(x | y)
        pair = tuple(sorted((r["doc_id"], r["other_id"])))
        got[pair] = max(got.get(pair, 0), r["n_words"])
    assert set(got) <= {(2 * k, 2 * k + 1) for k in range(60)}
    assert len(planted) >= 40 and sum(got.get(p, 0) >= 0.8 * n for p, n in planted.items()) >= 0.9 * len(planted)


def test_passages_of_texts_with_a_common_shorter_run(spark):
    """Of 200 texts that hold the same 46 words, 60 pairs share six more: each such pair is connected by passages."""
    rng = np.random.default_rng(13)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    common = text(46)
    rows = []
    for _ in range(60):
        before, after = text(3), text(3)
        rows += [text(int(rng.integers(20, 200))) + before + common + after + text(40) for _ in range(2)]
    rows += [text(100) + common + text(40) for _ in range(80)]
    # The name's first text also has it a second time, and there it shares 50 words with another text.
    end = text(4)
    rows += [common + text(60) + common + end + text(30), text(60) + common + end + text(30)]
    got = passages.repeated_passages(spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")).collect()
    linked = {frozenset((r["doc_id"], r["other_id"])) for r in got}
    pairs = {frozenset((2 * k, 2 * k + 1)) for k in range(60)} | {frozenset((200, 201))}
    assert pairs <= linked
    assert all(r["kind"] == "passage" and r["n_words"] >= 50 for r in got)


def test_common_run_is_in_every_similar_passage():
    """Of passages with words changed, added or left out at the most distant places, the longest common run is never shorter."""
    assert passages.common_run(46, 5, 0.8) == 21 and passages.common_run(46, 5, 1) == 46
    rng = np.random.default_rng(15)
    for _ in range(2000):
        n = int(rng.integers(50, 200))
        x = list(range(n))
        y = list(x)
        for at in sorted(rng.choice(np.arange(5, n - 5), int(rng.integers(1, 5)), replace=False).tolist(), reverse=True):
            y[at : at + 1] = ([-at], [at, -at], [])[int(rng.integers(0, 3))]
        own, other = ([tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in (x, y))
        both = set(own) & set(other)
        if min(len(own), len(other)) < 46 or len(both) < 0.8 * len(set(own) | set(other)):
            continue
        longest = now = 0
        for t, u in zip(own, own[1:] + [None]):
            now = now + 1 if t in both else 0
            longest = max(longest, now)
        assert longest >= 21


def test_passages_of_the_least_similarity_are_all_found(spark):
    """No passage of 50 words with one other word in it is lost, nor one that two of nine texts share whose other texts have a part of it."""
    rng = np.random.default_rng(14)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    rows, pairs = [], set()
    for _ in range(300):
        left, right = text(25), text(24)
        pairs.add(frozenset((len(rows), len(rows) + 1)))
        rows += [text(int(rng.integers(0, 60))) + left + text(1) + right + text(5) for _ in range(2)]
    for _ in range(20):
        common, end = text(30), [text(24) for _ in range(4)]
        order = rng.permutation(9).tolist()
        pairs |= {frozenset((len(rows) + order[i], len(rows) + order[i + 4])) for i in range(4)}
        of = {order[i + j]: end[i] for i in range(4) for j in (0, 4)}
        rows += [text(int(rng.integers(0, 60))) + common + text(1) + of.get(i, text(24)) + text(5) for i in range(9)]
    got = passages.repeated_passages(spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")).collect()
    assert {frozenset((r["doc_id"], r["other_id"])) for r in got} == pairs
    assert all(r["n_words"] >= 50 for r in got)


def test_names_that_many_texts_and_batches_share(spark):
    """A name of many texts, read in batches of few rows, keeps its exact passages connected and links no text to itself."""
    rng = np.random.default_rng(16)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    common, rows = text(40), []
    for _ in range(40):
        before = text(12)
        rows += [text(int(rng.integers(0, 30))) + before + common + text(20) for _ in range(2)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = passages.repeated_passages(spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    linked = {frozenset((r["doc_id"], r["other_id"])) for r in got}
    assert linked == {frozenset((2 * k, 2 * k + 1)) for k in range(40)}


def test_tile_pairs_lose_no_pair_with_enough_tokens():
    """What :func:`tile_pairs` leaves out has too few common tokens by the exact count, with rare, common and repeated tokens."""
    rng = np.random.default_rng(18)
    common = rng.integers(0, 10**6, 30)
    rows = [np.concatenate([common[: int(rng.integers(0, 31))], rng.integers(0, 40, int(rng.integers(0, 60))), rng.integers(0, 10**6, 40)]).astype(np.int32) for _ in range(70)]
    rows += [np.full(60, 7, np.int32), np.zeros(0, np.int32)]
    bits = [(passages.token_hashes(r, 1) >> np.uint64(48)).astype(np.uint16) for r in rows]
    left, right = np.arange(40), np.arange(30, len(rows))
    got = passages.tile_pairs(bits, left, right, 20)
    want = np.array([[passages.common_tokens([rows[i]], [rows[j]], 1).min() >= 20 for j in right] for i in left])
    assert got[want].all() and want.any() and not want.all() and got.sum() <= want.sum() + 5


@pytest.mark.parametrize("tile", [2048, 7])
def test_similar_passages_of_names_with_many_classes(spark, monkeypatch, tile):
    """Two of 60 texts with a common part share a similar passage: all such pairs are found, wherever the two lie among the others."""
    monkeypatch.setattr(passages, "TILE", tile)
    rng = np.random.default_rng(17)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    rows, pairs = [], set()
    for _ in range(3):
        common, order, base = text(30), rng.permutation(60).tolist(), len(rows)
        ends = [text(24) for _ in range(20)]
        of = {order[i + j]: ends[i] for i in range(20) for j in (0, 20)}
        pairs |= {frozenset((base + order[i], base + order[i + 20])) for i in range(20)}
        rows += [text(int(rng.integers(0, 60))) + common + text(1) + of.get(i, text(24)) + text(5) for i in range(60)]
    got = passages.repeated_passages(spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")).collect()
    assert {frozenset((r["doc_id"], r["other_id"])) for r in got} == pairs
    assert all(r["n_words"] >= 50 for r in got)


def test_proximity_matches_are_all_found(spark):
    """Matches against every place of every window: edits of rare words, words that no document has, short items."""
    rng = np.random.default_rng(12)
    text = lambda n: [f"w{int(i)}" for i in rng.zipf(1.3, n) % 500]
    items = [text(n) for n in (13, 20, 5, 7, 1, 2)] + [text(6) + ["unknown"] + text(6), text(4) + ["no", "one"] + text(8)]
    docs = []
    for k in range(60):
        item = list(items[k % len(items)])
        for _ in range(k % 4):
            item[int(rng.integers(0, len(item)))] = f"x{k}"
        docs.append((k, " ".join(text(int(rng.integers(0, 30))) + ["known" if w in ("unknown", "no") else w for w in item] + text(3))))
    wins = {tuple(w[i : i + 13]) for w in items for i in range(max(len(w) - 12, 1))}
    want = set()
    for i, t in docs:
        w = t.split()
        for win in wins:
            for s in range(len(w)):
                same = sum(a == b for a, b in zip(w[s:], win))
                if same >= 0.8 * len(win):
                    want.add((i, s, " ".join(win), same))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found, _ = decontamination.find_matches(frame, bench)
    got = {(r["doc_id"], m["start"], m["phrase"], m["same"]) for r in found.collect() for m in r["matches"] or []}
    assert got == want and sum(same < len(p.split()) for _, _, p, same in want) >= 20


def test_addresses_of_any_length():
    """No integer is made of unbounded digits, and a megabyte of digits is read once."""
    import time

    from corpusloom.llm import pii

    assert pii.base_spans("1.1.1." + "0" * 5000) == [("ip", 0, 5006)] and pii.holds("ip", "1.1.1." + "0" * 5000)
    assert pii.base_spans("1.1.1." + "9" * 5000) == [] and not pii.holds("ip", "1.1.1." + "9" * 5000)
    begin = time.time()
    for text in ("7" * 1_000_000, "0" * 1_000_000, "." * 1_000_000):
        assert [s for s in pii.base_spans(text) if s[0] == "ip"] == []
    assert time.time() - begin < 10
