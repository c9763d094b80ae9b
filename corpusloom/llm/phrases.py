"""Phrase collocations by dynamic itemset counting: phrases of several lengths are counted in the same cyclic scans of shards.

The words are cut once into ``SHARDS`` shards. Scan ``t`` reads shard ``t mod SHARDS`` only. Words are counted from the first scan; a longer
phrase is active in the scans after both its subphrases (without its last word, without its first) have reached the threshold,
and stays so until it has been through one full cycle: a shard's occurrences are counted in the first scan of the shard that finds the phrase
active and passed over in later ones, so each occurrence is counted once and every count is exact. The scans end when all shards
have been read since a subphrase last reached the threshold.

What has reached the threshold is told to the tasks as a bitmap of hashed phrases. Its size comes from the number of words and is at most
``MAX_BITS`` bits; it stays the same and bits are only added, so a phrase that is active once stays active. A false hit only
activates a phrase too early: it is counted in full like any other and falls below the threshold at the end. Each
task combines its counts before they are shuffled by phrase, so no word, phrase or language makes a hot group. Phrases that are through
below the threshold leave the counts.

Words are 64-bit hashes of language and bytes until the end (two words of one language that share a hash would count as one; the
chance is about n * n / 2 ** 65); the dictionary joins their texts to the candidates. Products are decimals of 38 digits: exact for counts up to 10 ** 16.

Null text is empty, null language is ``und``; texts without words count nothing; a long text is read whole and cut into blocks that
overlap by the longest phrase; repeated rows count again; an empty table gives no phrases; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import hash_words, mix, removed, slices, stored
from corpusloom.session import scratch_path

#: Shards of a cycle.
SHARDS = 3
#: Words of a block, the unit that is put into a shard.
BLOCK = 1 << 16
#: Distinct phrases that a task holds before it passes its counts on.
HELD = 1 << 18
MIN_BITS, MAX_BITS = 1 << 20, 1 << 27

_ENDS = np.zeros(256, bool)  # what ends a piece
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _ENDS.copy()  # what lies between words
_GAPS[[0x20, 0x09]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shard_words(docs: DataFrame, lang: str, text: str, longest: int) -> DataFrame:
    """The stored words: blocks ``(shard, own, words, joined)``; under shard -1, the dictionary ``(h, word, lang)``; under -2, ``h`` words of a ``lang``.

    ``words`` are hashes, ``joined`` tells whether the next word is in the same piece; a phrase belongs to the block among whose first
    ``own`` words it begins.
    """
    schema = "shard int, own int, words binary, joined binary, h long, word string, lang string"
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [f.split()[0] for f in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        known = np.empty(0, np.uint64)  # words already passed on by this task, in order
        for batch in batches:
            for part, texts in slices(batch, "text", 1 << 20):
                raw = b"\n".join([*texts, b""]).lower()
                data = np.frombuffer(raw, np.uint8)
                gap = _GAPS[data]
                begins = ~gap
                begins[1:] &= gap[:-1]
                starts = np.flatnonzero(begins)
                if not len(starts):
                    continue
                hashes, first = hash_words(texts, _GAPS)
                row = np.repeat(np.arange(len(texts)), np.diff(first))
                hashes = mix(hashes ^ part.column("lang_hash").to_numpy().view(np.uint64)[row])
                piece = np.cumsum(_ENDS[data])[starts]
                joined = np.append(piece[1:] == piece[:-1], False)
                n = np.bincount(row, minlength=len(texts))
                for name, total in pa.table([part.column("lang"), pa.array(n)], names=["lang", "n"]).group_by("lang").aggregate([("n", "sum")]).to_pandas().itertuples(index=False):
                    values = [[-2], [None], [None], [None], [int(total)], [None], [name]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)
                distinct, at = np.unique(hashes, return_index=True)
                new = known[np.minimum(np.searchsorted(known, distinct), len(known) - 1)] != distinct if len(known) else np.ones(len(distinct), bool)
                if new.any():
                    ends = np.append(np.flatnonzero(gap), len(data))
                    at = at[new]
                    stop = ends[np.searchsorted(ends, starts[at])]
                    n = len(at)
                    langs = part.column("lang").take(pa.array(row[at]))
                    texts_of = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at], stop)], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, -1, np.int32)), *(pa.nulls(n, k) for k in kinds[1:4]), pa.array(distinct[new].view(np.int64)), texts_of, langs.cast(pa.string())], names=names)
                    known = np.sort(np.concatenate([known, distinct[new]]) if len(known) < 4 * HELD else distinct[new], kind="stable")
                for a in range(0, len(hashes), BLOCK):
                    b = min(a + BLOCK, len(hashes))
                    upto = min(b + longest - 1, len(hashes))
                    values = [[shard % SHARDS], [b - a], [hashes[a:upto].tobytes()], [joined[a:upto].tobytes()], [None], [None], [None]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)
                    shard += 1

    own = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(F.col(text).alias("text"), own.alias("lang"), F.xxhash64(own).alias("lang_hash"))
    path = scratch_path(docs.sparkSession, "shards")
    rows.mapInArrow(cut, schema).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _marks(keys: list[np.ndarray], bits: int) -> np.ndarray:
    """The bit of each phrase, given its words column by column."""
    h = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        h = mix(h * _STEP + k + np.uint64(1))
    return (h & np.uint64(bits - 1)).astype(np.int64)


def _bitmap(large: DataFrame, bits: int, length: int) -> bytes:
    """The bits of phrases of one length. At most ``MAX_BITS`` bits come to the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy().view(np.uint64) for i in range(length)]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_marks(keys, bits)))], names=["bit"])

    per = 32768  # bits of one value of bitmap_construct_agg
    rows = large.select(*[f"k{i}" for i in range(length)]).mapInArrow(places, "bit long").groupBy((F.col("bit") / per).cast("long").alias("bucket")).agg(F.bitmap_construct_agg(F.col("bit") % per).alias("bits")).collect()
    out = bytearray(bits // 8)
    for r in rows:
        at = r["bucket"] * per // 8
        out[at : at + per // 8] = r["bits"]
    return bytes(out)


def _scan(blocks: DataFrame, lengths: list[int], longest: int, sent) -> DataFrame:
    """``(k0, k1, ..., n)``: the phrases of these lengths in a shard that are active now and were not in the shard's last scan, counted per task.

    ``sent`` is a broadcast of two bitmaps (now, last scan) for each length of subphrases.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = {m: [None if b is None else np.frombuffer(b, np.uint8) for b in both] for m, both in sent.value.items()}
        held: dict[int, list[pa.Table]] = {m: [] for m in lengths}

        def fresh(m: int, keys: list[np.ndarray]) -> np.ndarray:
            """Whether both subphrases are in the first bitmap and not both in the second."""
            out = np.ones(len(keys[0]), bool)
            places = [_marks(sub, len(large[m][0]) * 8) for sub in (keys[:-1], keys[1:])]
            for bits, wanted in zip(large[m], (True, False)):
                if bits is not None:
                    hit = np.ones(len(keys[0]), bool)
                    for at in places:
                        hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                    out &= hit == wanted
            return out

        def combined(m: int) -> pa.Table:
            whole = pa.concat_tables(held[m])
            names = whole.column_names[:m]
            return whole.group_by(names, use_threads=False).aggregate([("n", "sum")]).rename_columns([*names, "n"])

        def passed(m: int) -> pa.RecordBatch:
            t = combined(m)
            keys = [t.column(i).combine_chunks() if i < m else pa.nulls(t.num_rows, pa.int64()) for i in range(longest)]
            return pa.RecordBatch.from_arrays([*keys, t.column("n").combine_chunks()], names=[*(f"k{i}" for i in range(longest)), "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("own")[i].as_py()
                words, joined = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in (("words", np.uint64), ("joined", bool)))
                for m in lengths:
                    last = min(own, len(words) - m + 1)
                    ok = np.ones(max(last, 0), bool)
                    for j in range(m - 1):
                        ok &= joined[j : j + len(ok)]
                    at = np.flatnonzero(ok)
                    keys = [words[at + j] for j in range(m)]
                    if m > 1 and len(at):
                        good = fresh(m - 1, keys)
                        keys = [k[good] for k in keys]
                    if not len(keys[0]):
                        continue
                    names = [f"k{j}" for j in range(m)]
                    t = pa.table([pa.array(k.view(np.int64)) for k in keys], names=names).group_by(names, use_threads=False).aggregate([([], "count_all")])
                    held[m].append(t.rename_columns([*names, "n"]))
                    if sum(x.num_rows for x in held[m]) > HELD:
                        held[m] = [combined(m)]
                        if held[m][0].num_rows > HELD // 2:
                            yield passed(m)
                            held[m] = []
        for m in lengths:
            if held[m]:
                yield passed(m)

    return blocks.select("own", "words", "joined").mapInArrow(count, ", ".join([f"k{i} long" for i in range(longest)]) + ", n long")


def _dictionary(words: DataFrame, bits: bytes) -> DataFrame:
    """``(h, word, lang)`` of the words that the bitmap has, each once. The bitmap keeps rare words from being shuffled."""
    sent = words.sparkSession.sparkContext.broadcast(bits)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            at = _marks([batch.column("h").to_numpy().view(np.uint64)], len(large) * 8)
            yield batch.filter(pa.array((large[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0))

    rows = words.filter("shard = -1").select("h", "word", "lang")
    return rows.mapInArrow(known, rows.schema).groupBy("h").agg(F.min("word").alias("word"), F.min("lang").alias("lang"))


def count_phrases(docs: DataFrame, least: int, longest: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(counts, dictionary, sizes)``: ``(k, n)`` of every phrase of up to ``longest`` words that occurs ``least`` times or more.

    ``k`` are the hashes of the phrase's words; dictionary: ``(h, word, lang)`` of its words; sizes: ``(lang, n)``, all words of a language.
    """
    spark = docs.sparkSession
    words = shard_words(docs, lang, text, longest)
    sizes = words.filter("shard = -2").groupBy("lang").agg(F.sum("h").alias("n"))
    total = words.filter("shard >= 0").agg(F.sum("own")).first()[0] or 0
    bits = MIN_BITS
    while bits < min(16 * total // least, MAX_BITS):
        bits *= 2
    keys = [f"k{i}" for i in range(longest)]
    length = sum((F.col(k).isNotNull().cast("int") for k in keys), F.lit(0))
    counts, path = None, None  # keys, start (the scan a phrase was first met in) and n, as far as counted
    large = dict.fromkeys(range(1, longest), 0)
    changed = {0: -1} | dict.fromkeys(range(1, longest), 0)  # the last scan that brought a phrase of this length to the threshold
    maps: list[dict[int, bytes]] = [{}]  # what had reached it before each scan
    t = 0
    while t <= max(changed.values()) + SHARDS:
        before = maps[t - SHARDS] if t >= SHARDS else {}
        # Words are read in the first cycle, longer phrases where the bitmap is not what the shard's last scan had.
        lengths = [m for m in range(1, longest + 1) if (t < SHARDS if m == 1 else m - 1 in maps[t] and maps[t][m - 1] is not before.get(m - 1))]
        now = dict(maps[t])
        if lengths:
            sent = spark.sparkContext.broadcast({m - 1: (maps[t][m - 1], before.get(m - 1)) for m in lengths if m > 1})
            seen = _scan(words.filter(F.col("shard") == t % SHARDS), lengths, longest, sent).withColumn("start", F.lit(t))
            merged = (seen if counts is None else seen.unionByName(counts)).repartition(*keys).groupBy(*keys).agg(F.min("start").alias("start"), F.sum("n").alias("n"))
            # Through a full cycle and below the threshold: never met again. Words are through after the first cycle.
            begun = F.col("start") if longest == 1 else F.when(F.col("k1").isNull(), 0).otherwise(F.col("start"))
            merged = merged.filter((F.col("n") >= least) | (begun > t - SHARDS + 1))
            old, path = path, scratch_path(spark, "counts")
            merged.write.option("parquet.enable.dictionary", "false").parquet(path)
            counts = spark.read.schema(merged.schema).parquet(path)
            if old:
                removed(spark, old)
            reached = {r["m"]: r["n"] for r in counts.filter(F.col("n") >= least).groupBy(length.alias("m")).agg(F.count("*").alias("n")).collect()}
            for m in range(1, longest):
                if reached.get(m, 0) != large[m]:
                    of_length = counts.filter((F.col("n") >= least) & (length == m))
                    large[m], changed[m], now[m] = reached[m], t, _bitmap(of_length, bits, m)
            sent.unpersist()
        maps.append(now)
        if t >= SHARDS:
            maps[t - SHARDS] = {}
        t += 1
    dictionary = _dictionary(words, maps[-1].get(1, bytes(MIN_BITS // 8)))
    return counts.filter(F.col("n") >= least).select(F.slice(F.array(*keys), F.lit(1), length).alias("k"), "n"), dictionary, sizes


def _exact(n: str | Column) -> Column:
    return F.col(n).cast("decimal(38,0)") if isinstance(n, str) else n.cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, share: int = 50, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase scores ``floor(1000000 a a / (l r))`` at the cut where that is least (the first of them). Phrases inside a longer one
    that has at least ``share`` hundredths of their occurrences are left out.
    """
    counts, dictionary, sizes = count_phrases(docs, least, longest, lang, text)
    counts = stored(counts, "phrases")
    phrases = counts.filter((F.size("k") > 1) & (F.col("n") >= least)).select("k", F.col("n").alias("a"))
    cuts = phrases.select("k", "a", F.explode(F.sequence(F.lit(1), F.size("k") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", F.slice("k", F.lit(1), F.col("cut"))).withColumn("right", F.slice("k", F.col("cut") + 1, F.size("k") - F.col("cut")))
    both = cuts.join(counts.select(F.col("k").alias("left"), F.col("n").alias("l")), "left").join(counts.select(F.col("k").alias("right"), F.col("n").alias("r")), "right")
    exact = both.withColumn("up", (_exact("a") * _exact("a") * F.lit(1_000_000)).cast("decimal(38,0)")).withColumn("down", (_exact("l") * _exact("r")).cast("decimal(38,0)"))
    scored = exact.withColumn("score", F.expr("cast(up div down as long)")).groupBy("k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # Contiguous subphrases of each longer candidate, with the most that one of them occurs.
    inner = phrases.filter(F.size("k") > 2).select("a", "k", F.explode(F.sequence(F.lit(2), F.size("k") - 1)).alias("m"))
    inner = inner.select("a", F.explode(F.transform(F.sequence(F.lit(1), F.size("k") - F.col("m") + 1), lambda i: F.slice("k", i, F.col("m")))).alias("k"))
    around = inner.groupBy("k").agg(F.max("a").alias("around"))
    kept = scored.join(around, "k", "left").filter(F.coalesce(100 * F.col("around") < share * F.col("a"), F.lit(True)))
    kept = stored(kept.select("k", "a", "best.*").drop("cut"), "candidates")
    named = kept.select("k", F.posexplode("k").alias("at", "h")).join(dictionary, "h").groupBy("k").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"), F.min("lang").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.join(named, "k").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
