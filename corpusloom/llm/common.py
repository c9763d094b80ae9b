"""Helpers that the operators of this package share: document keys, word hashing in numpy, runs of equal keys, components.

Words are hashed with a keyed polynomial over their bytes, mixed to 64 bits; every operator that decides by hashes
either verifies its pairs against the words themselves or treats equal 64-bit hashes as equal words, which its
docstring then says.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\r\x0b\x0c"  # what separates words where a contract says [^\x20\x09-\x0D]+
NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what lies between words of letters and digits


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def alnum_words(text: Column) -> Column:
    """The letter-and-digit words of a text as an array, in their own case; null is empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_ALNUM), lambda w: w != "")


def document_key(doc_id: Column, text: Column) -> Column:
    """A key that is never null and that differs for rows of one id with different texts."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.hex(F.xxhash64(text)))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the cluster's shared folder and read again, so that a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table below the shared folder that a newer one has replaced."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


# --- words in numpy ---------------------------------------------------------------------------------------------

_PIECE = 1 << 20
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPAN = 1 << 16
_POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(_SPAN - 1, _BASE)]))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[ord(c) for c in BLANK]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(texts: list[bytes], separators: np.ndarray = _IS_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z lower-cased) and, per text, where its words begin (one more at the end).

    Words lie between ``separators``, a mark for each byte value; the newline must be among them.
    """
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    blank = separators[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, a + _PIECE)))
        b = starts[j] if j < len(starts) else len(data)
        s = starts[i:j] - a
        at = np.arange(b - a) - np.repeat(s, np.diff(np.append(s, b - a)))
        worth = _TABLE[data[a:b]] * _POWERS[at & (_SPAN - 1)]
        if b - a > _SPAN:
            worth *= (at >> 16).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        worth[blank[a:b]] = 0
        out[i:j] = np.add.reduceat(worth, s)
        i = j
    ends = np.cumsum(lengths)
    return mix(out), np.searchsorted(starts, np.concatenate([np.zeros(1, np.int64), ends]))


def hash_shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words inside one text, and per text where its runs begin.

    A text of fewer words, but not none, has one run: all its words.
    """
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first[:-1], n)
    left = np.repeat(first[1:], n) - at
    total = np.full(len(at), np.uint64(size))
    for j in range(size):
        inside = left > j
        total = mix(total * _BASE + np.where(inside, words[np.minimum(at + j, max(len(words) - 1, 0))] if len(words) else 0, np.uint64(j)))
    return total, offsets


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """A batch in slices of at most ``limit`` bytes of text (one row at least), each with its texts; null is empty."""
    texts = batch.column(column)
    sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        part = batch.slice(i, j - i)
        yield part, [t or b"" for t in part.column(column).cast(pa.large_binary()).to_pylist()]
        i = j


# --- rows that share a key --------------------------------------------------------------------------------------


def shared_runs(df: DataFrame, key: str, item: str, extra: tuple[str, ...] = (), own: bool = False) -> DataFrame:
    """Rows whose ``key`` more than one ``item`` has, each with the run's first row and the row before it.

    One shuffle on the key; each task then streams its sorted rows and keeps two rows of state, so a key of any
    number of rows needs no memory. Adds ``head_*`` and ``prev_*`` for the item and the extra columns; the run's first row is not
    returned by itself, nor are other rows of its item unless ``own``.
    """
    cols = [key, item, *extra]
    kinds = dict(df.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in cols] + [f"{p}_{c} {kinds[c]}" for p in ("head", "prev") for c in (item, *extra)])
    types = {c: pa.int64() if kinds[c] == "bigint" else pa.int32() for c in cols}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # the run's head and the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            table = [batch.column(c).to_numpy(zero_copy_only=False) for c in cols]
            if held is not None:
                table = [np.concatenate([np.array(h, dtype=v.dtype), v]) for h, v in zip(held, table)]
            k, it = table[0], table[1]
            fresh = np.concatenate([[True], k[1:] != k[:-1]])
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(k)), 0))
            keep = np.flatnonzero(~fresh if own else it != it[head])
            if held is not None:
                keep = keep[keep >= 2]
            if len(keep):
                data = [v[keep] for v in table] + [v[head[keep]] for v in table[1:]] + [v[keep - 1] for v in table[1:]]
                names = cols + [f"{p}_{c}" for p in ("head", "prev") for c in (item, *extra)]
                kind = [types[c] for c in cols] + [types[c] for _ in range(2) for c in (item, *extra)]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(data, kind)], names=names)
            held = [[v[head[-1]], v[-1]] for v in table]

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*cols).repartition(parts, key).sortWithinPartitions(*cols).mapInArrow(scan, schema)


def _streamed(names: tuple[str, str], emit) -> object:
    """A function over sorted batches of two long columns; ``emit(key, item, fresh, first)`` gives the pairs of a batch.

    ``fresh`` marks the rows that begin a key, ``first`` is the item of the key's first row. Two numbers are kept
    from batch to batch, so a key may have any number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # key, its first item, its last item
        for batch in batches:
            if not batch.num_rows:
                continue
            key, item = (batch.column(n).to_numpy(zero_copy_only=False) for n in names)
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            before = np.empty(len(key), np.int64)
            before[1:] = item[:-1]
            if held is not None:
                fresh[0], before[0] = key[0] != held[0], held[2]
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
            first = np.where(begin >= 0, item[begin], held[1] if held is not None else 0)
            new = fresh | (item != before)
            x, y = emit(key[new], item[new], fresh[new], first[new])
            held = (key[-1], first[-1], item[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    return run


def _large_star(node, near, fresh, first):
    """Larger neighbours move to the least of the node and its neighbours."""
    up = near > node
    return np.minimum(node, first)[up], near[up]


def _small_star(node, near, fresh, first):
    """A node and its smaller neighbours move to the least of these."""
    return first, np.where(fresh, node, near)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges (a, b)``: the least node it reaches.

    Large and small stars in turn until the edges are stars around the least nodes. A round is two shuffles of the
    edges and streams sorted rows, so neither a hub nor a large component is held in a task; the rounds grow
    with the logarithm of the longest chain. Edges are written to the shared folder after each round.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    now = stored(edges.filter("a <> b").select(low, high).distinct(), "edges")
    mark = None
    while True:
        # Equal edges twice in a row mean that nothing moves any more.
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        mark = new
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_streamed(("a", "b"), _large_star), "a long, b long")
        small = large.repartition("b").sortWithinPartitions("b", "a").mapInArrow(_streamed(("b", "a"), _small_star), "a long, b long")
        now = stored(small, "edges")
