"""Language-model scoring with an Elias-Fano n-gram trie in shards.

The model is a bigram model: level 1 of the trie holds words (hashes) with their counts, level 2 the successors of each
context. Both levels and the pointers between them are Elias-Fano sequences: contexts increase, pointers increase, and a
successor is stored relative to its context, which makes the whole level increase. Probabilities of level 2 are joint relative
frequencies quantised to 16 bits (exact to 1 023, steps of 0.1 % beyond, up to 2^63). Each level is written to a file and
memory-mapped; a query is a successor search for the context, then one inside the context's range.

Smoothing: ``P(w) = (c + 0.1) / (N + 0.1 (V + 1))`` for words (V types, one more for unknown words), and
``P(w | v) = (c(v w) + mu P(w)) / (c(v) + mu)`` for bigrams, so no event has probability 0 and a context never seen leaves ``P(w)``.
Tokens are blank-separated words, A-Z lower-cased, and an end; the context of the first word is a start that each text has once.

No task and no driver holds the model. Texts are read in slices; a slice sends each shard the distinct words and bigrams it has,
with their counts in training texts. A shard sums the counts, builds its part of the trie and answers each slice.
Then slices and answers meet, and each slice scores its texts. A bigram's shard depends on its context and on four bits of the
successor, so the bigrams of a word that is a third of all tokens lie in sixteen shards; words of one slice are
distinct before they are sent, so a frequent word is one number for each slice.

Words are 64-bit hashes, bigrams 48 bits inside a shard; equal hashes count as equal. The table must be read in the
same partitions twice, as files are; pass ``stable=False`` for any other input, which is then written first. A slice that does not
match its answers raises.

Null and empty texts are an end alone. A null id counts as a training text. Repeated rows are scored and learned from
one by one; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import hash_words, mix, slices, stored

MU = 30.0
WORD, PAIR = 0, 1
_END, _START = np.uint64(0x5EED0E4D), np.uint64(0x5EED5747)
_LOW = np.uint64(0xFFFFFF)
SLICE = 4 << 20
_EXACT, _STEP = 1023, 1.001  # counts up to _EXACT are their own codes


# --- Elias-Fano -------------------------------------------------------------------------------------------------


class EliasFano:
    """An increasing sequence: low bits packed, high bits in unary, decoded in blocks; all parts in one memory-mapped file."""

    STEP = 4096

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n = n
        self.low_bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        ones = high + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        low = [np.empty(0, np.uint8)]
        for a in range(0, n, self.STEP):  # bit planes of a block of values, byte-aligned by block
            part = values[a : a + self.STEP]
            low.append(np.packbits(((part[:, None] >> np.arange(self.low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)))
        self.low_at = np.cumsum([0] + [len(x) for x in low[1:]])
        self.firsts = values[:: self.STEP].copy()
        self.high_at = np.concatenate([ones[:: self.STEP], [len(unary)]]).astype(np.int64)
        self.mapped = _mapped(np.concatenate([np.packbits(unary), *low]))
        self.low_from = (len(unary) + 7) // 8

    def block(self, b: int) -> np.ndarray:
        """The values of block ``b``."""
        size = min(self.STEP, self.n - b * self.STEP)
        a, z = int(self.high_at[b]), int(self.high_at[b + 1])
        bits = np.unpackbits(self.mapped[a // 8 : (z + 7) // 8])[a % 8 : a % 8 + z - a]
        high = (a + np.flatnonzero(bits)[:size] - np.arange(size) - b * self.STEP).astype(np.uint64)
        raw = self.mapped[self.low_from + self.low_at[b] : self.low_from + self.low_at[b + 1]]
        planes = np.unpackbits(raw)[: size * self.low_bits].reshape(size, self.low_bits)
        low = np.zeros(size, np.uint64)
        for k in range(self.low_bits):
            low |= planes[:, k].astype(np.uint64) << np.uint64(k)
        return (high << np.uint64(self.low_bits)) | low

    def successors(self, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of the sorted ``sought``: the index of the first value that is not less, and whether it is equal."""
        index, equal = np.full(len(sought), self.n, np.int64), np.zeros(len(sought), bool)
        if not self.n or not len(sought):
            return index, equal
        owner = np.maximum(np.searchsorted(self.firsts, sought, "right") - 1, 0)
        edge = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        for a, z in zip(edge[:-1], edge[1:]):
            values = self.block(int(owner[a]))
            at = np.searchsorted(values, sought[a:z])
            inside = at < len(values)
            equal[a:z] = inside & (values[np.minimum(at, len(values) - 1)] == sought[a:z])
            index[a:z] = at + int(owner[a]) * self.STEP
        return index, equal

    def at(self, positions: np.ndarray) -> np.ndarray:
        """Values at sorted positions."""
        out = np.empty(len(positions), np.uint64)
        owner = positions // self.STEP
        edge = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        for a, z in zip(edge[:-1], edge[1:]):
            out[a:z] = self.block(int(owner[a]))[positions[a:z] % self.STEP]
        return out


def _mapped(data: np.ndarray) -> np.ndarray:
    """``data`` in a memory-mapped file of the task, which goes when nothing refers to it."""
    if not data.nbytes:
        return data
    with tempfile.TemporaryFile() as file:
        file.write(data.tobytes())
        file.flush()
        return np.memmap(file, data.dtype, "r", shape=data.shape)


def quantise(counts: np.ndarray) -> np.ndarray:
    """Counts as 16 bits: 0 for none, themselves up to 1 023, then steps of 0.1 %; the largest 64-bit count has code 37 762."""
    beyond = _EXACT + np.rint(np.log(np.maximum(counts, 1) / _EXACT) / np.log(_STEP))
    return np.where(counts <= _EXACT, counts, beyond).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return np.where(codes <= _EXACT, codes, _EXACT * _STEP ** (codes.astype(np.float64) - _EXACT))


class WordLevel:
    """Level 1 of a shard: words and their exact counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = EliasFano(keys, 1 << 64), _mapped(counts)

    def ask(self, keys: np.ndarray) -> np.ndarray:
        index, equal = self.keys.successors(keys)
        out = np.zeros(len(keys), np.int64)
        out[equal] = self.counts[index[equal]]
        return out


class PairLevel:
    """Contexts, pointers and successors of a shard: keys are 24 bits of context, then 24 bits of successor."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        contexts, begins = np.unique(keys >> np.uint64(24), return_index=True)
        self.contexts = EliasFano(contexts, 1 << 24)
        self.pointers = EliasFano(np.append(begins, len(keys)).astype(np.uint64), len(keys) + 1)
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(np.append(begins, len(keys))))
        # Relative to its context: a successor's value is its own bits above those of all earlier contexts.
        self.successors = EliasFano((rank << np.uint64(24)) | (keys & _LOW), max(len(contexts), 1) << 24)
        self.codes = _mapped(quantise(counts))

    def ask(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.uint16)
        rank, known = self.contexts.successors(keys >> np.uint64(24))
        rank, mine = rank[known].astype(np.uint64), keys[known]
        begin, end = self.pointers.at(rank.astype(np.int64)), self.pointers.at(rank.astype(np.int64) + 1)
        index, equal = self.successors.successors((rank << np.uint64(24)) | (mine & _LOW))
        equal &= (index >= begin.astype(np.int64)) & (index < end.astype(np.int64))
        codes = np.zeros(len(mine), np.uint16)
        codes[equal] = self.codes[index[equal]]
        out[known] = codes
        return out


# --- slices -----------------------------------------------------------------------------------------------------


class Slice:
    """The tokens of some texts, their distinct words and bigrams, in the order in which shards are asked."""

    def __init__(self, texts: list[bytes], shards: int):
        words, first = hash_words(texts)
        self.sizes = np.diff(first) + 1
        ends = np.cumsum(self.sizes) - 1
        tokens = np.empty(len(words) + len(texts), np.uint64)
        is_word = np.ones(len(tokens), bool)
        is_word[ends] = False
        tokens[is_word], tokens[ends] = words, _END
        before = np.concatenate([[_START], tokens[:-1]])
        begins = ends - self.sizes + 1
        before[begins] = _START
        self.begins = begins
        keys, place = np.unique(tokens, return_inverse=True)
        shard = mix(keys) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        self.words, self.word_shard = keys[order], shard[order].astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.word_of = rank[place]
        context, successor = mix(before ^ np.uint64(0xC0)), mix(tokens ^ np.uint64(0x5C))
        shard = mix((context >> np.uint64(32)) ^ ((successor >> np.uint64(60)) << np.uint64(32))) % np.uint64(shards)
        pair = (shard << np.uint64(48)) | ((context & _LOW) << np.uint64(24)) | ((successor >> np.uint64(8)) & _LOW)
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.pair_shard = (self.pairs >> np.uint64(48)).astype(np.int64)
        self.pairs &= np.uint64((1 << 48) - 1)

    def questions(self, learned: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
        """``(shard, kind, keys, counts)``; ``learned``: whether each text is a training text."""
        weight = np.repeat(learned, self.sizes).astype(np.float64)
        for kind, keys, shard, of in ((WORD, self.words, self.word_shard, self.word_of), (PAIR, self.pairs, self.pair_shard, self.pair_of)):
            counts = np.bincount(of, weight, len(keys)).astype(np.uint32)
            edge = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
            for a, z in zip(edge[:-1], edge[1:]):
                yield int(shard[a]), kind, _packed(keys[a:z], kind), counts[a:z].tobytes()

    def scores(self, counts: np.ndarray, codes: np.ndarray, total: int, types: int, mu: float) -> Iterator[tuple[int, int, float, float]]:
        """``(n_tokens, n_known, base, model)`` of each text."""
        share = (counts + 0.1) / (total + 0.1 * (types + 1))
        word = share[self.word_of]
        # How often the context was learned: the word before, or a start, which is as frequent as the end.
        context = counts[np.concatenate([[0], self.word_of[:-1]])].astype(np.float64)
        last = self.begins + self.sizes - 1
        context[self.begins] = counts[self.word_of[last[0]]]
        model = np.log10((restored(codes)[self.pair_of] + mu * word) / (context + mu))
        known = (counts > 0)[self.word_of]
        for values in zip(self.sizes.tolist(), np.add.reduceat(known.astype(np.int64), self.begins).tolist(), np.add.reduceat(np.log10(word), self.begins).tolist(), np.add.reduceat(model, self.begins).tolist()):
            yield values


def _packed(keys: np.ndarray, kind: int) -> bytes:
    return keys.tobytes() if kind == WORD else keys.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(data: bytes, kind: int) -> np.ndarray:
    if kind == WORD:
        return np.frombuffer(data, np.uint64)
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _answer(kind: int, asked: list[tuple[int, bytes, bytes]]) -> tuple[list[tuple[int, bytes]], int, int]:
    """Answers of a shard to each slice, and its training tokens and types (words only)."""
    keys = [_unpacked(k, kind) for _, k, _ in asked]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(place, np.concatenate([np.frombuffer(c, np.uint32) for _, _, c in asked])).astype(np.int64)
    learned = counts > 0
    level = (WordLevel if kind == WORD else PairLevel)(distinct[learned], counts[learned])
    # All slices ask at once: the trie is walked one time, whatever the number of slices.
    found = level.ask(distinct)[place]
    edge = np.cumsum([0] + [len(k) for k in keys])
    answers = [(b, found[i:j].tobytes()) for (b, _, _), i, j in zip(asked, edge[:-1], edge[1:])]
    return answers, int(counts.sum()) if kind == WORD else 0, int(learned.sum()) if kind == WORD else 0


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mu: float = MU, stable: bool = True) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``; scores are log10.

    Learned from the rows whose ``crc32(id as text) mod 10`` is not 0.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(4 * parts, 60_000)
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), held.alias("held_out"))
    rows = rows if stable else stored(rows, "texts")

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list[bytes]]]:
        """Slices of a partition with their numbers, the same ones each time the partition is read."""
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part, texts in slices(batch, "text", SLICE):
                yield number, part, texts
                number += 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part, texts in sliced(batches):
            learned = ~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            asked = list(Slice(texts, shards).questions(learned))
            shard, kind, keys, counts = zip(*asked)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.int32()), pa.array([number] * len(asked), pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["shard", "kind", "slice", "keys", "counts"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []

        def close() -> pa.RecordBatch:
            answers, tokens, types = _answer(now[1], asked)
            n = len(answers)
            return pa.RecordBatch.from_arrays(
                [pa.array([a[0] for a in answers], pa.int64()), pa.array([now[1]] * n, pa.int32()), pa.array([now[0]] * n, pa.int32()), pa.array([a[1] for a in answers], pa.binary()), pa.array([tokens] + [0] * (n - 1), pa.int64()), pa.array([types] + [0] * (n - 1), pa.int64())],
                names=["slice", "kind", "shard", "data", "tokens", "types"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["kind"]) != now:
                    if asked:
                        yield close()
                    now, asked = (row["shard"], row["kind"]), []
                asked.append((row["slice"], row["keys"], row["counts"]))
        if asked:
            yield close()

    questions = rows.mapInArrow(ask, "shard int, kind int, slice long, keys binary, counts binary")
    answers = questions.repartition(parts, "shard").sortWithinPartitions("shard", "kind", "slice").mapInArrow(reply, "slice long, kind int, shard int, data binary, tokens long, types long")
    answers = stored(answers, "answers")
    sums = answers.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    total, types = sums["tokens"] or 0, sums["types"] or 0

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, part, _ in sliced(batches):
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([at] * n, pa.int64()), pa.array(range(n), pa.int32()), *(part.column(c) for c in ("doc_id", "text", "held_out"))], names=["slice", "shard", "doc_id", "text", "held_out"])

    numbered = rows.mapInArrow(number, "slice long, shard int, doc_id long, text string, held_out boolean").withColumn("kind", F.lit(2)).withColumn("data", F.lit(None).cast("binary"))
    columns = ["slice", "kind", "shard", "data", "doc_id", "text", "held_out"]
    told = answers.select("slice", "kind", "shard", "data", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("held_out"))
    met = numbered.select(*columns).unionByName(told).repartition(parts, "slice").sortWithinPartitions("slice", "kind", "shard")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, data, texts, ids, outs = None, ([], []), [], [], []

        def close() -> pa.RecordBatch:
            own = Slice(texts, shards)
            counts, codes = np.frombuffer(b"".join(data[WORD]), np.int64), np.frombuffer(b"".join(data[PAIR]), np.uint16)
            if len(counts) != len(own.words) or len(codes) != len(own.pairs):
                raise RuntimeError("the input partitions changed between reads: pass stable=False")
            n, known, base, model = zip(*own.scores(counts, codes, total, types, mu))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array([total] * len(n), pa.int64()), pa.array(base, pa.float64()), pa.array(model, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for slice_, kind, datum, id_, text_, out in zip(*(batch.column(c).to_pylist() for c in ("slice", "kind", "data", "doc_id", "text", "held_out"))):
                if slice_ != now:
                    if texts:
                        yield close()
                    now, data, texts, ids, outs = slice_, ([], []), [], [], []
                if kind < 2:
                    data[kind].append(datum)
                else:
                    texts.append((text_ or "").encode())
                    ids.append(id_)
                    outs.append(out)
        if texts:
            yield close()

    return met.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
