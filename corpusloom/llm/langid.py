"""Language identification by a convolutional network over bytes.

Each text is cut into windows of ``WINDOW`` bytes. A window's bytes are embedded, filters of several widths slide over them, each filter
keeps its largest answer, and a softmax over these answers gives the window's languages; a text's answer is the mean of its
windows', weighted by their bytes. The network is trained in numpy on the driver, from a sample of labelled rows bounded by
``per_lang`` documents of each language, ``sample`` in all and ``excerpts`` stretches of each; it is a few thousand numbers and goes
to the tasks with the code. Every byte of every text is read, in Arrow batches of bounded size; nothing else is shuffled.

A null text, or one without a letter, is ``und`` with score 0, and so is everything if no labelled row exists. Equal answers go to the
first language by name; repeated rows get the same answer; the prediction sees the text alone. An empty table gives no rows; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import slices

#: Bytes of a window, and the length of an embedded byte.
WINDOW, DIM = 128, 8
#: Widths of the filters, and how many there are of each.
WIDTHS, FILTERS = (2, 3, 4, 5), 16
_WIDEST = max(WIDTHS)
UNKNOWN = "und"


@dataclass
class ByteNetwork:
    """``bytes`` embeds (row 0, also the filling of short windows, is zero); ``filters`` is (widest x DIM, all filters); ``out``, ``bias`` end in the languages."""

    langs: list[str]
    bytes: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The largest answer of each filter in each window of bytes, where it is, and the stretches the filters saw."""
        n = len(windows)
        x = self.bytes[np.pad(windows, ((0, 0), (0, _WIDEST - 1)))].reshape(n, -1)
        seen = np.lib.stride_tricks.as_strided(x, (n, WINDOW, _WIDEST * DIM), (x.strides[0], DIM * x.itemsize, x.itemsize))
        answers = (seen.reshape(n * WINDOW, -1) @ self.filters).reshape(n, WINDOW, -1)
        return answers.max(1), answers, seen

    def languages(self, windows: np.ndarray) -> np.ndarray:
        """The softmax over languages for each window."""
        return softmax(np.maximum(self.pooled(windows)[0] + self.shift, 0) @ self.out + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of all texts (A-Z lower-cased, the last one of a text filled with zeros), whose they are, and their bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)[:-1]]) * WINDOW if len(texts) else sizes
    for a, t in zip(begin, texts):
        flat[a : a + len(t)] = np.frombuffer(t.lower(), np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(begin // WINDOW, counts)
    return flat.reshape(-1, WINDOW), owner, np.minimum(sizes[owner] - nth * WINDOW, WINDOW)


def train(texts: list[bytes], labels: list[str], epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 17) -> ByteNetwork | None:
    """A network fitted to labelled stretches of text by Adam on the cross-entropy, languages weighted alike."""
    langs = sorted(set(labels))
    windows, owner, size = windows_of(texts)
    y = np.array([langs.index(x) for x in labels], np.int64)[owner]
    full = size >= min(WINDOW // 4, max(size, default=0))  # very short rests teach little
    windows, y = windows[full], y[full]
    if not len(windows):
        return None
    rng = np.random.default_rng(seed)
    width = np.repeat(WIDTHS, FILTERS)
    mask = (np.arange(_WIDEST * DIM)[:, None] < width * DIM).astype(np.float32)
    net = ByteNetwork(
        langs, rng.normal(0, 0.5, (256, DIM)).astype(np.float32), (rng.normal(0, 1, mask.shape) * mask / np.sqrt(width * DIM)).astype(np.float32),
        np.zeros(len(width), np.float32), rng.normal(0, 0.1, (len(width), len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    net.bytes[0] = 0
    weight = (len(y) / (len(langs) * np.bincount(y, minlength=len(langs)).clip(1))).astype(np.float32)
    names = ("bytes", "filters", "shift", "out", "bias")
    first, second, step = {n: np.zeros_like(getattr(net, n)) for n in names}, {n: np.zeros_like(getattr(net, n)) for n in names}, 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), batch):
            at = order[a : a + batch]
            rows, n = windows[at], len(at)
            best, answers, seen = net.pooled(rows)
            hidden = np.maximum(best + net.shift, 0)
            error = softmax(hidden @ net.out + net.bias)
            error[np.arange(n), y[at]] -= 1
            error *= weight[y[at]][:, None] / n
            back = (error @ net.out.T) * (best + net.shift > 0)
            place = answers.argmax(1)  # where each filter answered most: (window, filter)
            won = seen[np.arange(n)[:, None], place]  # (window, filter, widest * DIM)
            grad = {"out": hidden.T @ error, "bias": error.sum(0), "shift": back.sum(0), "filters": np.einsum("nfd,nf->df", won, back) * mask, "bytes": np.zeros_like(net.bytes)}
            inner = (back[:, :, None] * net.filters.T[None]).reshape(n, -1, _WIDEST, DIM)
            padded = np.pad(rows, ((0, 0), (0, _WIDEST - 1)))
            which = padded[np.arange(n)[:, None, None], place[:, :, None] + np.arange(_WIDEST)]
            np.add.at(grad["bytes"], which.reshape(-1), inner.reshape(-1, DIM))
            grad["bytes"][0] = 0
            step += 1
            for name in names:
                first[name] += 0.1 * (grad[name] - first[name])
                second[name] += 0.001 * (grad[name] ** 2 - second[name])
                move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, (getattr(net, name) - rate * move).astype(np.float32))
    return net


def learn(docs: DataFrame, labelled: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 200, sample: int = 20_000, excerpts: int = 8) -> ByteNetwork | None:
    """A network fitted to the rows where ``labelled`` holds and text and language are not null; None if there are none.

    The sample is the first ``per_lang`` documents of each language by hash, ``sample`` at most, and of each ``excerpts`` evenly spread
    stretches of ``2 * WINDOW`` characters. It is all that reaches the driver.
    """
    size = 2 * WINDOW
    rows = docs.filter(labelled & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    room = F.greatest(F.char_length(text) - size, F.lit(0))
    spread = F.transform(F.sequence(F.lit(0), F.lit(excerpts - 1)), lambda i: F.substr(F.col(text), (F.lit(1) + F.floor(i * room / max(excerpts - 1, 1))).cast("int"), F.lit(size)))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(doc_id, text).alias("h"), F.when(room > 0, spread).otherwise(F.array(F.col(text))).alias("parts"))
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", F.col("parts")[0]))).filter(F.col("nth") <= per_lang)
    taken = ranked.orderBy("nth", "h").limit(sample).collect()
    return train([p.encode() for r in taken for p in r["parts"]], [r["lang"] for r in taken for _ in r["parts"]]) if taken else None


def identify(docs: DataFrame, net: ByteNetwork | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row."""
    own = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(o) for c, o in zip(keep, own)], F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{o} {kinds[o]}" for o in own] + ["lang_pred string", "score double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text", 1 << 20):
                letter = part.column("letter").to_numpy(zero_copy_only=False) & (net is not None)
                total = np.zeros((len(texts), len(net.langs) if net else 1))
                windows, owner, size = windows_of([t if x else b"" for t, x in zip(texts, letter)])
                for a in range(0, len(windows), 256):
                    shares = net.languages(windows[a : a + 256]) * size[a : a + 256, None]
                    np.add.at(total, owner[a : a + 256], shares)
                total /= np.maximum(np.bincount(owner, size, len(texts)), 1)[:, None]
                best = total.argmax(1)
                names = [net.langs[b] if x else UNKNOWN for b, x in zip(best, letter)]
                score = np.where(letter, np.clip(total[np.arange(len(texts)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([*(part.column(o) for o in own), pa.array(names, pa.string()), pa.array(score)], names=[*own, "lang_pred", "score"])

    out = rows.mapInArrow(predict, schema)
    return out.select(*[F.col(o).alias(c) for c, o in zip(keep, own)], "lang_pred", "score")


def is_held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: the CRC-32 of its id as text leaves 2 by 4 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
