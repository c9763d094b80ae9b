"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its distinct word shingles (64-bit hashes; equal hashes count as equal shingles). Sets are dealt
into bands of sizes so wide that two sets with ``similarity`` lie in the same or in neighbouring bands; a set takes
part in its own band's scheme and in the next one's. A scheme for sets of at most ``r`` shingles allows ``k`` differing shingles:
the domain of shingles is partitioned by a hash into ``n1`` parts and each part into ``n2`` cells, and a signature is the content of a
subset of ``n2 - k2`` cells of a part. Sets that differ in at most ``k`` shingles agree on a signature, whichever
shingles they are. Signatures of empty content are left out where enough others are left to keep that promise
(``k // (k2 + 1) + 1`` parts with more than ``k2`` cells in use); a set with fewer sends the empty ones too.

Equal sets are one node. Nodes that share a signature form clusters; in a cluster, ordered by size, bounded blocks of nodes
are compared with the blocks that their sizes allow, so a cluster of any size is many bounded groups. Blocks are compared twice.
First by sketches: the parity of a set's shingles in two to four bits for each of them. Two sets differ in at least as many
shingles as their sketches differ in bits, so pairs whose sketches differ too much cannot be similar and no similar pair is
lost; what is left forms finer clusters. Then, in these, the shingles themselves are sent and common ones counted, so every
pair that may be similar is verified exactly. A group sends back links that connect it, not all its pairs.

Defined cases: a text with fewer words than a shingle is one shingle; without words the set is empty and linked with nothing; null is an
empty text; repeated rows are equal sets; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import components, hash_shingles, hash_words, mix, shared_runs, slices, stored
from corpusloom.operators.running import running_sum

BLOCK = 1 << 20  # shingles that a block of sets holds
BLOCK_SETS = 1024
SKETCH_BLOCK = 1 << 22  # bits of sketches that a block holds, one sketch at least
SKETCH_SETS = 4096
STRIP = 1024  # sketches of a block that are compared at once with another block's
#: Tables of at most so many rows (three numbers each) are sent to every task; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


class Schemes:
    """The bands of set sizes and each band's partition scheme for one similarity."""

    def __init__(self, similarity: Fraction):
        self.similarity = similarity
        self.tops = [1]  # the largest size of each band

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, math.floor((self.tops[-1] + 1) / self.similarity)))
        return int(np.searchsorted(self.tops, size))

    def scheme(self, band: int) -> tuple[int, int, int, int]:
        """``(n1, n2, k2, need)`` of a band: parts, cells of a part, cells left out, parts in use that suffice."""
        while len(self.tops) <= band:
            self.band(self.tops[-1] + 1)
        s = self.similarity
        k = math.floor(2 * (1 - s) / (1 + s) * self.tops[band])
        # Few differences: longer signatures are cheap. Many: one cell for each part gives the fewest signatures.
        n2, k2 = (3, 1) if 2 <= k <= 6 else (1, 0)
        need = k // (k2 + 1) + 1
        return math.ceil(1.1 * need) + 2 * (k > 0), n2, k2, need

    def signatures(self, items: np.ndarray) -> np.ndarray:
        """All signatures of a set of shingle hashes."""
        out = []
        own = self.band(len(items))
        for band in (own, own + 1):
            n1, n2, k2, need = self.scheme(band)
            spread = mix(items + np.uint64(2 * band + 1))
            cell = (spread % np.uint64(n1 * n2)).astype(np.int64)
            content = np.zeros(n1 * n2, np.uint64)
            np.add.at(content, cell, mix(spread))
            used = np.bincount(cell, minlength=n1 * n2).reshape(n1, n2)
            content = content.reshape(n1, n2)
            enough = int(((used > 0).sum(1) > k2).sum()) >= need
            for i, cols in enumerate(itertools.combinations(range(n2), n2 - k2)):
                count, total = used[:, cols].sum(1), content[:, cols].sum(1)
                name = np.arange(n1, dtype=np.uint64) * np.uint64(8) + np.uint64(i)
                sig = mix(total + mix(name + (np.uint64(band) << np.uint64(40))))
                out.append(sig[count > 0] if enough else sig)
        return np.concatenate(out)


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    shingles, at = hash_shingles(*hash_words(texts), size)
    return [np.unique(shingles[at[i] : at[i + 1]]) for i in range(len(texts))]


def _node(items: np.ndarray) -> int:
    """A hash of a whole set."""
    return int(mix(mix(items).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(items))).view(np.int64)[0]) if len(items) else 0


def sketch_width(size: int) -> int:
    """The bits of the sketch of a set of ``size`` shingles: a power of two, two to four for each."""
    return max(64, 1 << (2 * size - 1).bit_length())


def sketch(items: np.ndarray) -> bytes:
    """Whether an odd number of a set's shingles falls on each of ``sketch_width`` places, as packed bits."""
    width = sketch_width(len(items))
    odd = np.bincount((mix(items) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches as they would be with fewer bits."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, width), axis=1)


def may_be_similar(left: list[bytes], n_left: np.ndarray, right: list[bytes], n_right: np.ndarray, similarity: Fraction) -> np.ndarray:
    """For each pair of sketches and set sizes whether the sets can have ``similarity``; false only where they cannot."""
    p, q = similarity.numerator, similarity.denominator
    out = np.zeros((len(left), len(right)), bool)
    widths = [np.array([8 * len(s) for s in side]) for side in (left, right)]
    for wl in np.unique(widths[0]):
        i = np.flatnonzero(widths[0] == wl)
        a = np.unpackbits(np.frombuffer(b"".join(left[k] for k in i), np.uint8).reshape(len(i), -1), axis=1)
        for wr in np.unique(widths[1]):
            j = np.flatnonzero(widths[1] == wr)
            # The differing shingles allowed, and with the sizes alone those that there are at least.
            total = n_left[i][:, None] + n_right[j][None, :]
            close = np.abs(n_left[i][:, None] - n_right[j][None, :]) * (p + q) <= (q - p) * total
            if not close.any():
                continue
            b = np.unpackbits(np.frombuffer(b"".join(right[k] for k in j), np.uint8).reshape(len(j), -1), axis=1)
            width = int(min(wl, wr))
            x, y = folded(a, width), folded(b, width)
            both = np.zeros((len(i), len(j)), np.int64)
            for c in range(0, width, 4096):
                both += (x[:, c : c + 4096].astype(np.float32) @ y[:, c : c + 4096].astype(np.float32).T).astype(np.int64)
            differ = x.sum(1, dtype=np.int64)[:, None] + y.sum(1, dtype=np.int64)[None, :] - 2 * both
            out[np.ix_(i, j)] = close & (differ * (p + q) <= (q - p) * total)
    return out


def joined(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of a first node with each other one of its part of the graph whose edges ``hit`` marks."""
    waiting = hit.any(1)
    while waiting.any():
        rows = np.zeros(len(left), bool)
        rows[np.argmax(waiting)] = True
        fresh = rows.copy()
        while fresh.any():
            cols = hit[fresh].any(0)
            fresh = hit[:, cols].any(1) & ~rows
            rows |= fresh
        waiting &= ~rows
        nodes = np.union1d(left[rows], right[hit[rows].any(0)])
        yield from ((int(nodes[0]), int(n)) for n in nodes[1:])


def common_counts(sets: list[np.ndarray], split: int) -> np.ndarray:
    """How many items each of the first ``split`` sets has in common with each of the others (each with each, if ``split`` is 0).

    Items of many sets are counted by products of 0/1 matrices, the others by the pairs of sets that hold them.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.bincount(place, minlength=len(values))
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    often = held > max(8, n // 64)
    out = np.zeros((n, n), np.int64)
    rare = ((held > 1) & ~often)[place]
    who, what = owner[rare], place[rare]
    for k in range(1, int(held[~often].max(initial=1))):
        pair = what[k:] == what[:-k]
        out += np.bincount(who[:-k][pair] * n + who[k:][pair], minlength=n * n).reshape(n, n)
    out += out.T
    column = np.cumsum(often) - 1
    dense_of = often[place]
    who, what = owner[dense_of], column[place[dense_of]]
    step = 4096
    for a in range(0, int(often.sum()), step):
        i, j = np.searchsorted(what, [a, a + step])
        dense = np.zeros((n, step), np.float32)
        dense[who[i:j], what[i:j] - a] = 1
        out += (dense @ dense.T).astype(np.int64)
    return out if split == 0 else out[:split, split:]


def _links(nodes: list[int], sets: list[np.ndarray], split: int, similarity: Fraction) -> list[tuple[int, int]]:
    """Pairs of similar sets that connect all similar ones of this group: at most one fewer than its nodes."""
    p, q = similarity.numerator, similarity.denominator
    both = common_counts(sets, split)
    sizes = np.array([len(s) for s in sets])
    left = np.arange(both.shape[0])
    right = np.arange(len(sets) - both.shape[1], len(sets))
    total = sizes[left][:, None] + sizes[right][None, :] - both
    hit = (q * both >= p * total) & (left[:, None] < right[None, :])
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(hit)):
        x, y = find(int(left[a])), find(int(right[b]))
        if x != y:
            root[x] = y
            out.append((nodes[left[a]], nodes[right[b]]))
    return out


def similar_sets(docs: DataFrame, doc_id: str, text: str, size: int, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """``(documents, links)``: ``(row, doc_id, node, n_shingles)`` for each row of ``docs`` and links ``(a, b)`` between different sets.

    The links connect the sets exactly as all pairs of ``similarity`` would. ``row`` is a hash of id and text.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes, sent = Schemes(similarity), set()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = _sets(texts, size)
                nodes = [_node(s) for s in sets]
                sigs = []
                for node, items in zip(nodes, sets):
                    # A set's signatures leave a task once: thousands of copies are a row each, not a thousand signatures each.
                    sigs.append(schemes.signatures(items).astype(np.int64) if len(items) and node not in sent else np.empty(0, np.int64))
                    sent.add(node)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sigs])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(offsets, np.concatenate(sigs))],
                    names=["doc_id", "row", "node", "n_shingles", "sigs"])

    signed = rows.mapInArrow(sign, "doc_id long, row long, node long, n_shingles long, sigs array<long>")
    shared = shared_runs(signed.select(F.explode("sigs").alias("sig"), "node"), "sig", "node")
    edges = stored(shared.select(F.col("head_node").alias("a"), F.col("node").alias("b")).distinct(), "signature-links")
    clusters = components(edges).withColumnRenamed("component", "cluster")

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = _sets(texts, size)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("row"), pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())],
                    names=["doc_id", "row", "node", "n_shingles", "sketch"])

    sketched = stored(rows.mapInArrow(plain, "doc_id long, row long, node long, n_shingles long, sketch binary"), "shingle-sets")
    documents = sketched.drop("sketch")
    chosen = documents.groupBy("node").agg(F.min("row").alias("row"), F.max("n_shingles").alias("n")).join(clusters, "node")
    chosen = stored(chosen.select("row", "node", "n", "cluster"), "clustered")
    few = chosen.count() <= BROADCAST_ROWS
    blocked = _blocks(chosen, 4 * F.col("n"), SKETCH_BLOCK, SKETCH_SETS)
    sketches = sketched.select("row", "sketch").join(F.broadcast(blocked) if few else blocked, "row").select("node", "cluster", "block", "n", "sketch")

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, split, (sizes, bits) in _meetings(batches, ("n", "sketch")):
            ids, n = np.array(nodes, np.int64), np.array(sizes, np.int64)
            cut = split or 0
            right = slice(cut, None)
            for a in range(0, split or len(nodes), STRIP):
                strip = slice(a, min(a + STRIP, split or len(nodes)))
                found = list(joined(may_be_similar(bits[strip], n[strip], bits[right], n[right], similarity), ids[strip], ids[right]))
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    near = stored(_dealt(sketches, blocked, similarity, few, ("n", "sketch")).mapInArrow(screen, "a long, b long").distinct(), "sketch-links")
    # One row for each node of a finer cluster; its text is read again for the set.
    finer = components(near).withColumnRenamed("component", "cluster")
    chosen = stored(chosen.drop("cluster").join(finer, "node").select("row", "node", "n", "cluster"), "near")
    few = chosen.count() <= BROADCAST_ROWS
    blocked = _blocks(chosen, F.col("n"), BLOCK, BLOCK_SETS)
    texts = rows.select("row", "text").join(F.broadcast(blocked) if few else blocked, "row").select("node", "cluster", "block", "n", "text")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = _sets(texts, size)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                items = pa.ListArray.from_arrays(offsets, np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("node", "cluster", "block")] + [items], names=["node", "cluster", "block", "items"])

    members = texts.mapInArrow(fill, "node long, cluster long, block long, items array<long>")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, split, (items,) in _meetings(batches, ("items",)):
            found = _links(nodes, items, split, similarity) if len(nodes) > 1 else []
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return documents, stored(_dealt(members, blocked, similarity, few, ("items",)).mapInArrow(compare, "a long, b long"), "links")


def _dealt(members: DataFrame, blocked: DataFrame, similarity: Fraction, few: bool, columns: tuple[str, ...]) -> DataFrame:
    """The blocks of each cluster sent to the meetings ``(cluster, i, j)`` of two blocks, or of a block with itself, that sizes allow."""
    spans = blocked.groupBy("cluster", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    l, r = spans.alias("l"), spans.alias("r")
    # Blocks of a cluster are in order of size; two meet if a set of the larger ones can be similar to one of the smaller ones.
    fits = F.col("r.lo") * F.lit(similarity.numerator) <= F.col("l.hi") * F.lit(similarity.denominator)
    meet = l.join(r, (F.col("l.cluster") == F.col("r.cluster")) & (F.col("l.block") <= F.col("r.block")) & fits).select(F.col("l.cluster").alias("cluster"), F.col("l.block").alias("i"), F.col("r.block").alias("j"))
    goes = meet.select("cluster", F.col("i").alias("block"), "i", "j", F.lit(0).alias("side")).unionByName(
        meet.filter("i < j").select("cluster", F.col("j").alias("block"), "i", "j", F.lit(1).alias("side")))
    dealt = members.join(F.broadcast(goes) if few else goes, ["cluster", "block"])
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.select("cluster", "i", "j", "side", "node", *columns).repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "side", "node")


def _meetings(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[list[int], int, list[list]]]:
    """``(nodes, split, values of each column)`` of each meeting; ``split`` nodes are of the first block, 0 if it meets itself."""
    now, nodes, sides, values = None, [], [], [[] for _ in columns]
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j"))))
        ids, which = batch.column("node").to_pylist(), batch.column("side").to_pylist()
        held = [batch.column(c) for c in columns]
        for at, key in enumerate(keys):
            if key != now:
                if now is not None:
                    yield nodes, sides.count(0) if 1 in sides else 0, values
                now, nodes, sides, values = key, [], [], [[] for _ in columns]
            if nodes and nodes[-1] == ids[at]:
                continue  # a repeated row
            nodes.append(ids[at])
            sides.append(which[at])
            for into, column in zip(values, held):
                item = column[at]
                into.append(item.values.to_numpy(zero_copy_only=False).view(np.uint64) if isinstance(item, pa.ListScalar) else item.as_py())
    if now is not None:
        yield nodes, sides.count(0) if 1 in sides else 0, values


def _blocks(chosen: DataFrame, weight: Column, block: int, sets: int) -> DataFrame:
    """``chosen`` with the ``block`` of each node in its cluster, in order of size: at most ``block`` of ``weight`` or one set, and ``sets`` sets."""
    room = F.greatest(weight, F.lit(max(1, block // sets)))
    sizes = chosen.groupBy("cluster").agg(F.sum(room).alias("m"))
    large = stored(sizes.filter(F.col("m") > block).select(F.col("cluster").alias("big")), "large-clusters")
    rows = chosen.join(large, chosen["cluster"] == large["big"], "left")
    small = rows.filter("big is null").drop("big").withColumn("block", F.lit(0).cast("long"))
    if large.isEmpty():
        return stored(small, "blocks")
    summed = running_sum(rows.filter("big is not null").drop("big"), "cluster", ["n", "node"], room, "upto")
    return stored(small.unionByName(summed.withColumn("block", F.floor((F.col("upto") - room) / block).cast("long")).drop("upto")), "blocks")


def similarity_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """``(row, doc_id, n_shingles, component_id, group)`` for each row of ``docs``: the smallest id that similar documents lead to, its own included.

    ``group`` is the group's least node, which no other group has, whatever ids are null or repeat; it is null without words.
    """
    documents, links = similar_sets(docs, doc_id, text, size, similarity)
    groups = components(links).select(F.col("node").alias("n"), F.col("component"))
    firsts = documents.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    joined = firsts.join(groups, firsts["node"] == groups["n"], "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    joined = stored(joined, "nodes")
    # Most nodes are alone; only the others look for the smallest id of their group.
    least = joined.join(links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct(), "node", "left_semi")
    least = least.groupBy("component").agg(F.min("first").alias("least"))
    ids = joined.join(least, "component", "left").select("node", F.coalesce("least", "first").alias("component_id"), F.col("component").alias("group"))
    out = documents.join(ids, "node", "left")
    return out.select("row", "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "group")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that are similar to one of a smaller id; of rows equal in id and text, one stays.

    Documents without words are similar to none and stay.
    """
    groups = similarity_groups(docs, doc_id, text, **how)
    # Of a group's rows the one with the smallest id (null is the last), then with the least hash.
    key = F.when(F.col("n_shingles") > 0, F.struct(F.lit(True).alias("grouped"), F.col("group").alias("id"))).otherwise(F.struct(F.lit(False).alias("grouped"), F.col("row").alias("id")))
    best = groups.groupBy(key.alias("k")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))["row"].alias("row"))
    keep = stored(best.select("row").distinct(), "kept")
    name = "__row"
    while name in docs.columns:
        name += "_"
    keyed = docs.withColumn(name, F.xxhash64(F.col(doc_id), F.col(text)))
    # Rows equal in id and text are equal hashes: where there are any, they are numbered.
    kept = keyed.join(keep.withColumnRenamed("row", name), name, "left_semi")
    repeated = stored(groups.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("row").alias(name)), "repeated")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(repeated, name, "left_anti")
    one = kept.join(repeated, name, "left_semi").withColumn("__nth", F.row_number().over(Window.partitionBy(name).orderBy(F.lit(1)))).filter("__nth = 1").drop("__nth")
    return once.unionByName(one).select(*docs.columns)
