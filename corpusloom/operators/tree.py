"""Hierarchical clustering of embeddings into summary trees."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import vectors as VEC
from corpusloom.operators import enrich
from corpusloom.operators.running import row_numbers
from corpusloom.session import cut_lineage, settle

EXACT_LEAVES = 4096
BUCKET = 1024
MAX_FANOUT = 32
GROUP = 8192  # rows that one task may split


def mean_vectors(df: DataFrame, by: list[str], vector: str = "vector", name: str = "vector") -> DataFrame:
    """Mean vector per group; the summarizer combines on the map side, so a huge group is no special case."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    out = df.groupBy(*by).agg(Summarizer.mean(array_to_vector(as_double)).alias("__m"))
    return out.select(*by, vector_to_array("__m").alias(name))


# --- clustering -----------------------------------------------------------------------------------------------


def mixture_clusters(df: DataFrame, key: str, vector: str, max_clusters: int = 64, threshold: float = 0.1, dims: int = 12, seed: int = 7) -> DataFrame:
    """``(key, cluster)`` from the Gaussian mixture with the least BIC over 1..max−1 components.

    A row belongs to the first component whose probability exceeds the threshold.
    """
    base = df.select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("__raw"))
    width = df.select(F.max(F.size(vector))).first()[0]
    d = min(dims, width)
    reduced = cut_lineage(PCA(k=d, inputCol="__raw", outputCol="__x").fit(base).transform(base).select(key, "__x"))
    n = reduced.count()
    best, best_bic = None, None
    for k in range(2, min(max_clusters, n)):
        model = GaussianMixture(k=k, featuresCol="__x", probabilityCol="__p", predictionCol="__c", seed=seed, maxIter=30).fit(reduced)
        free = k * d + k * d * (d + 1) / 2 + k - 1
        bic = free * float(np.log(n)) - 2 * model.summary.logLikelihood
        if best_bic is None or bic < best_bic:
            best, best_bic = model, bic
    single = d + d * (d + 1) / 2
    single_bic = single * float(np.log(n)) - 2 * _gaussian_likelihood(reduced, d, n)
    if best is None or single_bic <= best_bic:
        return reduced.select(key, F.lit(0).alias("cluster"))
    scored = best.transform(reduced).select(key, vector_to_array("__p").alias("__p"))
    index = F.transform("__p", lambda p, i: F.when(p > threshold, i))
    return scored.select(key, F.coalesce(F.get(F.filter(index, lambda i: i.isNotNull()), F.lit(0)), F.lit(0)).alias("cluster"))


def _gaussian_likelihood(df: DataFrame, d: int, n: int) -> float:
    """Log-likelihood of one full-covariance Gaussian, from the d × d moments."""
    x = vector_to_array("__x")
    sums = df.select(x.alias("x")).agg(
        *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)],
        *[F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)]).first()
    mean = np.array([sums[f"s{i}"] for i in range(d)]) / n
    cov = np.array([[sums[f"q{min(i, j)}_{max(i, j)}"] / n - mean[i] * mean[j] for j in range(d)] for i in range(d)])
    _, logdet = np.linalg.slogdet(cov + 1e-9 * np.eye(d))
    return float(-0.5 * n * (d * np.log(2 * np.pi) + logdet + d))


def gap_clusters(df: DataFrame, key: str, vector: str, max_clusters: int = 8, seed: int = 7) -> DataFrame:
    """``(key, cluster)``: bisecting k-means, with as many clusters as there are before the largest cost drop ends."""
    base = cut_lineage(df.select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("__x")))
    n = base.count()
    if n <= 2:
        return row_numbers(base, [], [key], "__r").select(key, (F.col("__r") - 1).cast("int").alias("cluster"))
    stats = base.agg(Summarizer.mean(F.col("__x")).alias("m"), F.sum(VEC.dot(vector_to_array("__x"), vector_to_array("__x"))).alias("q")).first()
    costs, models = [float(stats["q"] - n * stats["m"].dot(stats["m"]))], {}
    for k in range(2, min(max_clusters, n) + 1):
        models[k] = BisectingKMeans(k=k, featuresCol="__x", predictionCol="cluster", seed=seed, maxIter=10).fit(base)
        costs.append(models[k].summary.trainingCost)
    drops = [costs[i] - costs[i + 1] for i in range(len(costs) - 1)]
    best = int(np.argmax(drops)) + 2 if drops else 1
    return models[best].transform(base).select(key, F.col("cluster").cast("int").alias("cluster"))


def _nearest(vector: Column, centers: Column, score) -> Column:
    """Label of the center with the best score, the lower label on ties."""
    scored = F.transform(centers, lambda c: F.struct(score(vector, c["v"]).alias("s"), (-c["label"]).alias("l")))
    return -F.array_max(scored)["l"]


def _centers(means: DataFrame, by: list[str], label: str) -> DataFrame:
    """Centers of every group in one array; a group has at most as many as it has labels."""
    return means.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), F.col("vector").alias("v")))).alias("__centers"))


def refine_labels(df: DataFrame, key: str, vector: str, label: str, rounds: int = 5) -> DataFrame:
    """Move rows to the nearest centroid up to ``rounds`` times; empty labels vanish, the rest are renumbered."""
    rows = cut_lineage(df.select(key, F.col(vector).alias("vector"), F.col(label).cast("int").alias("label")))
    distance = lambda a, b: -F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, v: s + v)
    for _ in range(rounds):
        centers = _centers(mean_vectors(rows, ["label"]), [], "label").scalar()  # one entry per label
        moved = rows.withColumn("__centers", centers).select(
            key, "vector", F.col("label").alias("__old"), _nearest(F.col("vector"), F.col("__centers"), distance).alias("label"))
        moved = cut_lineage(moved)
        stable = moved.filter(F.col("__old") != F.col("label")).isEmpty()
        rows = moved.select(key, "vector", "label")
        if stable:
            break
    used = rows.select("label").distinct()
    ranked = row_numbers(used, [], ["label"], "__r")
    return rows.join(ranked, "label").select(key, (F.col("__r") - 1).cast("int").alias("cluster"))


# --- exact trees over bounded buckets ----------------------------------------------------------------------------


def ranked_pairs(df: DataFrame, bucket: str, key: str, vector: str) -> DataFrame:
    """``(bucket, a, b, similarity, rank)``: pairs inside buckets of bounded size (:func:`bounded_buckets`), best first."""
    side = lambda name: df.select(bucket, F.col(key).alias(name), F.col(vector).alias(f"__{name}"))
    pairs = side("a").join(side("b"), bucket).filter(F.col("a") > F.col("b"))
    scored = pairs.select(bucket, "a", "b", F.round(VEC.cosine(F.col("__a"), F.col("__b")), 6).alias("similarity"))
    return row_numbers(scored, bucket, [F.col("similarity").desc(), F.col("a"), F.col("b")], "rank")


def _label(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Center of the greatest product for each row, the lower one on ties; summed dimension by dimension, so equal rows tie exactly."""
    score = np.zeros((len(vectors), len(centers)))
    for d in range(centers.shape[1]):
        score += np.multiply.outer(vectors[:, d], centers[:, d])
    return score.argmax(axis=1)


def _moved_center(mean: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.dot(mean, mean))
    return mean / length if length > 0 else mean


def _seed_rows(n: int, size: int) -> np.ndarray:
    """Evenly spaced rows, counted from 0, that seed the centers of a group of ``n``."""
    fan = min(max(2, -(-n // size)), n, MAX_FANOUT)
    return np.array([int(np.floor(k * ((n - 1) / (fan - 1)))) if fan > 1 else 0 for k in range(fan)])


def _split_group(vectors: np.ndarray, name: str, size: int, rounds: int) -> np.ndarray:
    """Bucket name of every row of one group whose rows are in key order."""
    names = np.full(len(vectors), name, dtype=object)
    todo = [np.arange(len(vectors))]
    while todo:
        rows = todo.pop()
        n = len(rows)
        if n <= size:
            continue
        here, above = vectors[rows], names[rows[0]]
        centers = here[_seed_rows(n, size)].copy()
        for _ in range(rounds):
            label = _label(here, centers)
            for k in np.unique(label):
                centers[k] = _moved_center(here[label == k].mean(axis=0))
        label = _label(here, centers)
        part = np.arange(n) // size if (label == label[0]).all() else label
        for k in np.unique(part):
            names[rows[part == k]] = f"{above}.{k}"
            todo.append(rows[part == k])
    return names


def bounded_buckets(df: DataFrame, key: str, vector: str, size: int = BUCKET, rounds: int = 5, group: int = GROUP) -> DataFrame:
    """``(key, vector, bucket)`` with at most ``size`` rows per bucket.

    Groups over the bound are split by spherical k-means with at most 32 centers, seeded at evenly spaced rows in key
    order, until all fit; a group that does not split is cut into slices. Groups of more than ``group`` rows are split
    together, a level at a time: their centers (one for each ``group / 32`` rows at most) are sent to the tasks, which label Arrow
    batches and return sums. A group of at most ``group`` rows is split to its end in one task.
    """
    rows = settle(df.select(key, VEC.unit(F.col(vector)).alias("vector"), F.lit("0").alias("bucket")))
    group, small = max(group, size), []
    while True:
        counts = rows.groupBy("bucket").agg(F.count("*").alias("__n"))
        big = {r["bucket"]: r["__n"] for r in counts.filter(F.col("__n") > group).toLocalIterator()}
        if not big:
            small.append(rows)
            break
        sized = rows.join(counts, "bucket")
        small.append(sized.filter(F.col("__n") <= group).select(key, "vector", "bucket"))
        placed = settle(row_numbers(sized.filter(F.col("__n") > group), "bucket", [key], "__pos"))
        seeds = rows.sparkSession.createDataFrame(
            [(b, int(p) + 1, k) for b, n in big.items() for k, p in enumerate(_seed_rows(n, size))], "bucket string, __pos long, label int")
        centers: dict[str, np.ndarray] = {}
        for r in placed.select("bucket", "__pos", "vector").join(seeds, ["bucket", "__pos"]).sort("bucket", "label").toLocalIterator():
            centers.setdefault(r["bucket"], []).append(r["vector"])
        centers = {b: np.array(v, dtype=np.float64) for b, v in centers.items()}
        for _ in range(rounds):
            sums = _labelled(placed, key, centers, True).groupBy("bucket", "label").agg(
                Summarizer.sum(array_to_vector("vector")).alias("s"), F.sum("__pos").alias("n"))
            for r in sums.toLocalIterator():
                centers[r["bucket"]][r["label"]] = _moved_center(r["s"].toArray() / r["n"])
        split = settle(_labelled(placed, key, centers, False))
        kinds = split.groupBy("bucket").agg((F.min("label") == F.max("label")).alias("__stuck"))
        part = F.when(F.col("__stuck"), F.floor((F.col("__pos") - 1) / size)).otherwise(F.col("label"))
        rows = settle(split.join(kinds, "bucket").select(key, "vector", F.concat_ws(".", "bucket", part.cast("string")).alias("bucket")))

    def finish(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[(key, "ascending")], null_placement="at_start"))
        vectors = np.stack(table.column("vector").to_numpy(zero_copy_only=False)) if table.num_rows > size else np.zeros((table.num_rows, 0))
        names = _split_group(vectors, table.column("bucket")[0].as_py(), size, rounds)
        return table.set_column(table.schema.get_field_index("bucket"), "bucket", pa.array(names, pa.string()))

    return reduce(lambda a, b: a.unionByName(b), small).groupBy("bucket").applyInArrow(finish, rows.schema)


def _labelled(placed: DataFrame, key: str, centers: dict[str, np.ndarray], sums: bool) -> DataFrame:
    """``placed`` with the ``label`` of each row, or sums: a row for each bucket and label of a batch, its row count as ``__pos``."""
    shared = placed.sparkSession.sparkContext.broadcast(centers)
    out = placed.select("bucket", "vector", "__pos", F.lit(0).alias("label")) if sums else placed.select(key, "bucket", "vector", "__pos", F.lit(0).alias("label"))

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            buckets = np.asarray(batch.column("bucket").to_pylist(), dtype=object)
            vectors = np.stack(batch.column("vector").to_numpy(zero_copy_only=False))
            label = np.zeros(len(vectors), dtype=np.int32)
            found = []
            for b in sorted(set(buckets)):
                at = np.flatnonzero(buckets == b)
                label[at] = _label(vectors[at], shared.value[b])
                found += [(b, int(k), vectors[at[label[at] == k]]) for k in np.unique(label[at])] if sums else []
            if sums:
                yield pa.RecordBatch.from_arrays([
                    pa.array([f[0] for f in found], pa.string()), pa.array([f[2].sum(axis=0).tolist() for f in found], pa.list_(pa.float64())),
                    pa.array([len(f[2]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32())], names=["bucket", "vector", "__pos", "label"])
            else:
                columns = {c: batch.column(c) for c in batch.schema.names} | {"label": pa.array(label)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return out.mapInArrow(run, out.schema)


def _merge_tree(vectors: np.ndarray) -> list[int]:
    """Parent of every node of the merge tree over a bounded set of vectors, -1 for the root.

    Pairs are taken from the most similar down. Two roots of equal height get a new parent; a lower root is hung
    under the first ancestor of the other leaf that is higher than it.
    """
    n = len(vectors)
    if n == 1:
        return [-1]
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    a, b = np.tril_indices(n, -1)
    order = np.lexsort((b, a, -np.round((unit @ unit.T)[a, b], 9)))
    parent, height = [-1] * n, [0] * n
    merged = 0

    def climb(i):
        while parent[i] != -1:
            i = parent[i]
        return i

    for p in order:
        i, j = int(a[p]), int(b[p])
        x, y = climb(i), climb(j)
        if x == y:
            continue
        if height[x] == height[y]:
            parent.append(-1)
            height.append(height[x] + 1)
            parent[x] = parent[y] = len(parent) - 1
        else:
            low, leaf = (x, j) if height[x] < height[y] else (y, i)
            up = leaf
            while height[up] <= height[low]:
                up = parent[up]
            parent[low] = up
        merged += 1
        if merged == n - 1:
            break
    return parent


def merge_tree(df: DataFrame, key: str, vector: str, size: int = BUCKET) -> DataFrame:
    """``(node, parent, level, leaf, vector)``: a merge tree per bounded bucket, then trees over the bucket roots.

    Every task sees at most ``size`` vectors. Leaves are named by their key, inner nodes by level, bucket and number.
    """
    level, parts = 0, []
    current = df.select(F.col(key).cast("string").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("vector"))
    while True:
        buckets = bounded_buckets(current, "id", "vector", size).select("id", "bucket").join(current, "id")

        depth = level

        def build(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("id")
            vectors = np.stack(frame["vector"].to_numpy())
            parent, name = _merge_tree(vectors), frame["bucket"].iloc[0]
            n = len(frame)
            names = list(frame["id"]) + [f"n{depth}-{name}-{k}" for k in range(len(parent) - n)]
            children: dict[int, list[int]] = {}
            for child, p in enumerate(parent):
                children.setdefault(p, []).append(child)
            protos = list(vectors) + [None] * (len(parent) - n)

            def proto(k):
                stack = [k]
                while stack:
                    top = stack[-1]
                    missing = [c for c in children.get(top, []) if protos[c] is None]
                    if missing:
                        stack.extend(missing)
                        continue
                    if protos[top] is None:
                        protos[top] = np.mean([protos[c] for c in children[top]], axis=0)
                    stack.pop()
                return protos[k]

            for k in range(len(parent)):
                proto(k)
            return pd.DataFrame({
                "node": names, "parent": [None if p == -1 else names[p] for p in parent], "level": depth, "leaf": [k < n for k in range(len(parent))],
                "vector": [list(map(float, v)) for v in protos]})

        tree = settle(buckets.groupBy("bucket").applyInPandas(build, "node string, parent string, level int, leaf boolean, vector array<double>"))
        roots = tree.filter(F.col("parent").isNull())
        # Leaves of upper levels are the roots below, already in the table.
        parts.append(tree if level == 0 else tree.filter(~F.col("leaf")))
        links = tree.filter("leaf").select("node", F.col("parent").alias("__up")) if level else None
        if links is not None:  # hang the roots of the level below under their new parents
            parts = [
                p.join(links, "node", "left").select("node", F.coalesce("parent", "__up").alias("parent"), "level", "leaf", "vector") for p in parts[:-1]
            ] + parts[-1:]
        if roots.count() <= 1:
            break
        current = settle(roots.select(F.col("node").alias("id"), "vector"))
        level += 1
    return reduce(lambda x, y: x.unionByName(y), parts)


# --- trees as tables ---------------------------------------------------------------------------------------------


def rebalance(children: DataFrame, parent: str, child: str, order: str, limit: int) -> DataFrame:
    """``(parent, child, pos)`` with at most ``limit`` children per parent.

    Children of an oversized parent are grouped in batches under new nodes, again until the parent fits; a batch of
    one stays as it is.
    """
    rows = row_numbers(children.select(F.col(parent).cast("string").alias("parent"), F.col(child).cast("string").alias("child"), F.col(order).alias("__o")), "parent", ["__o"], "pos").drop("__o")
    done, step = [], 0
    while True:
        sizes = rows.groupBy("parent").agg(F.count("*").alias("__n"))
        sized = cut_lineage(rows.join(sizes, "parent"))
        done.append(sized.filter(F.col("__n") <= limit).select("parent", "child", "pos"))
        big = sized.filter(F.col("__n") > limit)
        if big.isEmpty():
            break
        batch = F.floor((F.col("pos") - 1) / limit)
        alone = (batch == F.floor((F.col("__n") - 1) / limit)) & (F.col("__n") % limit == 1)
        named = big.withColumn("__b", batch).withColumn("__alone", alone)
        group = F.concat_ws("/", "parent", F.lit(str(step)), F.col("__b").cast("string"))
        done.append(named.filter(~F.col("__alone")).select(group.alias("parent"), "child", (F.col("pos") - F.col("__b") * limit).alias("pos")))
        upper = named.filter(~F.col("__alone")).select("parent", group.alias("child"), (F.col("__b") + 1).alias("pos")).distinct()
        rows = upper.unionByName(named.filter("__alone").select("parent", "child", (F.col("__b") + 1).alias("pos")))
        step += 1
    return reduce(lambda a, b: a.unionByName(b), done)


def prototypes(tree: DataFrame, leaves: DataFrame) -> DataFrame:
    """``(node, vector)``: every inner node of ``(node, parent)`` is the mean of its children, level by level.

    ``tree`` carries the height of each node above its deepest leaf in ``height``; leaves have height 0.
    """
    top = tree.agg(F.max("height")).first()[0]
    known = leaves.select("node", "vector")
    for height in range(1, (top or 0) + 1):
        here = tree.filter(F.col("height") == height).select(F.col("node").alias("parent"))
        kids = tree.select("node", "parent").join(here, "parent", "left_semi").join(known, "node")
        known = cut_lineage(known.unionByName(mean_vectors(kids, ["parent"]).withColumnRenamed("parent", "node")))
    return known


def summary_layers(rows: DataFrame, key: str, vector: str, text: str, cluster) -> DataFrame:
    """``(layer, id, text, vector)``: cluster, write one summary row per cluster, repeat until one row is left.

    ``cluster(df)`` maps ``(id, vector)`` to ``(id, cluster)``. The summary of a cluster is its best sentences, its
    vector the mean of its members.
    """
    layer = cut_lineage(rows.select(F.lit(0).alias("layer"), F.col(key).cast("string").alias("id"), F.col(text).alias("text"), F.transform(vector, lambda x: x.cast("double")).alias("vector")))
    out = [layer]
    depth = 0
    while (n := layer.count()) > 1:  # every layer is smaller than the one before
        depth += 1
        labels = cluster(layer.select("id", "vector")) if n > 2 else layer.select("id", F.lit(0).alias("cluster"))
        labelled = cut_lineage(layer.join(labels, "id"))
        if labelled.select("cluster").distinct().count() >= n:
            labelled = labelled.withColumn("cluster", F.lit(0))
        best = enrich.cluster_summary(labelled, "cluster", "id", "text")
        texts = best.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "sentence"))), lambda s: s["sentence"]), " ").alias("text"))
        layer = cut_lineage(mean_vectors(labelled, ["cluster"]).join(texts, "cluster", "left").select(
            F.lit(depth).alias("layer"), F.concat_ws("-", F.lit(f"s{depth}"), "cluster").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "vector"))
        out.append(layer)
    return reduce(lambda a, b: a.unionByName(b), out)


# File types that hold tables.
STRUCTURED_TYPES = (".xls", ".xlsx", ".xlsm", ".xlsb", ".csv", ".tsv")


def skips_summaries(file_type: Column, parser: Column, html_tables: Column, enabled: Column) -> Column:
    """Structured files, and PDFs read as tables, get no summary tree unless that rule is switched off."""
    kind = F.lower(F.coalesce(file_type, F.lit("")))
    kind = F.when((kind != "") & ~F.startswith(kind, F.lit(".")), F.concat(F.lit("."), kind)).otherwise(kind)
    tabular = (F.lower(F.coalesce(parser, F.lit(""))) == "table") | F.coalesce(html_tables, F.lit(False))
    return F.coalesce(enabled, F.lit(True)) & (kind.isin(*STRUCTURED_TYPES) | ((kind == ".pdf") & tabular))


def pending_summaries(docs: DataFrame, stored: DataFrame, method: str, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents still to do, stored summary rows of other methods to clean up)."""
    done = stored.filter(F.col("method") == method).select(doc).distinct()
    return docs.join(done, doc, "left_anti"), stored.filter(F.col("method") != method)
