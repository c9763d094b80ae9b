"""Dense vectors held as arrays: cosine, blending, and a hashed bag-of-words embedding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions import text as X


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; zero vectors give 0."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def unit(a: Column) -> Column:
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length)).otherwise(F.transform(a, lambda x: F.lit(0.0)))


def blend(a: Column, b: Column, weight: float) -> Column:
    return F.zip_with(a, b, lambda x, y: F.lit(weight) * x.cast("double") + F.lit(1 - weight) * y.cast("double"))


def fit_dimension(a: Column, dim: int) -> Column:
    """The vector when it has ``dim`` entries, zeros otherwise (also when missing)."""
    return F.when(F.size(a) == dim, a).otherwise(F.array_repeat(F.lit(0.0).cast("float"), dim))


def bucket(term: Column, dim: int) -> Column:
    """Bucket of a term: its MD5 prefix modulo the dimension."""
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")


def hash_embedding(text: Column, dim: int = 64) -> Column:
    """Counts of hashed tokens; deterministic, needs no model. Cosine makes the length irrelevant."""
    dims = F.sequence(F.lit(0), F.lit(dim - 1))
    # Transforming a one-element array binds the buckets once, so they are not computed again per dimension.
    if dim <= 64:
        # One ASCII character stands for a bucket: removing it from the text of all buckets counts it without a call per token.
        letter = lambda b: F.char(b + F.lit(48))
        marks = F.array(F.array_join(F.transform(X.tokens(text), lambda t: letter(bucket(t, dim))), ""))
        return F.transform(marks, lambda m: F.transform(dims, lambda d: (F.octet_length(m) - F.octet_length(F.replace(m, letter(d), F.lit("")))).cast("double")))[0]
    buckets = F.array(F.transform(X.tokens(text), lambda t: bucket(t, dim)))
    return F.transform(buckets, lambda b: F.transform(dims, lambda d: F.size(F.filter(b, lambda x: x == d)).cast("double")))[0]
