"""Default embedding: a hashed bag of tokens, built with SQL higher-order functions.

Each token goes to bucket ``int(sha256(token)[:8], 16) % dim``; the count vector
is L2-normalised and stored as ``array<float>``.  It needs no model runtime and
is computed per row (no shuffle).  A model-backed embedding can replace it: any
``array<float>`` column of unit vectors works with the search operators.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DIM = 64


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_bucket(token: Column, dim: int = DEFAULT_DIM) -> Column:
    """``int(sha256(token)[:8], 16) % dim``.

    For a dim dividing 256 only the last two of those eight hex digits matter
    (16**k is a multiple of 256 for k >= 2), so only they are parsed.
    """
    digits = 2 if 256 % dim == 0 else 8
    return (F.conv(F.substring(F.sha2(token, 256), 9 - digits, digits), 16, 10).cast("bigint") % dim).cast("int")


def unit_float(counts, norm) -> Column:
    """``counts / norm`` as ``array<float>``; the zero vector stays zero.

    Both arguments should be column references; ``norm`` is also used outside
    the lambda, which keeps the optimizer from re-inlining it per element.
    """
    c, n = _col(counts), _col(norm)
    dim = F.size(c)
    return F.when(n > 0, F.transform(c, lambda x: (x / n).cast("float"))) \
        .otherwise(F.transform(F.array_repeat(F.lit(0.0), dim), lambda x: x.cast("float")))


def with_hashed_embedding(df: DataFrame, tokens: str, out: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """Add ``out``: the unit hashed-token embedding of the ``tokens`` column.

    Per row, in a few projections (each intermediate is a column, so no
    lambda recomputes another's input): hash every token once, sort the
    bucket numbers, count the runs into a bucket -> count map, read the map
    into a dense vector, and scale it by its norm.
    """
    b, st, m, c, nrm = (f"_{out}_{x}" for x in ("b", "st", "m", "c", "n"))
    n = F.size(b)
    df = df.withColumn(b, F.array_sort(F.transform(_col(tokens), lambda t: token_bucket(t, dim))))
    df = df.withColumn(st, F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & ((i == 1) | (F.try_element_at(b, i) != F.try_element_at(b, i - 1)))))
    df = df.withColumn(m, F.map_from_arrays(
        F.transform(st, lambda x: F.try_element_at(b, x)),
        F.transform(st, lambda x, j: (F.coalesce(F.try_element_at(st, j + 2), n + 1) - x).cast("double"))))
    zeros = F.array_repeat(F.lit(0.0), dim)
    df = df.withColumn(c, F.when(F.size(m) > 0, F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0)))).otherwise(zeros))
    df = df.withColumn(nrm, F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x)))
    return df.withColumn(out, unit_float(c, nrm)).drop(b, st, m, c, nrm)


def token_buckets(tokens: pa.Array, dim: int = DEFAULT_DIM) -> np.ndarray:
    """``token_bucket`` of each token, for steps over Arrow batches."""
    digests = b"".join([hashlib.sha256(t).digest() for t in tokens.cast(pa.binary()).to_pylist()])
    return np.frombuffer(digests, ">u4")[::8].astype(np.int64) % dim  # the first eight hex digits of each


def hashed_embeddings(row: np.ndarray, bucket: np.ndarray, rows: int, dim: int = DEFAULT_DIM) -> np.ndarray:
    """The vectors of ``with_hashed_embedding`` for many rows at once, from the row and the bucket of every token."""
    counts = np.bincount(row * dim + bucket, minlength=rows * dim).reshape(rows, dim).astype(np.float64)
    norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return (counts / np.where(norm > 0, norm, 1)).astype(np.float32)


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays, in double."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)
