"""Helpers shared by the text operators: row packing, words, checked broadcast."""

from __future__ import annotations

import functools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session

#: A table is broadcast only where its counted rows stay under this many bytes.
BROADCAST_BYTES = 64 << 20

#: Distinct words whose hashes one Python worker remembers before it starts afresh.
WORD_CACHE = 100_000

#: Bounds of an Arrow batch given to a Python function over texts.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

_U64 = np.uint64


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows: texts vary from words to megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES):
    """Bound Arrow batches for the jobs run inside a ``with``; the session's bounds are put back."""
    return session.arrow_batches(spark, rows, size)


def packed(docs: DataFrame, **columns: str) -> DataFrame:
    """``row`` (all columns as one struct) next to the named working columns.

    Working names cannot clash with the table's own ones this way, and
    ``select("row.*")`` gives the table back unchanged.
    """
    return docs.select(F.struct("*").alias("row"),
                       *[F.col(source).alias(name) for name, source in columns.items()])


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """Bytes of what a value of varying length holds, without its fixed part; null has none."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.StructType):
        parts = [_bytes_of(value[f.name], f.dataType) for f in kind.fields if _varies(f.dataType)]
        return functools.reduce(Column.__add__, parts, F.lit(0).cast("long"))
    if not _varies(kind.elementType):
        return F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)).cast("long") * 16
    return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + 16 + _bytes_of(x, kind.elementType)),
                      F.lit(0).cast("long"))


def _varies(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.StructType))


def measured_bytes(df: DataFrame, row_bytes: int) -> int:
    """Rows times ``row_bytes`` (the fixed part of a row) and the summed bytes of texts and arrays."""
    parts = [_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if _varies(f.dataType)]
    whole = functools.reduce(Column.__add__, parts, F.lit(row_bytes).cast("long"))
    return df.agg(F.sum(whole)).first()[0] or 0


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is under ``limit``.

    ``df`` should be a stored table, so that measuring is cheap.  A larger
    one is returned as it is and its join shuffles.
    """
    return F.broadcast(df) if measured_bytes(df, row_bytes) <= limit else df


def words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` as UTF-8: bytes.split() cuts at exactly these."""
    return text.encode().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a uint64 over the others."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd multipliers drawn from ``seed``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**63, n, dtype=np.uint64) * _U64(2) + _U64(1)


class WordHashes(dict):
    """word -> its 64-bit hash as eight bytes; forgets all once it is full."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_digest(word)
        return value

    def of(self, parts: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, parts)), dtype="<u8")


_SHINGLE = odd_constants(64, seed=5)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; of fewer words, one for the whole.

    A whole shorter than ``size`` also carries its length, so that it never
    equals a full shingle by construction.
    """
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    width = min(size, n)
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for j in range(width):
        total += hashes[j:n - width + 1 + j] * _SHINGLE[j]
    if n < size:
        total += _U64(n * int(_SHINGLE[63]) % 2**64)
    return mix(total)
