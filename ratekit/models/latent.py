"""Latent-space views: centred PCA with explained variance (O-72)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def centred_pca(df: DataFrame, vector: str, k: int = 2, keep: tuple = ()) -> tuple[DataFrame, list]:
    """Project an array column onto its first ``k`` principal components.

    Spark's PCA does not centre the data before projecting, so the vectors
    are centred first (mean only, no scaling).  The covariance is a d×d
    distributed aggregate; the whole table is used, not a sample.  Returns
    (rows with pc_1..pc_k, explained-variance ratios).
    """
    v = df.select(*keep, array_to_vector(F.col(vector)).alias("_v"))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(v)
    c = centred.transform(v)
    model = PCA(k=k, inputCol="_c", outputCol="_pc").fit(c)
    out = model.transform(c).select(*keep, vector_to_array("_pc").alias("_a"))
    out = out.select(*keep, *[F.col("_a")[i].alias(f"pc_{i + 1}") for i in range(k)])
    return out, [float(x) for x in model.explainedVariance.toArray()]


# --- many dimensions: a randomised range finder ------------------------------------------------

def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _added(df: DataFrame, vector: str, part, size: int) -> np.ndarray:
    """Sum over all rows of ``part`` (rows matrix → flat array of ``size`` numbers), tasks added up in the JVM."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += part(_rows(b))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["t"])

    sums = df.select(F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL").mapInArrow(local, "t array<double>")
    row = sums.agg(vector_to_array(Summarizer.sum(array_to_vector("t"))).alias("t")).first()
    return np.asarray(row["t"]) if row["t"] else np.zeros(size)


def randomised_pca(df: DataFrame, vector: str, k: int = 2, keep: tuple = (), extra: int = 8, rounds: int = 4,
                   seed: int = 42) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """First ``k`` principal components without the d × d covariance (Halko, Martinsson and Tropp, 2011).

    A random d × (k + extra) basis is turned onto the leading subspace by
    ``rounds`` passes: every task adds up Xᵀ(X·B) of its rows, a d × (k +
    extra) matrix, the sums are orthonormalised, and a last pass solves the
    small problem inside the basis.  The dimension is bounded by the basis,
    not by its square, and rows never leave their task.  Returns (rows with
    pc_1..pc_k, variance of each component, the components as rows, each with
    its largest entry positive).  Null vectors are left out of the fit and
    projected to null; a table without vectors is an error.
    """
    d = df.select(F.max(F.size(vector)).alias("d")).first()["d"]
    if not d or d < 1:
        raise ValueError("no vectors to take components of")
    moments = _added(df, vector, lambda x: np.concatenate([[len(x)], x.sum(axis=0), [np.square(x).sum()]]), d + 2)
    n, mean = moments[0], moments[1:-1] / moments[0]
    width = min(d, k + extra)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    for _ in range(rounds):
        b = basis
        pulled = _added(df, vector, lambda x: ((x - mean).T @ ((x - mean) @ b)).reshape(-1), d * width)
        basis = np.linalg.qr(pulled.reshape(d, width))[0]
    b = basis
    inner = _added(df, vector, lambda x: (((x - mean) @ b).T @ ((x - mean) @ b)).reshape(-1), width * width)
    values, turn = np.linalg.eigh(inner.reshape(width, width))
    order = np.argsort(-values)[:k]
    parts = (basis @ turn[:, order]).T
    parts *= np.sign(parts[np.arange(len(parts)), np.abs(parts).argmax(axis=1)])[:, None]
    centred = F.transform(F.col(vector), lambda x, i: x - F.get(F.lit(mean.tolist()), i))
    dots = [F.aggregate(F.zip_with(centred, F.lit(p.tolist()), lambda a, c: a * c), F.lit(0.0), lambda s, x: s + x)
            .alias(f"pc_{i + 1}") for i, p in enumerate(parts)]
    return df.select(*keep, *dots), values[order] / max(n - 1, 1), parts
