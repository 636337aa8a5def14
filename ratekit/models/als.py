"""Alternating least squares: the baseline that a jointly trained model has to beat.

Factor blocks are shuffled between iterations and the tables grow with the
ids, never through the driver.  All ratings of one id are solved in one
block, so an id with a large share of all ratings is one task there; this
is ALS's own limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import features as FE
from ..session import materialize

#: ALS takes 32-bit ids: a limit of Spark's implementation.
INT_MAX = 2**31 - 1


def _int_id(name: str) -> Column:
    return F.when(F.col(name) <= INT_MAX, F.col(name).cast("int")).otherwise(
        F.raise_error(F.lit(f"{name} exceeds the int range that ALS supports")))


@dataclass
class Factors:
    """Stored factor tables by raw id, and the vectors of ids they do not know."""
    users: DataFrame
    items: DataFrame
    mean_u: list[float]
    mean_v: list[float]

    def score(self, df: DataFrame, out: str = "als_score") -> DataFrame:
        """Add the predicted rating.  The tables grow with the ids: AQE picks the joins."""
        lit = lambda v: F.array(*[F.lit(x) for x in v])
        joined = df.join(self.users, "user_id", "left").join(self.items, "item_id", "left")
        u, v = F.coalesce("u", lit(self.mean_u)), F.coalesce("v", lit(self.mean_v))
        return joined.withColumn(out, C.dot(u, v)).drop("u", "v")


def _mean(factors: DataFrame, vector: str, rank: int) -> list[float]:
    row = factors.select(vector_to_array(Summarizer.mean(array_to_vector(vector)))).first()
    return [float(x) for x in row[0]] if row[0] else [0.0] * rank


def fit_als(train: DataFrame, rank: int = 16, iterations: int = 8, reg: float = 0.1, seed: int = 42,
            checkpoint_interval: int = 5) -> Factors:
    """Factors of (user_id, item_id, rating) rows; ids are encoded densely first."""
    users = materialize(FE.fit_label_encoder(train, "user_id", "user_idx"), "user-index")
    items = materialize(FE.fit_label_encoder(train, "item_id", "item_idx"), "item-index")
    encoded = materialize(train.join(users, "user_id").join(items, "item_id").select(
        _int_id("user_idx").alias("user_idx"), _int_id("item_idx").alias("item_idx"),
        F.col("rating").cast("float").alias("rating")), "encoded-ratings")
    model = ALS(rank=rank, maxIter=iterations, regParam=reg, userCol="user_idx", itemCol="item_idx", ratingCol="rating",
                coldStartStrategy="nan", seed=seed, checkpointInterval=checkpoint_interval).fit(encoded)

    def by_id(factors, ids, key, out):
        vectors = factors.select(F.col("id").cast("long").alias(f"{key}_idx"),
                                 C.cast_vector("features", size=rank).alias(out))
        return materialize(vectors.join(ids, f"{key}_idx").select(f"{key}_id", out), f"{key}-factors")

    u, v = by_id(model.userFactors, users, "user", "u"), by_id(model.itemFactors, items, "item", "v")
    return Factors(u, v, _mean(u, "u", rank), _mean(v, "v", rank))
