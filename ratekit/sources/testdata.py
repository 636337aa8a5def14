"""Adapters from the driver's star-schema tables to the rating data model.

No rating data ships with the test tables, so ratings, users and items are
derived from them by fixed rules (each one mirrored in ``plans/oracle.py``):

* ratings  – one row per lineitem joined to its order: the customer rates
  the part; quantity 1..50 maps onto rating 1..5; ``k`` is an md5 row key
  (unique, and a stable pseudo-random order); ``pred`` is a deterministic
  stand-in prediction used by every evaluation operator.
* users    – customers: age from account balance, gender from key parity,
  occupation from market segment, zip code from the nation key.
* items    – parts: a ``d-MMM-yyyy`` release date (null on every 97th key),
  an all-null video date, and multi-hot "genre" flags from type and size.

All of these are narrow projections over the scans, so Catalyst prunes
columns at the Parquet reader; the only shuffle is the lineitem-orders
join, which at scale is a sort-merge join on the order key.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Part types of the test tables that become genre flags, in
# sorted order, and the month abbreviations used for release dates.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# The code tables of the derived users.
GENDERS = ["F", "M"]
OCCUPATIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

GENRES = [f"g_{t.lower()}" for t in PART_TYPES] + ["g_tiny"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rating_of(quantity: Column) -> Column:
    """Quantity 1..50 → rating 1..5 in bands of ten."""
    return (F.lit(1) + F.floor((quantity - 1) / 10)).cast("int")


def row_key(epoch: Column) -> Column:
    """md5 over the columns of a line: unique, and a stable pseudo-random order."""
    return F.md5(F.concat_ws(
        "|",
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.col("l_quantity").cast("int").cast("string"), epoch.cast("string")))


def ratings(spark: SparkSession, sf_dir: str, users: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, rating, ts, k, pred) – one row per lineitem.

    ``users``, a row a user_id: its other columns are added, by way of the orders, which are fewer.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    added = [c for c in users.columns if c != "user_id"] if users is not None else []
    if added:
        orders = orders.join(users, F.col("o_custkey") == F.col("user_id"), "left").drop("user_id")
    epoch = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    rating = rating_of(F.col("l_quantity"))
    key = row_key(epoch)
    noise = (((F.col("l_orderkey") * 31 + F.col("l_partkey") * 17) % 1001) - 500) / F.lit(250.0)
    return (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            rating.alias("rating"),
            epoch.alias("ts"),
            key.alias("k"),
            F.round(rating + noise, 6).alias("pred"),
            *added,
        )
    )


def planted_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, user_id, item_id, rating): the same rows with ratings that can be learnt.

    A user effect, an item effect, their product of two residues and a small
    noise from the order and line keys, in integer arithmetic: the sum is cut
    into steps of 8 around 3 and clipped to 1..5.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    user, item = F.col("o_custkey"), F.col("l_partkey")
    signal = (2 * ((user * 7919) % 11 - 5) + 2 * ((item * 104729) % 11 - 5)
              + 2 * (user % 7 - 3) * (item % 5 - 2)
              + (F.col("l_orderkey") * 31 + item * 17 + F.col("l_linenumber") * 13) % 5 - 2)
    rating = F.least(F.lit(5), F.greatest(F.lit(1), F.floor((signal + 4 + 80) / 8) - 10 + 3)).cast("int")
    epoch = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        row_key(epoch).alias("k"), user.alias("user_id"), item.alias("item_id"), rating.alias("rating"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, age, gender, occupation, zip_code) from customers."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        (F.lit(18) + F.floor((F.col("c_acctbal") + 1000) / 200)).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("occupation"),
        F.col("c_nationkey").cast("string").alias("zip_code"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title, release_date, video_release_date, url, g_*) from parts."""
    p = table(spark, sf_dir, "part")
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]),
                         (F.col("p_partkey") % 12 + 1).cast("int"))
    date_text = F.concat(
        (F.col("p_size") % 28 + 1).cast("string"), F.lit("-"), month, F.lit("-"),
        (F.col("p_size") + 1950).cast("string"))
    flags = [F.when(F.col("p_type") == t, 1).otherwise(0).alias(f"g_{t.lower()}")
             for t in PART_TYPES]
    flags.append(F.when(F.col("p_size") <= 10, 1).otherwise(0).alias("g_tiny"))
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_partkey") % 97 == 0, F.lit(None).cast("string"))
        .otherwise(date_text).alias("release_date"),
        F.lit(None).cast("string").alias("video_release_date"),
        F.col("p_brand").alias("url"),
        *flags,
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, user_id, item_id, actual, prediction) – the scalar-score table."""
    r = ratings(spark, sf_dir)
    return r.select("k", "user_id", "item_id",
                    F.col("rating").alias("actual"), F.col("pred").alias("prediction"))


def class_probabilities(prediction: Column) -> Column:
    """Five class probabilities from a scalar score: w_i = 1/(1+|p-i|), p = w/Σw."""
    w = [F.lit(1.0) / (F.lit(1.0) + F.abs(prediction - F.lit(float(c)))) for c in range(1, 6)]
    total = w[0]
    for x in w[1:]:
        total = total + x
    return F.array(*[x / total for x in w])


def scored_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, user_id, item_id, actual, probabilities ARRAY<DOUBLE>[5])."""
    s = scored(spark, sf_dir)
    return s.select("k", "user_id", "item_id", "actual",
                    class_probabilities(F.col("prediction")).alias("probabilities"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, embedding ARRAY<DOUBLE>, label) – float vectors widened once."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
                    "label")
