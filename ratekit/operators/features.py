"""Feature engineering: scaling, encodings, joins, noise, assembly.

Fit/transform pairs return small fitted tables (one row of statistics, a
category domain, an id mapping) that the caller can persist and reuse on
new data.  Statistics tables are joined as broadcasts only where their size
is bounded by construction (one row, or one row per category of a guarded
small domain); id mappings, which grow with the data, are joined with
ordinary (AQE-planned) joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import materialize
from .ordering import global_row_number

# --- O-15 standard scaling -----------------------------------------------------

def fit_standard_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``<c>_mean`` and ``<c>_std`` (population std) per column.

    Nulls are ignored by the fit.  A zero (or undefined) spread is stored as
    1 so that transform leaves the centred value.
    """
    aggs = []
    for c in columns:
        x = F.col(f"`{c}`").cast("double")
        aggs.append(F.avg(x).alias(f"{c}_mean"))
        std = F.stddev_pop(x)
        aggs.append(F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std).alias(f"{c}_std"))
    return df.agg(*aggs)


def transform_standard_scaler(df: DataFrame, stats: DataFrame, columns: Sequence[str],
                              suffix: str = "") -> DataFrame:
    """z = (x − mean)/std with the fitted one-row table (broadcast: 1 row)."""
    joined = df.crossJoin(F.broadcast(stats))
    for c in columns:
        z = (F.col(f"`{c}`").cast("double") - F.col(f"{c}_mean")) / F.col(f"{c}_std")
        joined = joined.withColumn(f"{c}{suffix}", z)
    return joined.drop(*[f"{c}_mean" for c in columns], *[f"{c}_std" for c in columns])


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                   suffix: str = "") -> DataFrame:
    """Fit on ``fit_on`` (default: ``df`` itself) and transform ``df``."""
    stats = fit_standard_scaler(fit_on if fit_on is not None else df, columns)
    return transform_standard_scaler(df, stats, columns, suffix)


# --- O-14 one-hot --------------------------------------------------------------

def category_domain(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values of a code column: one row per future column."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, columns: Sequence[str],
            domains: dict[str, Sequence] | None = None) -> DataFrame:
    """Replace each categorical column by ``<col>_<value>`` 0/1 INT columns.

    Values come in sorted order and the new columns go to the end, the
    source column is removed.  ``domains`` fixes the values (a code
    table) so that unseen values give all-zero rows, the schema does not
    depend on the data and no job runs while the plan is built; a column
    without one takes the values met in the data.
    """
    domains = dict(domains or {})
    out = df
    for c in columns:
        values = domains.get(c)
        if values is None:
            values = category_domain(df, c)
        flags = [F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}") for v in values]
        out = out.select(*[x for x in out.columns if x != c], *flags)
    return out


def category_dictionary(df: DataFrame, column: str, least: int = 1) -> DataFrame:
    """Stored (value, code, n): every non-null value met ``least`` times or more, its dense code and count.

    Codes follow the sorted values and come from a range-partitioned row
    number, so a domain of any size is neither collected nor sorted in one
    task.  Store it with a model and encode new rows by it.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ranked = global_row_number(counts.where(F.col("n") >= least), ["value"], out="_rn")
    return materialize(ranked.select("value", (F.col("_rn") - 1).alias("code"), "n"), "categories")


def sparse_one_hot(df: DataFrame, column: str, dictionary: DataFrame, out: str | None = None, hot: int = 100_000,
                   salts: int = 32) -> DataFrame:
    """Add ``out`` = struct(size, indices, values): the one-hot vector of an open domain, as its one place.

    ``size`` is the number of codes.  A null or unknown value has no place
    (an all-zero vector).  Values met more than ``hot`` times when the
    dictionary was made are joined apart: their dictionary rows, at most
    rows / ``hot`` of them, are repeated for ``salts`` salts and the rows
    that hold them spread over those, so that one value is not one task.
    The join strategies are AQE's.
    """
    out = out or f"{column}_onehot"
    size = dictionary.agg(F.coalesce(F.max("code") + 1, F.lit(0)).alias("_size"))  # one row
    keyed = dictionary.select(F.col("value").alias("_value"), F.col("code").alias("_code"), F.col("n").alias("_n"))
    heavy = keyed.where(F.col("_n") > hot).select(
        "_value", "_code", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    rare = keyed.where(F.col("_n") <= hot).select("_value", "_code", F.lit(0).alias("_salt"))
    # a row looks under its own salt and, once, under that of the rare values
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    rows = df.withColumn("_own", own)
    first = rows.join(heavy, (F.col(column) == F.col("_value")) & (F.col("_own") == F.col("_salt")), "left").drop("_value", "_salt")
    known = F.col("_code").isNotNull()
    look = F.when(~known, F.col(column))  # rows that found a heavy value look no further
    second = first.withColumn("_look", look).join(rare.withColumnRenamed("_code", "_rare"),
                                                  F.col("_look") == F.col("_value"), "left")
    code = F.coalesce("_code", "_rare")
    vector = F.struct(F.col("_size").alias("size"),
                      F.when(code.isNull(), F.array().cast("array<bigint>")).otherwise(F.array(code)).alias("indices"),
                      F.when(code.isNull(), F.array().cast("array<double>")).otherwise(F.array(F.lit(1.0))).alias("values"))
    return second.crossJoin(F.broadcast(size)).select(*[F.col(f"`{c}`") for c in df.columns], vector.alias(out))


# --- O-16 label encoding -------------------------------------------------------

def fit_label_encoder(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """(column, out) – dense 0-based index of each distinct value in sorted order.

    Distinct values are ranked with the range-partitioned global row
    number, so no single task sees all ids.
    """
    out = out or f"{column}_idx"
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = global_row_number(distinct, [column], out="_rn")
    return ranked.select(column, (F.col("_rn") - 1).cast("long").alias(out))


def label_encode(df: DataFrame, column: str, mapping: DataFrame | None = None,
                 out: str | None = None) -> DataFrame:
    """Join the dense index onto ``df``; unseen values give null."""
    out = out or f"{column}_idx"
    mapping = mapping if mapping is not None else fit_label_encoder(df, column, out)
    return df.join(mapping, column, "left")


def id_cardinality(df: DataFrame, column: str) -> Column:
    """max(id) + 1 – table size for raw (unencoded) ids."""
    return (F.max(column) + 1).alias(f"n_{column}")


# --- O-13, O-33, O-34 feature matrix ------------------------------------------

def feature_matrix(ratings: DataFrame, users: DataFrame, items: DataFrame,
                   user_key: str = "user_id", item_key: str = "item_id",
                   fill: float = 0) -> DataFrame:
    """ratings ⟕ users ⟕ items on the id keys, then numeric nulls → ``fill``.

    No broadcast hint: user and item tables grow with the data, so the join
    strategy is left to AQE, which broadcasts them only when their measured
    size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and
    otherwise plans a sort-merge join (splitting skewed keys).
    """
    joined = ratings.join(users, user_key, "left").join(items, item_key, "left")
    return joined.na.fill(fill)


def assemble(columns: Sequence[str], out: str = "features") -> Column:
    """Cast the named columns to double and pack them into one array."""
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias(out)


# --- O-18 multiplicative noise ------------------------------------------------

def multiplicative_noise(df: DataFrame, columns: Sequence[str], sigma: float, key: str,
                         seed: int = 42, train_mask: Column | None = None) -> DataFrame:
    """x · (1 + N(0, σ)) per cell, with the normal drawn from a hash of
    (row key, column, seed) so the result is reproducible under any
    partitioning.  Zero stays zero, null stays null.  ``train_mask`` limits
    the noise to the rows where it is true (e.g. the training split)."""
    out = df
    for c in columns:
        eps = C.hash_normal(F.col(key), F.lit(c), F.lit(seed))
        x = F.col(f"`{c}`")
        # most cells of one-hot columns are zero: no hash is made for those
        noisy = F.when(x == 0, x.cast("double")).otherwise(x * (F.lit(1.0) + F.lit(float(sigma)) * eps))
        if train_mask is not None:
            noisy = F.when(train_mask, noisy).otherwise(F.col(f"`{c}`").cast("double"))
        out = out.withColumn(c, noisy)
    return out


# --- O-35 embedding lookup ----------------------------------------------------

def lookup_vectors(df: DataFrame, factors: DataFrame, key: str, factor_key: str,
                   vector: str, out: str) -> DataFrame:
    """Left equi-join of a factor table (id → vector) onto ``df``.

    Factor tables grow with the number of ids, so the strategy is AQE's:
    broadcast when measured small, otherwise a shuffle join.
    """
    f = factors.select(F.col(factor_key).alias(f"_{out}_key"), F.col(vector).alias(out))
    return df.join(f, F.col(key) == F.col(f"_{out}_key"), "left").drop(f"_{out}_key")


#: Different ids of a factor table up to which their counts are broadcast (some 40 bytes each).
BROADCAST_IDS = 1_000_000


def lookup_both(df: DataFrame, factors: DataFrame, first: str, second: str, factor_key: str, vector: str) -> DataFrame:
    """Both lookups of ``df``: adds ``has_u``, ``has_v`` (0/1) and, on rows with both vectors, ``u`` and ``v``.

    The rows are those of two calls of ``lookup_vectors``, repeated ids included,
    but which ids have a vector is found from the ids alone, so that a
    vector, many times as wide as a row, is moved only with rows that have both.
    """
    ids = materialize(factors.where(F.col(factor_key).isNotNull()).groupBy(F.col(factor_key).alias("_id")).agg(
        F.count("*").alias("_n"), F.count(vector).alias("_f")), "factor-ids")
    small = ids.count() <= BROADCAST_IDS
    x = df
    for key, name in ((first, "u"), (second, "v")):
        own = ids.select(F.col("_id").alias(f"_{name}_id"), F.col("_n").alias(f"_{name}_n"), F.col("_f").alias(f"_{name}_f"))
        x = x.join(F.broadcast(own) if small else own, F.col(key) == F.col(f"_{name}_id"), "left")
        x = x.withColumn(f"_{name}_n", F.coalesce(f"_{name}_n", F.lit(1))).withColumn(
            f"_{name}_f", F.coalesce(f"_{name}_f", F.lit(0)))
    both = (F.col("_u_f") > 0) & (F.col("_v_f") > 0)
    full = lookup_vectors(x.where(both).select(*df.columns), factors, first, factor_key, vector, "u")
    full = lookup_vectors(full, factors, second, factor_key, vector, "v")
    has = lambda c: F.col(c).isNotNull().cast("int").alias(f"has_{c}")
    full = full.select(*df.columns, has("u"), has("v"), "u", "v")
    # of the other rows one id at most has vectors: they are repeated by the counts alone
    with_u, with_v = F.col("_u_f") * F.col("_v_n"), F.col("_v_f") * F.col("_u_n")
    times = lambda u, v, n: F.array_repeat(F.struct(F.lit(u).alias("has_u"), F.lit(v).alias("has_v")), n.cast("int"))
    rows = F.explode(F.concat(times(1, 0, with_u), times(0, 1, with_v),
                              times(0, 0, F.col("_u_n") * F.col("_v_n") - with_u - with_v)))
    none = F.lit(None).cast(factors.schema[vector].dataType)
    rest = x.where(~both).select(*df.columns, rows.alias("_has")).select(
        *df.columns, "_has.has_u", "_has.has_v", none.alias("u"), none.alias("v"))
    return full.unionByName(rest)
