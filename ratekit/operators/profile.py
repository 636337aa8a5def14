"""Table profiling: null counts, duplicates, distributions, histograms.

Every profile is one aggregation job (partial aggregation on the map side,
a shuffle of at most one row per group) and returns a small DataFrame in
long form, ready to be written as a report table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stack(pairs: list[tuple[str, str]], key: str, value: str) -> str:
    body = ", ".join(f"'{name}', {expr}" for name, expr in pairs)
    return f"stack({len(pairs)}, {body}) AS ({key}, {value})"


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count BIGINT) for every column, in schema order."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n{i}")
                    for i, c in enumerate(cols)])
    pairs = [(c, f"coalesce(n{i}, 0L)") for i, c in enumerate(cols)]
    return wide.selectExpr(_stack(pairs, "column_name", "null_count"))


def all_null_columns(df: DataFrame) -> DataFrame:
    """(column_name, non_null BIGINT, all_null BOOLEAN) – columns with no value at all."""
    cols = df.columns
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = [(c, f"n{i}") for i, c in enumerate(cols)]
    return (wide.selectExpr(_stack(pairs, "column_name", "non_null"))
            .withColumn("all_null", F.col("non_null") == 0))


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value (one small aggregation decides)."""
    empty = [r["column_name"] for r in all_null_columns(df).filter("all_null").collect()]
    return df.drop(*empty)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove rows with a null in any (or any of ``subset``) column."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, distinct_rows, duplicates): rows equal to an earlier row, nulls equal.

    One grouping over all columns (map-side combined) instead of a count
    plus a distinct count; a hot duplicate group stays one partial row.
    """
    cols = list(columns or df.columns)
    groups = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.col("_n") - 1).cast("long").alias("duplicates"),
    )


def value_counts(df: DataFrame, column: str, by: str = "key",
                 domain: Sequence | None = None) -> DataFrame:
    """(column, count) sorted by key ascending or by count descending.

    With ``domain`` the result holds every domain value, zero-filled.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if domain is not None:
        spark = df.sparkSession
        dom = spark.createDataFrame([(v,) for v in domain], [column])
        dom = dom.select(F.col(column).cast(df.schema[column].dataType).alias(column))
        # the counts of a short literal list of values, one row each, are the build side
        counts = (dom.join(F.broadcast(counts.where(F.col(column).isin(list(domain)))), column, "left")
                  .select(column, F.coalesce("count", F.lit(0)).cast("long").alias("count")))
    if by == "key":
        return counts.orderBy(column)
    return counts.orderBy(F.desc("count"), F.asc(column))


def column_totals(df: DataFrame, columns: Sequence[str], key: str = "column_name",
                  value: str = "total") -> DataFrame:
    """Sum of each (0/1 flag) column, in long form (multi-hot totals)."""
    wide = df.agg(*[F.sum(F.col(f"`{c}`")).cast("long").alias(f"s{i}")
                    for i, c in enumerate(columns)])
    pairs = [(c, f"coalesce(s{i}, 0L)") for i, c in enumerate(columns)]
    return wide.selectExpr(_stack(pairs, key, value))


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column_name, distinct_count) – exact by default, HyperLogLog++ on request.

    All columns in one aggregation, so the input is scanned once (Spark
    expands each row once per distinct column and deduplicates map-side).
    """
    aggs = [(F.countDistinct(c) if exact else F.approx_count_distinct(c)).cast("long")
            .alias(f"d{i}") for i, c in enumerate(columns)]
    pairs = [(c, f"d{i}") for i, c in enumerate(columns)]
    return df.agg(*aggs).selectExpr(_stack(pairs, "column_name", "distinct_count"))


def unique_percentage(df: DataFrame, column: str) -> DataFrame:
    """(rows, distinct_values, unique_pct) with pct = distinct / rows · 100."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.countDistinct(column).alias("distinct_values")).select(
        "rows", "distinct_values",
        (F.col("distinct_values") / F.col("rows") * 100).alias("unique_pct"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, lo, hi, count) with ``bins`` equal-width bins over [min, max].

    Bin = floor((x − min)/(max − min) · bins); the maximum folds into the
    last bin.  A constant column puts everything in bin 0.  The one-row
    min/max table is joined as a broadcast (size 1).
    """
    x = F.col(column).cast("double")
    stats = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    binned = (df.select(x.alias("_x")).where(F.col("_x").isNotNull())
              .crossJoin(F.broadcast(stats))
              .select(F.when(width == 0, F.lit(0)).otherwise(
                  F.least(F.lit(bins - 1),
                          F.floor((F.col("_x") - F.col("_lo")) / width * bins).cast("int")))
                      .alias("bin")))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(stats))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (F.col("_lo") + F.col("bin") * w).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy("bin"))


def quantile_points(df: DataFrame, column: str, shares: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """One row: count, least, greatest and ``q``, the value of each share, of a numeric column's finite values.

    The quantiles come from Spark's mergeable summary (Greenwald and Khanna):
    a value's rank is off by at most count / ``accuracy``, so up to that many
    values they are exact, and partitions only send their summaries.
    """
    x = F.col(column).cast("double")
    finite = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") < float("inf")))
    return finite.agg(F.count("*").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"),
                      F.percentile_approx("_x", [float(s) for s in shares], accuracy).alias("q"))


#: Automatic histograms have at most so many bins; more are widened to fit.
MAX_BINS = 10_000


def automatic_bins(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """One row (n, lo, hi, bins, width): bins as the data ask for, in one pass.

    The wider count of two rules is taken: Sturges, log2(n) + 1 bins, and
    Freedman and Diaconis, bins of 2 (q3 - q1) / n^(1/3), where the
    interquartile range is not zero.  A rank error e moves a quartile to a
    value at most e of the rows away (`quantile_points`), and the number of
    bins changes by the same factor as the range between them.  A column of
    one value has one bin; a column without values no row.
    """
    p = quantile_points(df, column, (0.25, 0.75), accuracy).where("n > 0")
    spread, iqr = F.col("hi") - F.col("lo"), F.col("q")[1] - F.col("q")[0]
    n = F.col("n").cast("double")
    sturges = spread / (F.log2(n) + 1)
    diaconis = F.when(iqr > 0, 2 * iqr / F.cbrt(n))
    bins = F.when(spread == 0, 1).otherwise(F.least(F.lit(MAX_BINS), F.ceil(spread / F.least(sturges, diaconis))))
    out = p.select("n", "lo", "hi", bins.cast("int").alias("bins"))
    return out.withColumn("width", (F.col("hi") - F.col("lo")) / F.col("bins"))


def automatic_histogram(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """(bin, lo, hi, count) over the bins of `automatic_bins`, empty ones included."""
    auto = automatic_bins(df, column, accuracy).select(
        F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("bins").alias("_bins"), F.col("width").alias("_width"))
    x = F.col(column).cast("double")
    finite = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") < float("inf")))
    spread = F.col("_hi") - F.col("_lo")
    place = F.when(spread == 0, F.lit(0)).otherwise(F.least(
        F.col("_bins") - 1, F.floor((F.col("_x") - F.col("_lo")) / spread * F.col("_bins")).cast("int")))
    counts = finite.crossJoin(F.broadcast(auto)).groupBy(place.alias("bin")).agg(F.count("*").alias("count"))  # one row
    grid = auto.select("*", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)).alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy("bin"))


def split_sizes(df: DataFrame, split_col: str = "split", user: str = "user_id",
                item: str = "item_id") -> DataFrame:
    """(split, rows, users, items) for a split assignment."""
    return (df.groupBy(split_col)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.countDistinct(user).alias("users"),
                 F.countDistinct(item).alias("items"))
            .orderBy(split_col))
