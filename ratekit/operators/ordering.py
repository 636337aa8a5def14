"""Global order statistics without a single-task window.

``row_number() OVER (ORDER BY …)`` and running sums over a window without
``PARTITION BY`` make Spark move every row into one task.  The helpers here
compute the same numbers in parallel:

1. range-partition the rows on the order key (Spark samples the key and
   cuts balanced ranges; equal keys land in the same range), sort inside
   each range and write the result to the reliable checkpoint folder, which
   freezes the range assignment and cuts the lineage;
2. count (or sum) per range – a table with one row per range, so its size
   is bounded by the number of ranges and it can be broadcast;
3. add the exclusive prefix over ranges to the position (or running sum)
   inside each range.

The outputs equal the single-task window exactly, and no task ever holds
more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, materialize

_POS_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits
#: Bytes on disk of the rows that make one sorted range.
RANGE_BYTES = 64 << 20


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _range_count(df: DataFrame) -> int:
    """Enough ranges for RANGE_BYTES each of a stored table, at least one per shuffle partition.

    AQE does not resize an explicit repartitionByRange, so the number follows
    the table's size on disk, which the planner knows without a job.
    """
    # by the tables it reads: the planner takes a join, even with one row, for the product of its sides
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    least = default_parallelism(df.sparkSession)
    return max(least, -(-size // RANGE_BYTES))


def _ranged(df: DataFrame, order: list[Column], n_ranges: int | None, is_stored: bool = False) -> DataFrame:
    stored = df if is_stored else materialize(df, "unordered")  # sampling and sorting read it, not its source twice
    n = n_ranges or _range_count(stored)
    return stored.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "rn",
                      n_ranges: int | None = None, stored: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row in the total order ``order``.

    Ties keep an arbitrary but fixed order, like ``row_number``; pass a
    unique key as the last order column for a reproducible result.
    ``stored``: ``df`` is read from a stored table with little work a row.
    """
    order_cols = _as_cols(order)
    ranged = _ranged(df, order_cols, n_ranges, stored)
    # After the checkpoint, partition index and row order are fixed, so the
    # id below is a pure function of the stored data.
    mid = F.monotonically_increasing_id()
    pos = ranged.select("*", F.spark_partition_id().alias("_range"),
                        (mid.bitwiseAND((1 << _POS_BITS) - 1)).alias("_pos"))
    # a range of more rows would run over the bits of its positions: fail instead
    sizes = pos.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_n", F.when(F.col("_n") <= 1 << _POS_BITS, F.col("_n")).otherwise(
            F.raise_error(F.lit("a range holds more than 2^33 rows; pass a larger n_ranges"))))
    offsets = sizes.select(
        "_range",
        F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # offsets: one row per range (≤ n_ranges rows) → bounded broadcast.
    return (pos.join(F.broadcast(offsets), "_range")
            .withColumn(out, F.col("_off") + F.col("_pos") + 1)
            .drop("_range", "_pos", "_off"))


def running_totals(df: DataFrame, order: Sequence[str | Column], values: Sequence[str],
                   prefix: str = "cum_", n_ranges: int | None = None) -> DataFrame:
    """Add inclusive running sums ``prefix+v`` of ``values`` in the order ``order``.

    The order must be a total order (unique keys) for the running sum to be
    well defined at every row; pre-aggregate duplicates first.
    """
    order_cols = _as_cols(order)
    ranged = _ranged(df, order_cols, n_ranges).withColumn("_range", F.spark_partition_id())
    totals = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                    for v in values])
    inside = Window.partitionBy("_range").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(F.broadcast(offsets), "_range")
    for v in values:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.sum(v).over(inside))
    return out.drop("_range", *[f"_o_{v}" for v in values])
