"""Measured broadcasts and scoped Arrow batches."""

from pyspark.sql import functions as F
from ratekit.llm import common as CM


def test_sizes_are_measured_in_texts_arrays_and_structs(spark):
    df = spark.createDataFrame([(1, "ab", [1, 2], ["xy", None], ("é", 5)), (2, None, None, None, None)],
                               "i int, t string, a array<long>, s array<string>, r struct<u:string, v:int>")
    assert CM.measured_bytes(df.select("i"), 10) == 20
    assert CM.measured_bytes(df.select("t"), 0) == 2
    assert CM.measured_bytes(df.select("a"), 0) == 2 * 16
    assert CM.measured_bytes(df.select("s"), 0) == 2 * 16 + 2
    assert CM.measured_bytes(df.select("r"), 0) == 2
    assert CM.measured_bytes(df.limit(0), 10) == 0


def test_one_huge_text_is_not_broadcast(spark):
    small = spark.range(3).withColumn("t", F.lit("x"))
    huge = small.withColumn("t", F.repeat("t", 10 << 20))
    plan = lambda df: CM.broadcast_if_small(df, 16, 16 << 20)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(small).lower() and "broadcast" not in plan(huge).lower()


def test_arrow_bounds_are_put_back(spark):
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(rows, None), spark.conf.get(size, None)
    with CM.arrow_batches(spark, 7, 1000):
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("7", "1000")
    assert (spark.conf.get(rows, None), spark.conf.get(size, None)) == before
