"""Readers for the raw delimited files and writers for the table layers.

Raw files are headerless (tab- or pipe-separated); the structured and
processed layers are Parquet (a CSV-with-header option is kept for
interchange).  Schemas are always explicit, and rows that do not fit the
schema fail the read (FAILFAST) instead of turning silently into nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import date_text_to_epoch


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str,
                   header: bool = False, encoding: str = "UTF-8") -> DataFrame:
    return (spark.read.schema(schema)
            .option("sep", sep).option("header", header).option("encoding", encoding)
            .option("mode", "FAILFAST").option("nullValue", "")
            .csv(path))


def read_raw_ratings(spark: SparkSession, path: str,
                     schema: T.StructType = schemas.RAW_RATINGS) -> DataFrame:
    """Headerless tab-separated ratings (user, item, rating, unix seconds)."""
    return read_delimited(spark, path, schema, "\t")


def read_raw_items(spark: SparkSession, path: str,
                   schema: T.StructType = schemas.RAW_ITEMS) -> DataFrame:
    """Headerless pipe-separated items in latin-1."""
    return read_delimited(spark, path, schema, "|", encoding="ISO-8859-1")


def read_raw_users(spark: SparkSession, path: str,
                   schema: T.StructType = schemas.RAW_USERS) -> DataFrame:
    """Headerless pipe-separated users (zip code kept as text)."""
    return read_delimited(spark, path, schema, "|")


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_delimited(spark, path, schema, ",", header=True)


def structure_items(items: DataFrame, date_col: str = "release_date") -> DataFrame:
    """Raw items → structured layer: release date text becomes epoch seconds."""
    return items.withColumn(date_col, date_text_to_epoch(F.col(date_col)))


def write_layer(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a layer table; ``fmt='csv'`` writes CSV with a header."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str, encoding: str = "UTF-8",
                    header: bool = False) -> None:
    """Write in a raw delimited layout (used for round-trip checks)."""
    (df.write.mode("overwrite").option("sep", sep).option("header", header)
     .option("encoding", encoding).option("nullValue", "").option("emptyValue", "")
     .csv(path))
