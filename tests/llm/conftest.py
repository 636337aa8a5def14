import os

import duckdb
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels"]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) with columns whose names clash with working ones."""
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("lang", StringType()), StructField("source", StringType()),
                         StructField("n_chars", LongType()), StructField("row", StringType()),
                         StructField("kept", StringType()), StructField("n_words", StringType())])

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", None) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
