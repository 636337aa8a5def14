"""Score a stream of new ratings with a fitted rating model.

The model's transform is a chain of stream–static joins with the embedding
rows and a projection, so it applies to a streaming DataFrame unchanged; no
state is kept between micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..models.rating_models import RatingModel


def read_rating_stream(spark: SparkSession, path: str, schema: T.StructType,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream (explicit schema)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def score_stream(model: RatingModel, stream: DataFrame, columns=("k", "user_id", "item_id",
                                                                  "prediction", "predicted")) -> DataFrame:
    return model.transform(stream).select(*columns)


def write_scores(scored: DataFrame, path: str, checkpoint: str,
                 once: bool = False) -> StreamingQuery:
    """Append scores as Parquet; the checkpoint folder makes restarts exactly-once."""
    w = (scored.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if once:
        w = w.trigger(availableNow=True)
    return w.start()
