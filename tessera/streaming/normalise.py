"""Normalisation and candidate lookup on streams: the same column expressions, on readStream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config
from tessera.functions.text import with_address_parts, with_name_parts
from tessera.operators.blocking import record_tokens

RECORD_SCHEMA = "id string, num bigint, src int, country string, business_name string, business_address string"


def read_records(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of Parquet records as they arrive in the folder."""
    return spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def normalised(stream: DataFrame) -> DataFrame:
    """Every normalised view; stateless, so nothing is kept between batches."""
    return with_address_parts(with_name_parts(stream))


def scores(stream: DataFrame, index_postings: DataFrame, weights: DataFrame, channel: config.Channel = config.NAME_CHANNEL) -> DataFrame:
    """q_id, c_id and the weight of every token that a streamed record shares with the static index.

    A stream-static join on the token; sum and top-k belong to the sink's foreachBatch.
    """
    tokens = record_tokens(normalised(stream), channel).select(F.col("id").alias("q_id"), "country", "token", "w")
    weighed = tokens.join(weights.select("country", "token", "idf"), ["country", "token"])
    index = index_postings.select(F.col("id").alias("c_id"), "country", "token", F.col("w").alias("cw"))
    return weighed.join(index, ["country", "token"]).select("q_id", "c_id", "token", (F.col("w") * F.col("idf") * F.col("cw")).alias("part"))


def write(stream: DataFrame, path: str, checkpoint: str):
    """The stream appended to Parquet; exactly once by the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
