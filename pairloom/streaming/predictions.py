"""Prediction messages as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom import schemas

RAW = T.StructType([
    T.StructField("msg_id", T.StringType()), T.StructField("sent_at", T.TimestampType()),
    T.StructField("account", T.StringType()), T.StructField("body", T.StringType())])


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = 4) -> DataFrame:
    """Message records from a folder of JSON lines (a message bus in production); without a number, all new files are one batch."""
    reader = spark.readStream.schema(RAW)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def parse(raw: DataFrame) -> DataFrame:
    """Body fields; ``prediction`` and ``confidence`` are the map entries of the message date."""
    m = F.from_json("body", schemas.MESSAGE)
    parsed = raw.withColumn("m", m)
    day = F.col("m.date")
    return parsed.select(
        "msg_id", "sent_at", "account", "body", day.alias("date"),
        F.try_element_at("m.direction", day).alias("prediction"),
        F.try_element_at("m.confidence", day).alias("confidence"),
        F.col("m.mu").alias("mu"), F.col("m.std").alias("std"), F.col("m.spread").alias("message_spread"))


def accepted(raw: DataFrame, delay: str | None = "1 day") -> DataFrame:
    """Readable messages, once each; ``delay`` bounds how long a message id is remembered."""
    good = parse(raw).where(F.col("date").isNotNull()).drop("body")
    if not raw.isStreaming:
        return good.dropDuplicates(["msg_id"])
    return good.withWatermark("sent_at", delay).dropDuplicatesWithinWatermark(["msg_id"])


def quarantined(raw: DataFrame) -> DataFrame:
    """Messages whose body cannot be read."""
    return parse(raw).where(F.col("date").isNull()).select("msg_id", "sent_at", "account", "body")


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", foreach=None) -> None:
    """Process everything available and stop; files in ``path`` or a ``foreachBatch`` function."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(foreach).start() if foreach else writer.format("parquet").option("path", path).start()
    query.awaitTermination()
