"""The batch operators on streams: documents are taken once, versions are appended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def arrivals(spark, folder: str, schema: StructType, per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(folder)


def first_seen(stream: DataFrame, text: str, time: str, delay: str = "30 days") -> DataFrame:
    """The rows of a stream whose text was not seen within the delay before, by its hash; state older than that is dropped."""
    return stream.withColumn("content_hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def counts(stream: DataFrame, time: str, keys: list[str], window: str = "7 days", delay: str = "30 days") -> DataFrame:
    """n for each window of time and keys; late rows count until the watermark has passed."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def drain(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Work off what is there and end; a later call goes on from the checkpoint."""
    query: StreamingQuery = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()


def versions(stream: DataFrame, write, checkpoint: str) -> None:
    """Hand each micro-batch to write(rows, batch_id), which must be idempotent for a batch_id."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_counts(stream: DataFrame, time: str, keys: list[str], target: str, checkpoint: str, window: str = "7 days", delay: str = "30 days") -> None:
    """counts() with the windows that are still open: each micro-batch writes the counts that it changed to a folder of its
    own number, which a repeated batch overwrites. read_latest() gives the last count of each window and key."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    stream = counts(stream, time, keys, window, delay)
    stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_latest(spark, target: str, keys: list[str]) -> DataFrame:
    """start, keys and n of latest_counts()."""
    return spark.read.parquet(target).groupBy("start", *keys).agg(F.max_by("n", "batch").alias("n"))


def append_facts(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Facts as they arrive, each micro-batch in a folder of its own number, which a repeated batch overwrites. Versions are
    read from all facts (operators.versions), so a late correction takes its place in the chain whenever it comes."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.distinct().write.mode("overwrite").parquet(f"{target}/batch={batch}")

    versions(stream, write, checkpoint)
