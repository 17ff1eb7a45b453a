"""JSON topics: Kafka where brokers are named, else a folder of JSON-lines files per topic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/{topic}"


def unread(spark: SparkSession, topic: str, root: str) -> Column:
    """The condition that a message's file is newer than what the topic's folder holds now.

    Only the files' names and times are listed, no message is read. Files of the same instant as the
    newest are told apart by name.
    """
    at, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    files = spark.read.format("binaryFile").load(topic_path(root, topic)).select(
        at.alias("at"), name.alias("name"))
    newest = files.agg(F.max("at")).first()[0]
    if newest is None:
        return F.lit(True)
    same = [row["name"] for row in files.filter(F.col("at") == F.lit(newest)).collect()]
    return (at > F.lit(newest)) | ((at == F.lit(newest)) & ~name.isin(same))


def read_topic(
    spark: SparkSession, topic: str, servers: str | None = None, root: str | None = None,
    start: str = "earliest", since: Column | None = None, files_per_trigger: int | None = None,
    rows_per_trigger: int | None = None,
) -> DataFrame:
    """A topic as a streaming frame with the message text in ``value``.

    ``start="latest"`` leaves out what the topic held before: in Kafka by offset, in a folder by
    files for which ``since`` holds (``unread`` tells the current state). Consumer groups need no
    setting: each query keeps its offsets in its checkpoint.
    """
    if servers:
        reader = spark.readStream.format("kafka").option(
            "kafka.bootstrap.servers", servers).option("subscribe", topic).option(
            "startingOffsets", start)
        if rows_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", rows_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.load(topic_path(root, topic))
    if start == "latest":
        if since is None:
            raise ValueError("a folder needs the condition under which messages count as new")
        lines = lines.filter(since)
    return lines.select("value")


def write_topic(
    df: DataFrame, topic: str, checkpoint: str, servers: str | None = None,
    root: str | None = None, trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Start writing ``value`` (and ``key``) to a topic; at least once on Kafka."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    if servers:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers).option(
            "topic", topic).start()
    return df.select("value").writeStream.format("text").option(
        "checkpointLocation", checkpoint).trigger(**trigger).start(topic_path(root, topic))


def archive_topics(
    spark: SparkSession, topics: list[str], path: str, checkpoint: str,
    servers: str | None = None, root: str | None = None,
    trigger: dict = {"processingTime": "60 seconds"},  # noqa: B006
) -> StreamingQuery:
    """Keep the raw messages of several topics as JSON lines, one folder per topic."""
    tagged = [read_topic(spark, name, servers, root).select("value", F.lit(name).alias("topic"))
              for name in topics]
    return reduce(DataFrame.unionByName, tagged).writeStream.format("text").partitionBy(
        "topic").option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def debug(df: DataFrame, on: bool = False) -> StreamingQuery | None:
    """Print a stream to the console if asked to."""
    return df.writeStream.format("console").option("truncate", "false").start() if on else None
