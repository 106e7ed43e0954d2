"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_source_options(
    servers: str, topic: str, starting_offsets: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Messages of one Kafka topic; ``max_offsets`` paces a replay."""
    options = kafka_source_options(servers, topic, starting_offsets, max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def read_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages from text files, one per line; ``max_files`` paces a replay."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
