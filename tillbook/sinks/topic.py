"""JSON messages to a Kafka topic or a folder of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.retries": "3"}


def write_events_to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    options = kafka_sink_options(servers, topic)
    messages.select("value").write.format("kafka").options(**options).save()


def write_events_to_folder(messages: DataFrame, path: str) -> None:
    messages.select("value").write.mode("append").text(path)
