"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Values that don't fit a warehouse column are errors, not nulls.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits the partitions a hot customer or product makes in a shuffle join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app_name: str = "tillbook", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the library's settings; ``settings`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must reach.

    Only a local-mode session, whose executors are its own threads, may do without it; its
    tables then go to a folder of its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
