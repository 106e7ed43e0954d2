"""Tables by date and micro-batch whose closed days are merged into generations.

Batches write ``date=/batch_id=`` folders. ``merge_days`` writes the committed batches of closed
days once more, as few files of one generation, and then names that generation in a new manifest,
which one atomic rename puts in place. Readers take, for each day, what the newest manifest
names, and beside it the batches behind the last one that was merged. So a merge that is cut off
anywhere has either not happened, and left a folder that nobody reads, or has; batches of both
are never read together. ``drop_merged`` deletes later what no reader needs any more.

Only committed batches are merged, which Spark never runs again. A batch that is written again
all the same, after a checkpoint was put back, is compared with what the generation holds of it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.staging import stage
from tillbook.streaming.files import children, delete, modified, read_text, write_once

# How Spark names the folder of rows without a date.
UNDATED = "__HIVE_DEFAULT_PARTITION__"
ROWS_PER_FILE = 1_000_000
_MANIFESTS = "_manifest"
_GENERATIONS = "_generations"


class Merged(NamedTuple):
    """A day's generation, and the last batch that is in it."""

    generation: str
    through: int


def _versions(spark: SparkSession, table: str) -> list[int]:
    names = children(spark, f"{table}/{_MANIFESTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest_path(table: str, version: int) -> str:
    return f"{table}/{_MANIFESTS}/{version:010d}.json"


def read_manifest(spark: SparkSession, table: str) -> tuple[int, dict[str, Merged]]:
    """Version and merged days of the newest manifest; version 0 has none."""
    versions = _versions(spark, table)
    if not versions:
        return 0, {}
    days = json.loads(read_text(spark, _manifest_path(table, versions[-1])) or "{}")
    return versions[-1], {day: Merged(**merged) for day, merged in days.items()}


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the stream has finished, or -1."""
    names = children(spark, f"{checkpoint}/commits")
    return max((int(name) for name in names if name.isdigit()), default=-1)


def days_of(spark: SparkSession, table: str) -> list[str]:
    """The days that have batch folders."""
    return [n[5:] for n in children(spark, table) if n.startswith("date=")]


def _live_batches(spark: SparkSession, table: str, day: str) -> list[int]:
    names = children(spark, f"{table}/date={day}")
    return sorted(int(n[9:]) for n in names if n.startswith("batch_id="))


def _generation_folder(table: str, day: str, merged: Merged) -> str:
    return f"{table}/{_GENERATIONS}/{merged.generation}/day={day}"


def read_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    days: Iterable[str] | None = None,
    through: int | None = None,
) -> DataFrame:
    """The rows of a table, each once; ``days`` limits what is listed and read.

    ``through`` leaves out later batches that are not merged yet.
    """
    _, manifest = read_manifest(spark, table)
    live = days_of(spark, table)
    if days is not None:
        chosen = set(days)
        live = [day for day in live if day in chosen]
        manifest = {day: merged for day, merged in manifest.items() if day in chosen}
    folders = []
    for day in live:
        if day not in manifest and through is None:
            folders.append(f"{table}/date={day}")
            continue
        since = manifest[day].through if day in manifest else -1
        folders += [
            f"{table}/date={day}/batch_id={batch}"
            for batch in _live_batches(spark, table, day)
            if batch > since and (through is None or batch <= through)
        ]
    generations = [_generation_folder(table, day, merged) for day, merged in manifest.items()]
    parts = []
    if folders:
        parts.append(spark.read.schema(schema).option("basePath", table).parquet(*folders))
    if generations:
        # Their rows carry date and batch themselves.
        parts.append(spark.read.schema(schema).parquet(*generations))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def merge_days(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    committed: int,
    before: str,
    order_by: str,
    merge: Callable[[DataFrame], DataFrame] | None = None,
    undated: bool = True,
) -> list[str]:
    """Merge the batches up to ``committed`` of the days before ``before``; the days merged.

    ``merge`` may bring rows down to fewer, such as the newest of each key. Days without a batch
    behind their generation are left alone, so running this twice changes nothing. ``before``
    is an ISO date; rows without a date, which no day ever closes, are merged with ``undated``.
    """
    version, manifest = read_manifest(spark, table)
    pending = []
    for day in days_of(spark, table):
        if not (undated if day == UNDATED else day < before):
            continue
        since = manifest[day].through if day in manifest else -1
        if any(since < batch <= committed for batch in _live_batches(spark, table, day)):
            pending.append(day)
    if not pending:
        return []
    generation = uuid.uuid4().hex
    rows = read_table(spark, table, schema, pending, committed)
    if merge is not None:
        rows = stage(merge(rows).select(schema.names), "merged")
    rows = rows.withColumn("day", F.coalesce(F.col("date").cast("string"), F.lit(UNDATED)))
    sizes = [row["count"] for row in rows.groupBy("day").count().collect()]
    if max(sizes, default=0) <= ROWS_PER_FILE:
        # A task and a file for a day.
        ranged = rows.repartitionByRange(len(pending), "day")
    else:
        # Sorted by time across files, so that readers of a span skip most of a day.
        files = -(-sum(sizes) // ROWS_PER_FILE)
        ranged = rows.repartitionByRange(files, "day", order_by, F.xxhash64(*schema.names))
    (
        ranged.sortWithinPartitions("day", order_by)
        .write.partitionBy("day")
        .parquet(f"{table}/{_GENERATIONS}/{generation}")
    )
    merged = {day: Merged(generation, committed) for day in pending}
    text = json.dumps({day: m._asdict() for day, m in sorted((manifest | merged).items())})
    if not write_once(spark, _manifest_path(table, version + 1), text):
        raise RuntimeError(f"{table} has just been merged by another job; start again")
    return sorted(pending)


def drop_merged(spark: SparkSession, table: str, grace_seconds: float) -> list[str]:
    """Delete batch folders that a generation holds, and generations that none names.

    Nothing goes before the newest manifest is ``grace_seconds`` old, which must be longer than
    any read or merge takes: those that began before it still read by the one before.
    """
    version, manifest = read_manifest(spark, table)
    now = time.time()
    if not version or now - modified(spark, _manifest_path(table, version)) < grace_seconds:
        return []
    gone = []
    for day, merged in manifest.items():
        for batch in _live_batches(spark, table, day):
            if batch <= merged.through:
                gone.append(f"{table}/date={day}/batch_id={batch}")
    named = {merged.generation for merged in manifest.values()}
    for generation in children(spark, f"{table}/{_GENERATIONS}"):
        folder = f"{table}/{_GENERATIONS}/{generation}"
        if generation not in named and now - modified(spark, folder) >= grace_seconds:
            gone.append(folder)
    for older in _versions(spark, table)[:-1]:
        gone.append(_manifest_path(table, older))
    for path in gone:
        delete(spark, path)
    return gone


def merged_rows(
    spark: SparkSession, table: str, schema: T.StructType, days: Iterable[str], batch_id: int
) -> dict[str, int]:
    """How many rows of a batch each day's generation holds, for days merged beyond that batch."""
    _, manifest = read_manifest(spark, table)
    held = {d: manifest[d] for d in days if d in manifest and manifest[d].through >= batch_id}
    if not held:
        return {}
    folders = [_generation_folder(table, day, merged) for day, merged in held.items()]
    counts = (
        spark.read.schema(schema)
        .parquet(*folders)
        .filter(F.col("batch_id") == batch_id)
        .groupBy(F.coalesce(F.col("date").cast("string"), F.lit(UNDATED)).alias("day"))
        .count()
        .collect()
    )
    found = {row["day"]: row["count"] for row in counts}
    return {day: found.get(day, 0) for day in held}
