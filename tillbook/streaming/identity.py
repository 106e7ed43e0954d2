"""Which run a checkpoint and its folders belong to.

At the first start an id is written into the checkpoint and into every folder that its batches
go to. From then on all of them must have it: batch numbers mean something only together with
the checkpoint that counts them, and the numbers of another one would replace stored batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillbook.streaming.files import children, read_text, write_once

# Readers of tables skip names that start like this.
RUN_FILE = "_run"
_SPARK_LOGS = ("offsets", "commits")


def run_id(spark: SparkSession, folder: str) -> str | None:
    return read_text(spark, f"{folder}/{RUN_FILE}")


def _has_batches(spark: SparkSession, folder: str) -> bool:
    return any(not name.startswith(("_", ".")) for name in children(spark, folder))


def _has_offsets(spark: SparkSession, checkpoint: str) -> bool:
    return any(children(spark, f"{checkpoint}/{log}") for log in _SPARK_LOGS)


def claim_run(spark: SparkSession, checkpoint: str, folders: Sequence[str]) -> str:
    """The id that ``checkpoint`` and ``folders`` share; written if none has been used yet.

    Refused are ids that differ, and a missing id where anything has been written: a new
    checkpoint for used folders, or a new folder for a used checkpoint. A first start that was
    cut off before any batch leaves some ids, and the next one completes them.
    """
    ids = {place: run_id(spark, place) for place in (*folders, checkpoint)}
    given = sorted({found for found in ids.values() if found})
    if len(given) > 1:
        held = ", ".join(f"{place}: {found}" for place, found in ids.items() if found)
        raise ValueError(f"checkpoint and folders belong to different runs ({held})")
    used = [folder for folder in folders if _has_batches(spark, folder)]
    counted = _has_offsets(spark, checkpoint)
    missing = [place for place, found in ids.items() if not found]
    if missing and used and not counted:
        raise ValueError(
            f"{used[0]} has batches, but {checkpoint} is new: "
            "go on with their checkpoint, or give new folders"
        )
    if missing and (used or counted):
        raise ValueError(
            f"{', '.join(missing)} has no run id, but the run has begun: "
            "go on with its own checkpoint and folders, or see adopt_run"
        )
    return _write(spark, missing, given[0] if given else uuid.uuid4().hex)


def adopt_run(spark: SparkSession, checkpoint: str, folders: Sequence[str]) -> str:
    """Give an id to a run that was begun without one, or to a folder added to it on purpose.

    Whoever calls this vouches that the folders hold this checkpoint's batches. Ids that differ
    are still refused.
    """
    ids = {place: run_id(spark, place) for place in (*folders, checkpoint)}
    given = {found for found in ids.values() if found}
    if len(given) > 1:
        raise ValueError("checkpoint and folders belong to different runs")
    missing = [place for place, found in ids.items() if not found]
    return _write(spark, missing, given.pop() if given else uuid.uuid4().hex)


def _write(spark: SparkSession, places: Sequence[str], run: str) -> str:
    for place in places:
        if not write_once(spark, f"{place}/{RUN_FILE}", run) and run_id(spark, place) != run:
            raise ValueError(f"another run has just taken {place}")
    return run
