"""Tables a job writes for itself in the shared folder.

A staged table cuts lineage: what follows reads files, so a lost executor costs a re-read of
its files and never a recomputation of the joins and sorts behind them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tillbook.session import new_folder

_folders: ContextVar[list[str] | None] = ContextVar("tillbook_folders", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    held = _folders.get()
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, what was staged inside; results must be written out by then."""
    token = _folders.set([])
    try:
        yield
    finally:
        held = _folders.get() or []
        _folders.reset(token)
        for path in held:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
