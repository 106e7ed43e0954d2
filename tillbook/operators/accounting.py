"""What becomes of every line, counted in the pass that drops lines.

``DataFrame.observe`` adds the counts to a job that runs anyway, so nothing is scanned twice. The
counts are those of the first action on the returned lines; it should write them, with no sort
by range in between, which would run the plan a second time to find its bounds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

KEPT = "kept"


def sort_lines(lines: DataFrame, reasons: Mapping[str, Column], counts: Observation) -> DataFrame:
    """The lines that no reason is true of; ``counts`` gets the number for each reason and the kept.

    A line counts for the first reason that is true of it, so the numbers add up to the input.
    """
    place = F.lit(len(reasons))
    for i, condition in reversed(list(enumerate(reasons.values()))):
        place = F.when(F.coalesce(condition, F.lit(False)), i).otherwise(place)
    marked = lines.withColumn("_reason", place)
    numbers = [
        F.count(F.when(F.col("_reason") == i, 1)).alias(name)
        for i, name in enumerate((*reasons, KEPT))
    ]
    observed = marked.observe(counts, *numbers)
    return observed.filter(F.col("_reason") == len(reasons)).drop("_reason")
