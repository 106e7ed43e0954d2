"""Connected components by alternating star contraction.

Every round is two hash aggregations and two joins over the links that remain, written to the
shared folder, so a lost executor costs one round at most. A node with very many neighbours is a
hot join key on one side only, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.staging import stage


def _toward_minimum(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links ``(hi, lo)`` replaced by links from each neighbour to the smallest one around.

    ``both_ways``: every node sends its larger neighbours to the smallest node around it (the
    large star); otherwise each sends its smaller neighbours, and itself, there (the small star).
    """
    if both_ways:
        ends = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
    else:
        ends = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    lowest = ends.groupBy("u").agg(F.min("v").alias("m"))
    joined = ends.join(lowest, "u")
    if both_ways:
        moved = joined.filter("v > u").select(
            F.col("v").alias("hi"), F.least("u", "m").alias("lo")
        )
    else:
        moved = joined.select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias(
                "e"
            )
        ).select(F.col("e.v").alias("hi"), F.col("e.m").alias("lo"))
    return moved.filter("hi <> lo").distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``) that is not its root.

    The root is the smallest node of the component. Loops and repeated links are ignored.
    """
    current = stage(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .filter("hi <> lo")
        .distinct(),
        "links",
    )
    before = _digest(current)
    while before[0]:
        following = stage(
            _toward_minimum(_toward_minimum(current, both_ways=True), both_ways=False), "links"
        )
        after = _digest(following)
        current = following
        if after == before:
            break
        before = after
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
