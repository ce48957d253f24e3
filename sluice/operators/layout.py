"""Partition layout before costly per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(source: DataFrame, partitions: int, below: int = 256 * 1024 * 1024) -> DataFrame:
    """A small source dealt out to ``partitions`` tasks, for work whose cost per row is far above that of moving it.

    A few small files that cannot be split would be read by as few tasks. The caller decides
    for how many; a source of ``below`` bytes or more, by Spark's estimate, is returned as it is,
    so that no large one is ever shuffled for this. Nothing is run.
    """
    size = source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return source.repartition(partitions) if int(size) < below else source
