"""Counts per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, key: str, name: str = "n_listings") -> DataFrame:
    """Rows per key; NULL is a key of its own. Counted on the map side first, so a
    hot key costs the shuffle one row per task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def sql_count_per_key(table: DataFrame, key: str, name: str = "n_listings") -> DataFrame:
    """The same count as SQL text over the table."""
    return table.sparkSession.sql(
        f"SELECT `{key}`, COUNT(*) AS `{name}` FROM {{table}} GROUP BY `{key}`", table=table
    )
