"""Lookups as joins: enrichment, existence checks and their complements.

Nothing is measured and no job runs when a lookup is built. Spark broadcasts the right side
where its size is known to be small: from file sizes when planning, from the bytes of its shuffle
when running (``spark.sql.autoBroadcastJoinThreshold`` and the adaptive one; see
:data:`sluice.session.RECOMMENDED`). ``broadcast=True`` is for a caller who knows the size. Else
it is a shuffle join, for which adaptive execution splits the partitions of hot left
keys (left, semi and anti joins allow that).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(lookup: DataFrame, on: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: that with the largest ``order``, then with the largest other columns, in
    their order. The aggregate leaves its rows where a join on the key needs them."""
    rest = [c for c in lookup.columns if c not in on]
    first = [order] if order else []
    if not rest:
        return lookup.select(*on).distinct()
    by = F.struct(*first, *(c for c in rest if c not in first))
    return lookup.groupBy(*on).agg(F.max(by).alias("__last")).select(*on, *(F.col(f"__last.{c}").alias(c) for c in rest))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    *,
    strict: bool = False,
    found: str | None = None,
    order: str | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """Add the lookup's columns to every left row; absent keys give NULLs.

    A key that the lookup has several times counts once: see :func:`one_per_key`.

    ``strict``  fail at run time on a left key that the lookup does not have.
    ``found``   name of an extra boolean column telling whether the key was there.
    """
    on = [on] if isinstance(on, str) else list(on)
    marked = one_per_key(lookup, on, order).withColumn("__found", F.lit(True))
    joined = left.join(F.broadcast(marked) if broadcast else marked, on, "left")
    if strict:
        key = F.concat_ws(", ", *(F.col(k).cast("string") for k in on))
        missing = F.raise_error(F.concat(F.lit("no lookup entry for "), key))
        joined = joined.filter(F.when(F.col("__found"), True).otherwise(missing))
    if found:
        joined = joined.withColumn(found, F.coalesce("__found", F.lit(False)))
    return joined.drop("__found")


def lookup_or_default(
    requests: DataFrame, lookup: DataFrame, key: str, default: str, found: str = "found", **options
) -> DataFrame:
    """Keyed lookup where a request without a key asks for ``default``."""
    return lookup_join(requests.fillna(default, subset=[key]), lookup, key, found=found, **options)


def exists_in(left: DataFrame, known: DataFrame, on: str | Sequence[str], broadcast: bool = False) -> DataFrame:
    """Left rows whose key is known; duplicates on the left are kept."""
    on = [on] if isinstance(on, str) else list(on)
    keys = known.select(*on)
    return left.join(F.broadcast(keys) if broadcast else keys, on, "left_semi")


def missing_in(left: DataFrame, known: DataFrame, on: str | Sequence[str], broadcast: bool = False) -> DataFrame:
    """Left rows whose key is not known, the dead letters of a lookup."""
    on = [on] if isinstance(on, str) else list(on)
    keys = known.select(*on)
    return left.join(F.broadcast(keys) if broadcast else keys, on, "left_anti")
