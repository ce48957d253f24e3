"""Lookup tables from JSON text and API replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lookup(spark: SparkSession, path: str, value_type: str, key: str = "key") -> DataFrame:
    """A JSON file ``{name: {...}, ...}`` as a table, one row per name.

    ``value_type`` is the DDL of the inner object. One object per file is read
    whole; a large lookup comes as JSON lines of smaller objects, read with
    ``spark.read.text`` and :func:`explode_lookup`.
    """
    return explode_lookup(spark.read.text(path, wholetext=True), "value", value_type, key)


def explode_lookup(
    texts: DataFrame, column: str, value_type: str, key: str = "key", order: str | None = None
) -> DataFrame:
    """JSON objects in a column to one row per name with its inner object's fields.

    A name that occurs again replaces the earlier entry. Later is what stands later in an
    object, and of several rows the one with the larger ``order``; rows without an
    order go by position and then by the larger entry. A maximum needs no sorting of the entries of a
    name and combines on the map side.
    """
    place = F.lit(0) if order is None else F.col(order)
    entries = texts.select(
        place.alias("_order"),
        F.posexplode(F.from_json(column, f"map<string,{value_type}>")).alias("_pos", key, "_entry"),
    )
    last = entries.groupBy(key).agg(F.max(F.struct("_order", "_pos", "_entry")).alias("_last"))
    return last.select(key, "_last._entry.*")


def first_match(texts: DataFrame, column: str, value_type: str, order: str, key: str = "key") -> DataFrame:
    """Arrays ``[{name: {...}}, ...]`` to one row per name, the first record winning.

    Arrays of several rows are taken in ``order``, then by position. A minimum of
    (order, position, value) needs no sorting of the rows of a name and combines on
    the map side.
    """
    records = texts.select(
        F.col(order).alias("_order"),
        F.posexplode(F.from_json(column, f"array<map<string,{value_type}>>")).alias("_pos", "_record"),
    )
    entries = records.select("_order", "_pos", F.explode("_record").alias(key, "_entry"))
    return entries.groupBy(key).agg(F.min(F.struct("_order", "_pos", "_entry")).alias("_first")).select(
        key, "_first._entry.*"
    )


def to_map(table: DataFrame, key: str, value: str, order: str, name: str = "lookup", max_entries: int = 10_000) -> DataFrame:
    """All pairs as one map, the last pair of a key (by ``order``) winning.

    One map is one row and so one task's memory: pairs are reduced to one per key
    before they are collected, and more than ``max_entries`` keys are an error.
    Larger lookups stay tables and are joined.
    """
    last = table.groupBy(key).agg(F.max(F.struct(F.col(order), F.col(value))).alias("_last"))
    bounded = last.agg(F.count(F.lit(1))).first()[0]
    if bounded > max_entries:
        raise ValueError(f"{bounded} keys are too many for one map; join the table instead")
    pairs = F.collect_list(F.struct(F.col(key), F.col(f"_last.{value}").alias(value)))
    return last.agg(F.map_from_entries(F.array_sort(pairs)).alias(name))


def extract_records(
    replies: DataFrame, column: str, fields: dict[str, str], max_results: int | None = None
) -> DataFrame:
    """Pick fields of all objects in a reply's ``data`` array, or of the first ``max_results`` if given.

    ``fields`` maps JSON names to output names; whatever number of objects is
    there is taken, even when the reply announces another.
    """
    inner = ", ".join(f"`{f}`: string" for f in fields)
    data = F.from_json(column, f"struct<data: array<struct<{inner}>>>")["data"]
    others = [c for c in replies.columns if c != column]
    wanted = data if max_results is None else F.slice(data, 1, max_results)
    picked = replies.select(*others, F.explode(wanted).alias("_r"))
    return picked.select(*others, *(F.col(f"_r.`{f}`").alias(name) for f, name in fields.items()))
