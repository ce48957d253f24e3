"""Counts per neighbourhood enriched with area codes and demographics.

The counts are taken before any join, so lookups see one row per neighbourhood
however many listings one of them has.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import cleaning
from sluice.operators.joins import lookup_join


def add_area_code(counts: DataFrame, lookup: DataFrame, strict: bool = False) -> DataFrame:
    """Neighbourhood counts with the ``puma_code`` of a lookup keyed by neighbourhood."""
    return lookup_join(counts, lookup.select("neighbourhood", "puma_code"), "neighbourhood", strict=strict)


def area_statistics(replies: DataFrame, variables: Mapping[str, str]) -> DataFrame:
    """Census replies ``(puma_code, reply)`` to typed statistics per area.

    A reply holds a row of headers and a row of values. ``variables`` names the
    headers for population, median_home_value, adults, adults_bachdeg, median_rent.
    """
    record = replies.select("puma_code", cleaning.header_value_record(F.col("reply")).alias("r"))

    def number(name: str):
        return cleaning.whole_number(F.col("r")[variables[name]])

    return record.select(
        "puma_code",
        number("median_rent").alias("median_rent"),
        number("median_home_value").alias("median_home_value"),
        cleaning.percent(number("adults_bachdeg"), number("adults")).alias("percent_adults_bachdeg"),
        number("population").alias("population"),
        F.col("r")["NAME"].alias("puma_name"),
    )


def enrich_two_hop(counts: DataFrame, lookup: DataFrame, statistics: DataFrame, strict: bool = False) -> DataFrame:
    """Counts to area codes to statistics. Rows without a code get a blank one and
    no statistics."""
    coded = add_area_code(counts, lookup, strict)
    joined = lookup_join(coded, statistics, "puma_code")
    return joined.select(
        "neighbourhood",
        "n_listings",
        F.coalesce("puma_code", F.lit("")).alias("puma_code"),
        "median_rent",
        "median_home_value",
        "percent_adults_bachdeg",
        "population",
        "puma_name",
    )


def demographics(raw: DataFrame) -> DataFrame:
    """Text demographics per neighbourhood (``609,513``, ``NaN``, plain numbers) to numbers."""
    return raw.select(
        "neighbourhood",
        "nta_code",
        *(
            cleaning.grouped_number(F.col(c).cast("string")).alias(c) for c in ("median_rent", "median_home_value")
        ),
        cleaning.real_number(F.col("percent_atleast_bachdeg").cast("string")).alias("percent_atleast_bachdeg"),
        cleaning.grouped_number(F.col("population").cast("string")).alias("population"),
        "nta_name",
    )


def enrich_one_hop(counts: DataFrame, by_neighbourhood: DataFrame, strict: bool = False) -> DataFrame:
    """Counts with the demographics of their neighbourhood."""
    return lookup_join(counts, by_neighbourhood, "neighbourhood", strict=strict).select(
        "neighbourhood",
        "n_listings",
        "nta_code",
        "median_rent",
        "median_home_value",
        "percent_atleast_bachdeg",
        "population",
        "nta_name",
    )
