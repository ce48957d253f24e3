"""Catalog tables with checked names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sluice.operators.pivot import require_fields


class TableNotFound(LookupError):
    """The catalog has no such table."""


def validate_table(spark: SparkSession, name: str) -> DataFrame:
    """The table, or an error that names it."""
    if not spark.catalog.tableExists(name):
        raise TableNotFound(f"no table {name} in catalog {spark.catalog.currentCatalog()}")
    return spark.table(name)


def validated_projection(table: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Only the named columns, after checking that all exist; the scan reads no others."""
    require_fields(table, fields)
    return table.select(*dict.fromkeys(fields))
