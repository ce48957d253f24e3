"""State codes to census regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The states of each region.
REGIONS: dict[str, list[str]] = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": ["DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV", "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX"],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
}
OTHER = "other"


def region_of(state: Column) -> Column:
    """The region of a two-letter code; unknown codes and NULL are ``other``.

    Four set tests in generated code; a join to a 51-row table would need an exchange.
    """
    region = F.lit(OTHER)
    for name, states in REGIONS.items():
        region = F.when(state.isin(states), F.lit(name)).otherwise(region)
    return region


def state_to_region(df: DataFrame, column: str = "state") -> DataFrame:
    """Replace the state codes of a column by their regions."""
    return df.withColumn(column, region_of(F.col(column)))
