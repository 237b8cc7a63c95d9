"""State to region mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OTHER = "Other"

# Brazilian federal units by macro-region.
STATE_REGIONS = {
    "North": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Northeast": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Central-West": ("DF", "GO", "MT", "MS"),
    "Southeast": ("ES", "MG", "RJ", "SP"),
    "South": ("PR", "RS", "SC"),
}


def region_of(state: Column, regions: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Region of a state code; codes in no region give ``Other``."""
    branches = [F.when(state.isin(*codes), F.lit(name))
                for name, codes in (regions or STATE_REGIONS).items()]
    return F.coalesce(*branches, F.lit(OTHER))


def region_table(spark: SparkSession) -> DataFrame:
    """The same mapping as a lookup table."""
    rows = [(code, name) for name, codes in STATE_REGIONS.items() for code in codes]
    return spark.createDataFrame(rows, "customer_state string, region string")
