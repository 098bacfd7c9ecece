"""Zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.schemas import UNKNOWN_BOROUGH


def dim_zone(zones: DataFrame) -> DataFrame:
    """All zones, with the green service's name in the service zone."""
    return zones.select(
        F.col("LocationID").alias("locationid"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.replace(F.col("service_zone"), F.lit("Boro"), F.lit("Green")).alias("service_zone"),
    )


def known_zones(dim: DataFrame) -> DataFrame:
    """Zones of a named borough; a null borough is not known either."""
    return dim.where(F.col("borough") != UNKNOWN_BOROUGH)
