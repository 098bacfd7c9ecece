"""Union of services."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SERVICE_TYPE = "service_type"


def with_service(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(SERVICE_TYPE, F.lit(label))


def union_services(first: DataFrame, second: DataFrame, by_position: bool = False) -> DataFrame:
    """All rows of both, columns matched by name, fees of one service null.

    ``by_position`` matches columns by place instead, which mixes up the fees
    wherever the two column lists differ. It exists to reproduce old results.
    """
    if by_position:
        return first.union(second)
    return first.unionByName(second, allowMissingColumns=True)
