"""Session settings the package is designed around.

Nothing here is required: every function takes whatever session it is given.
Object-store access (endpoint, region, keys, path style) is left to the
caller's ``spark.hadoop.fs.s3a.*`` settings, so that no secret lives in code.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: coalesce small partitions, split skewed join
    # partitions, and turn joins into broadcasts by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets REBALANCE hints cut one hot month into several output files.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Only the partitions present in a batch are ever replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Trip times are wall-clock times without a zone.
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "trip_marts",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
