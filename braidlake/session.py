"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks join strategies from measured sizes, coalesces small shuffle partitions and splits
# skewed ones. Nothing here is sized for one machine: partition counts start high and AQE
# shrinks them.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(app: str = "braidlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; ``conf`` keys use ``_`` for ``.`` or full names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
