"""Session settings for the workload; the cluster's own SQL settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins carry no broadcast hints except for inputs of a fixed size, so the size check is Spark's own:
# a side is broadcast only while its measured size stays under the threshold, otherwise the join shuffles
# and adaptive execution splits the partitions that a hot key makes too large.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only take effect when the session starts. Call sites of column expressions are only worth their
# driver time while debugging.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "merchlens", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above where neither `extra` nor the cluster's configuration says otherwise.

    The number of shuffle partitions depends on the data, so it has no default here: about one per 128 MB of the
    largest shuffle; adaptive execution merges the ones that turn out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**AT_START, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configured = dict(spark.sparkContext.getConf().getAll())
    for key, value in DEFAULTS.items():
        if key not in configured:
            spark.conf.set(key, value)
    return spark
