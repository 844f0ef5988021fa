"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Spark sizes every broadcast from statistics: the static threshold covers tables of
# known size, the adaptive one re-checks the real shuffle output. No job forces one.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Month and day keys are text; a partition directory must not turn them into numbers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Recording the Python call site of every expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
