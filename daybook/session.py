"""Session settings the jobs count on; the caller builds the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # sizes and skew are judged from what the stages really wrote
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # accepted and refused rows are written side by side, without a sort
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.session.timeZone": "UTC",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
