"""Spark settings that suit these queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and timestamps are zone-free; one zone keeps text and oracle results equal.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution sizes shuffles and splits hot keys, also where the split
    # costs another shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods above this size are not compiled by the Java runtime; plain
    # generated projections are faster then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes a few months keeps a file open for each and does not sort its
    # rows by month; with more months than this it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def apply(spark: SparkSession) -> None:
    """The settings on a session that is already there."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
