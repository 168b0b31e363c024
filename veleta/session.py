"""Session defaults: UTC, ANSI on, adaptive execution, dynamic partition overwrite."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(name: str = "veleta", **conf: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=DEFAULTS | {k.replace("_", "."): v for k, v in conf.items()}).getOrCreate()
