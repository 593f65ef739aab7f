"""A Spark session with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Instants are compared as UTC; ANSI mode raises where a silent null would hide a fault.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(name: str = "spanlake", **more: str) -> SparkSession:
    """The running session or a new one; `more` settings (with _ for .) win."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS)
    return builder.config(map={k.replace("_", "."): v for k, v in more.items()}).getOrCreate()
