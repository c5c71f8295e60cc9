"""Spark sessions with the settings this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC times, adaptive execution, dynamic partition overwrite; ``conf`` adds
    to them, with ``__`` for a dot in a name."""
    builder = SparkSession.builder.appName("pitchlake")
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for name, value in (fixed | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
