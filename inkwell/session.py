"""Session settings the engine relies on: UTC, adaptive plans, skew joins."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[*]", **more: str) -> SparkSession:
    out = SparkSession.builder.master(master).config(map=SETTINGS | {k.replace("_", "."): v for k, v in more.items()}).getOrCreate()
    out.sparkContext.setLogLevel("ERROR")
    return out
