"""The session the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC times, ANSI casts, adaptive plans that split skewed joins.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(name: str = "skygrid", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    for k, v in (CONF | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()
