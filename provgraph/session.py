"""Session factory with the settings every part of the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "provgraph", **conf: str) -> SparkSession:
    """A session with UTC times, AQE and Arrow; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
