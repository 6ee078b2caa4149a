"""Session factory used by tests, the bench and ad-hoc runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", app: str = "colophon", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; extra settings as keyword arguments."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | conf
    return builder.config(map=settings).getOrCreate()
