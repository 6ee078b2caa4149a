"""Parquet table access: one folder (or file) per table below a scale-factor directory."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a lazy DataFrame; the path may be on any file system that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df over three tasks for each core, by the hash of `by`, for work that is heavy for each row: a small file is read by few tasks."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism, *by)


def by_rows(df: DataFrame, rows: int, *by: str, most: int = 500_000) -> DataFrame:
    """df by the hash of `by`, over so many tasks that of `rows` rows each has about `most`, whatever the size of the input."""
    return df.repartition(max(1, -(-rows // most)), *by)


def many(df: DataFrame) -> DataFrame:
    """df as a side of a join that grows with the input: it is shuffled and sorted, never broadcast.

    The planner's sizes come from compressed files and don't count what explode and long texts add, so it would collect such a
    side in the driver.
    """
    return df.hint("merge")


_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it goes when the driver's Python ends, as results may be read until then."""
    path = f"{shared_dir(spark)}/colophon-{uuid.uuid4().hex}-{name}"
    if not _made:
        atexit.register(_drop)
    _made.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read again, so that no later step makes it anew."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop() -> None:
    for spark, path in _made:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may have ended first
            return


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where it is unset and Spark runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/tmp/checkpoints/colophon"
