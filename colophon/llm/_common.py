"""What the training-data operators share: tables in the shared folder, text splitting and bounded broadcasts."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

#: White space of the contracts, [\x20\x09-\x0D].
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Most bytes of a table that is broadcast.
BROADCAST = 16 << 20
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where it is unset and Spark runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/tmp/checkpoints/colophon"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again.

    This cuts the lineage, and what is read later doesn't depend on any one executor. Tables that a result still reads go when the
    driver's Python ends; those that it doesn't go by `discard`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/colophon-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_drop_all)
    _written.append((spark, path))
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by `materialise` that no later step reads."""
    for table in tables:
        spark, path = table.sparkSession, table._written_at
        _delete(spark, path)
        _written.remove((spark, path))


def _drop_all() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session may have ended first
            return


def small(df: DataFrame, most: int = BROADCAST) -> DataFrame:
    """df, which is written already, marked for broadcast if its rows take at most `most` bytes, else as it is, for a shuffled join.

    Every row counts with 16 bytes and 8 for each column, besides the bytes of strings and the elements of arrays.
    """
    size = F.lit(16 + 8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, ArrayType):
            size = size + 8 * F.greatest(F.size(f.name), F.lit(0))
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def no_spaces(text: Column) -> Column:
    """text without any character of [\x20\x09-\x0D]."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
