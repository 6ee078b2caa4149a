"""The incremental crawl on Structured Streaming: flag, deduplicate, keep a seen-set, a feed and a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOOK_BACK = "10 days"


def flagged_stream(stream: DataFrame, threshold: float, id_col: str = "event_id", ts: str = "ts", score: str = "value") -> DataFrame:
    """ST-01, ST-03: rows over the threshold, each id once within the look-back.

    Low rows are dropped before the deduplication, so that they are scored anew when they come again. The watermark bounds the
    state; event time must be a TIMESTAMP.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(score) >= threshold)
    return timed.withWatermark(ts, LOOK_BACK).dropDuplicatesWithinWatermark([id_col])


def run_once(stream: DataFrame, target: str, checkpoint: str) -> None:
    """SNK-03: appends what is there now to a Parquet table, exactly once, and stops."""
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def append_unseen(spark: SparkSession, seen_path: str, id_col: str = "id", buckets: int = 64):
    """ST-02: a foreachBatch function for an unbounded seen-set: ids that the table at seen_path lacks are appended to it.

    The table is partitioned by a hash of the id, and a batch reads only the buckets of its ids.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(seen_path)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def write(batch: DataFrame, epoch: int) -> None:
        fresh = batch.dropDuplicates([id_col]).withColumn("bucket", F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int"))
        if files.exists(path):
            touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # as many as there are buckets, at most
            seen = spark.read.schema(fresh.schema).parquet(seen_path).where(F.col("bucket").isin(touched)).select(id_col)
            fresh = fresh.join(seen, id_col, "left_anti")
        fresh.write.mode("append").partitionBy("bucket").parquet(seen_path)

    return write


def outcome(known: Column, verdict: Column, status: Column, in_feed: Column, new: str = r"^new\b") -> Column:
    """ST-05: the first that holds: catalogued; marked new, or in the feed without a verdict; a verdict that names the catalogue."""
    none = F.coalesce(verdict, F.lit("")) == ""
    return (
        F.when(known, "admitted")
        .when(F.coalesce(status.rlike(new), F.lit(False)) | (none & in_feed), "under review")
        .when(F.coalesce(verdict, F.lit("")).rlike("(?i)catalogu|already"), "already catalogued")
        .otherwise("not admitted")
    )


def window_counts(stream: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """ST-07 (an extension): events of each type in tumbling or sliding windows of event time, closed after the lateness."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def session_counts(stream: DataFrame, by: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """ST-07 (an extension): runs of a key's events with gaps below `gap`, closed after the lateness."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(by, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("start"), "n")
