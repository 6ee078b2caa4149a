"""Keyed state over batches: a table in buckets of ids, of which a batch rewrites those that it touches, behind a numbered manifest.

A batch writes new files for its buckets and then a manifest that names, for each bucket, the folder that holds it; readers take
the manifest with the highest number. A batch that fails leaves files that no manifest names, and the table as it was. A
manifest holds the last epoch, so a batch that is played again changes nothing; a bucket whose content stays the same keeps its
folder, and a batch that changes nothing but the epoch writes no data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

BUCKET = "_bucket"


class StateTable:
    """The state at a path. Rows have the given schema and are found by the column `key`."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, key: str = "id", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _manifests(self) -> list[str]:
        folder = self._path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        return sorted(x.getPath().getName() for x in self._fs.listStatus(folder) if x.getPath().getName().startswith("m-"))

    def manifest(self) -> dict:
        """The latest manifest: its number, the last epoch, and of each bucket its folder, rows and digest."""
        names = self._manifests()
        if not names:
            return {"number": 0, "epoch": -1, "buckets": {}}
        stream = self._fs.open(self._path(f"{self.path}/manifests/{names[-1]}"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, manifest: dict) -> None:
        """Writes the next manifest under another name first; the rename makes it the table, and fails if another writer was faster."""
        other = self._path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(other, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = self._path(f"{self.path}/manifests/m-{manifest['number']:012d}")
        if self._fs.exists(target) or not self._fs.rename(other, target):
            self._fs.delete(other, False)
            raise RuntimeError(f"another writer has made version {manifest['number']} of {self.path}")

    def read(self, buckets: list[int] | None = None, manifest: dict | None = None) -> DataFrame:
        """The rows of all buckets, or of those asked for."""
        known = (manifest or self.manifest())["buckets"]
        folders = [x["folder"] for b, x in known.items() if buckets is None or int(b) in buckets]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def apply(self, batch: DataFrame, epoch: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Merges a batch into the rows of its buckets: merge(old rows, batch) gives their new rows. False if it was applied before."""
        now = self.manifest()
        if epoch <= now["epoch"]:
            return False
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # as many as there are buckets, at most
        new = merge(self.read(touched, now), batch).select(*self.schema.names)
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        new.select("*", bucket).repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        written = self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(folder)
        digest = F.sum(F.xxhash64(*self.schema.names).cast("decimal(38,0)")).cast("string")
        found = {r[0]: (r[1], r[2]) for r in written.groupBy(BUCKET).agg(F.count("*"), digest).collect()}
        buckets = dict(now["buckets"])
        for b in touched:
            old = buckets.get(str(b))
            if b not in found:
                buckets.pop(str(b), None)
            elif not old or (old["rows"], old["digest"]) != found[b]:
                buckets[str(b)] = {"folder": f"{folder}/{BUCKET}={b}", "rows": found[b][0], "digest": found[b][1]}
        self._switch({"number": now["number"] + 1, "epoch": epoch, "buckets": buckets})
        if folder not in {x["folder"].rsplit("/", 1)[0] for x in buckets.values()}:
            self._fs.delete(self._path(folder), True)  # nothing has changed
        return True


def unseen(old: DataFrame, batch: DataFrame, key: str = "id") -> DataFrame:
    """ST-02 as a merge: ids that are there already stay as they are."""
    return old.unionByName(batch.dropDuplicates([key]).join(old, key, "left_anti"))


LEDGER = "id long, published string, score double, verdict string"


def ledger(old: DataFrame, batch: DataFrame, new: str = r"^new\b") -> DataFrame:
    """ST-05, JN-06 as a merge into rows of LEDGER: the fields that a batch gives replace the old ones; a verdict stays until another comes.

    batch: id, at (the order of its rows), published, score, status; the last filled value of each field counts. The status of an
    entry that isn't empty and isn't marked new is its verdict, and so outlives the entry's place in the feed.
    """
    fields = ("published", "score", "verdict")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col("at"))).alias(c)
    verdict = F.when(~F.col("status").rlike(new), F.nullif(F.col("status"), F.lit("")))
    rows = batch.withColumn("verdict", verdict).groupBy("id").agg(*[last(c) for c in fields])
    o = old.select("id", *[F.col(c).alias(f"_{c}") for c in fields])
    return rows.join(o, "id", "full_outer").select("id", *[F.coalesce(c, f"_{c}").alias(c) for c in fields])


def feed_of(size: int = 60) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """ST-04 as a merge of a one-bucket table (id, score, published, place): the batch's rows by score and date go before the others."""

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        from colophon.operators.pool import feed

        rows = feed(batch.select("id", "score", "published"), old.select("id", "score", "published", "place"), size)
        order = [F.desc("fresh"), F.when(F.col("fresh"), F.col("score")).desc(), F.when(F.col("fresh"), F.col("published")), F.col("place"), F.col("id")]
        # `size` rows at most
        return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long")).select("id", "score", "published", "place")

    return merge
