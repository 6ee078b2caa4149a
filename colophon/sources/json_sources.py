"""JSON documents, JSON lines and folders of JSON files, with explicit schemas and a place for each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def document(spark: SparkSession, path: str, schema: str, field: str = "entries") -> DataFrame:
    """SRC-01: the rows of an array field of one JSON document, with _ord; a missing file is an error."""
    doc = spark.read.schema(f"`{field}` ARRAY<STRUCT<{_struct(spark, schema)}>>").option("multiLine", True).json(path)
    return doc.select(F.posexplode(field).alias("_ord", "_e")).select(F.col("_ord").cast("long"), "_e.*")


def _struct(spark: SparkSession, schema: str) -> str:
    kinds = spark.createDataFrame([], schema).schema
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in kinds)


def optional(spark: SparkSession, path: str, schema: str, read=document) -> DataFrame:
    """SRC-02: as read, or no rows where there is no such file."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return read(spark, path, schema)
    return spark.createDataFrame([], f"_ord BIGINT, {schema}")


def lines(spark: SparkSession, path: str, schema: str, strict: bool = False, need: str = "id") -> DataFrame:
    """SRC-03, SRC-04: JSON lines. Lenient: blank and bad lines and rows without `need` are skipped; strict: a bad line raises."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    return df if strict else df.where(F.col(need).isNotNull())


def folder(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """SRC-05, SRC-06: files that hold one record, an array, {records: []} or {verdicts: []}; the last file wins for a key.

    Files that aren't JSON are skipped. Whole files are parsed as VARIANT, so all shapes go through one scan.
    """
    raw = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("_file"), F.try_parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    array = F.coalesce(F.try_variant_get("v", "$.records", "array<variant>"), F.try_variant_get("v", "$.verdicts", "array<variant>"), F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")), F.array("v"))
    rows = raw.where("v is not null").select("_file", F.posexplode(array).alias("_pos", "r"))
    rows = rows.select("_file", "_pos", F.from_json(F.to_json("r"), schema).alias("r")).select("_file", "_pos", "r.*").where(F.col(key).isNotNull())
    w = Window.partitionBy(key).orderBy(F.desc("_file"), F.desc("_pos"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_file", "_pos")


def keyed_map(spark: SparkSession, path: str, schema: str, field: str) -> DataFrame:
    """Rows of a map keyed by id: {field: {id: record}}."""
    doc = spark.read.schema(f"`{field}` MAP<STRING, STRUCT<{_struct(spark, schema)}>>").option("multiLine", True).json(path)
    return doc.select(F.explode(field).alias("id", "_r")).select("id", "_r.*")
