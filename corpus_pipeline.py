"""A corpus pipeline: language, repeated lines, near-duplicates, benchmark leaks, packing.

Each stage works on all that the one before has kept and is written as Parquet in the shared folder before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm import queries as _llm
from colophon.llm._common import bucket_of, materialise, small
from colophon.llm.decontaminate import contaminated
from colophon.llm.language import identify
from colophon.llm.line_dedup import line_dedup
from colophon.llm.near_copies import near_copies
from colophon.llm.packing import pack


def _keyed(docs: DataFrame) -> DataFrame:
    """_id and _text of docs, and _key, a hash that tells the texts of one id apart: (_id, _key) names a document."""
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), F.col("text").alias("_text"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the documents (_id, _key) of gone, a written table."""
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_key"])
    return docs.join(small(gone), same, "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without a letter, null texts and very distant ones go.

    Learned from the labelled two thirds of the stage's input. An empty table stays empty.
    """
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("_key"))
    out = identify(rows, bucket_of(F.col("doc_id"), 3) != 1, keep=["doc_id", "_key"])
    gone = materialise(out.where("rejected").select(F.col("doc_id").alias("_id"), "_key").distinct(), "rejected")
    return _without(docs, gone)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template an earlier document has; n_chars, if it is there, counts what is left."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))  # one column, whatever names it holds
    out = line_dedup(rows.withColumn("row", F.col("row").dropFields("text")), keep=["row"])
    n_chars = lambda c: F.char_length("text").cast(docs.schema[c].dataType).alias(c)
    return out.select(*["text" if c == "text" else n_chars(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns])


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-copies (five-word similarity of 0.8 or more) one row, that with the least id (null ids come last).

    Rows are told apart by id and text, so of an id with several texts only the copies go; of repeated rows one stays.
    """
    name = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    rows = near_copies(docs).groupBy("component", name.alias("name")).agg(F.count("*").alias("n"))
    rows = materialise(rows, "named")
    first = rows.groupBy("component").agg(F.min("name").alias("first"), F.count("*").alias("names"))
    first = materialise(first.where("names > 1").select("component", "first"), "first")
    marks = rows.join(small(first), "component").where("name <> first").select("name._id", "name._key")
    rest = _without(docs, materialise(marks, "copies"))
    twice = materialise(rows.where("n > 1").select("name._id", "name._key"), "repeated")
    if twice.isEmpty():
        return rest
    again = docs["doc_id"].eqNullSafe(twice["_id"]) & (F.xxhash64(docs["text"]) == twice["_key"])
    return _without(rest, twice).unionByName(rest.join(small(twice), again, "left_semi").dropDuplicates(["doc_id", "text"]))


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark; of an id with several texts only the rows that do go."""
    keyed = _keyed(docs).select(F.struct("_id", "_key").alias("doc_id"), F.col("_text").alias("text"))
    pairs = contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, materialise(pairs.select("doc_id._id", "doc_id._key").distinct(), "leaks"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return _llm.digest(pack(docs, _llm.tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("lines", fresh_lines),
    ("near_copies", no_near_copies),
    ("leaks", no_leaks),
    ("packing", packed),
]
#: SQL can't express the trained classifier or the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, from the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
