"""Orders of the catalogue's tables. Each gives the rows their place from 1 on; places come from range partitions, not from one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.pool import batches

# Severities of findings and buckets of refusals, in their order.
SEVERITIES = ("HIGH", "MED", "LOW")
BUCKETS = ("unmapped_model", "below_min_cells", "unknown_benchmark", "not_a_model")


def placed(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """df with `place`, its rows' number in the order."""
    return batches(df, 1, order).withColumnRenamed("batch", "place")


def listed(values: tuple[str, ...], col: str) -> Column:
    """The place of a column's value in a list; others come last."""
    at = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(col))
    return F.when(at > 0, at).otherwise(len(values) + 1)


def ledger(df: DataFrame) -> DataFrame:
    """SO-03: latest publication first, then id."""
    return placed(df, [F.desc("published"), F.col("id")])


def roster(df: DataFrame) -> DataFrame:
    """SO-04: most mentions first, then the name without case, then the name."""
    return placed(df, [F.desc("mentions"), F.lower("name"), F.col("name")])


def catalogue(df: DataFrame) -> DataFrame:
    """SO-05: by date (missing ones first, as empty text), then the name without case, then id."""
    return placed(df, [F.coalesce("date", F.lit("")), F.lower("name"), F.col("id")])


def institutions(df: DataFrame) -> DataFrame:
    """SO-06: entries, entries led and models, each most first, then name."""
    return placed(df, [F.desc("bench_all"), F.desc("bench_lead"), F.desc("models_all"), F.col("name")])


def countries(df: DataFrame) -> DataFrame:
    """SO-06: entries and entries led, each most first, then name."""
    return placed(df, [F.desc("bench_all"), F.desc("bench_lead"), F.col("name")])


def venues(df: DataFrame) -> DataFrame:
    """SO-07: largest total first, then name."""
    return placed(df, [F.desc("total"), F.col("name")])


def registry(df: DataFrame) -> DataFrame:
    """SO-07: by community, then the name without case, then id."""
    return placed(df, [F.col("community"), F.lower("name"), F.col("id")])


def models(df: DataFrame) -> DataFrame:
    """SO-08: most cells first; id decides between equals."""
    return placed(df, [F.desc("cells"), F.col("id")])


def findings(df: DataFrame) -> DataFrame:
    """SO-11: by severity, then id, then message."""
    return placed(df.withColumn("rank", listed(SEVERITIES, "severity")), [F.col("rank"), F.col("id"), F.col("message")]).drop("rank")


def refusals(df: DataFrame) -> DataFrame:
    """SO-11: by bucket, most cells first, then name (null as empty)."""
    rows = df.withColumn("rank", listed(BUCKETS, "bucket"))
    return placed(rows, [F.col("rank"), F.desc("cells"), F.coalesce("name", F.lit(""))]).drop("rank")


def far_sites(df: DataFrame) -> DataFrame:
    """SO-13: farthest first, then id."""
    return placed(df, [F.desc("km"), F.col("id")])


def triage(df: DataFrame, least: float) -> DataFrame:
    """SO-13, FIL-01: rows with the least score or more, highest first; input order decides between equals."""
    return placed(df.where(F.col("score") >= least), [F.desc("score"), F.col("ord")])
