"""Presentation contracts: one metric for each column, the wide matrix, all disagreeing observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def best_metric(cells: DataFrame, is_aggregate: Column) -> DataFrame:
    """PR-01: of each benchmark one metric: an aggregate first, then the one most models have, then by name; `others` counts the rest."""
    per = cells.groupBy("benchmark", "metric").agg(F.count_distinct("model").alias("models"), F.bool_or(is_aggregate).alias("agg"))
    w = Window.partitionBy("benchmark")
    ranked = per.withColumn("r", F.row_number().over(w.orderBy(F.desc("agg"), F.desc("models"), "metric"))).withColumn("others", F.count("*").over(w) - 1)
    return ranked.where("r = 1").select("benchmark", "metric", "models", "others")


def matrix(cells: DataFrame, columns: list[str]) -> DataFrame:
    """PR-02, SO-14: a row for each model, a column for each benchmark (null where it isn't reported), and how many it covers."""
    wide = cells.groupBy("model").agg(*[F.max(F.when(F.col("benchmark") == c, F.col("value"))).alias(c.lower().replace("#", "_")) for c in columns])
    covered = sum((F.col(c.lower().replace("#", "_")).isNotNull().cast("int") for c in columns), F.lit(0))
    return wide.withColumn("covered", covered)
