"""Canonical result cells: index lookups, deduplication with authority, scale guard, minimum cells, refusals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.functions import textnorm as T

KEYS = ["benchmark", "model", "metric"]


def benchmark_index(catalogue: DataFrame) -> DataFrame:
    """JN-08: key, id of every id, name and alias of a catalogue (ord, id, name, aka); the first registration of a key wins."""
    names = catalogue.select("ord", "id", F.posexplode(F.concat(F.array("id", "name"), F.coalesce("aka", F.array().cast("array<string>")))).alias("pos", "n"))
    keyed = names.select(T.key(F.col("n")).alias("key"), "id", "ord", "pos").where("key <> ''")
    return keyed.groupBy("key").agg(F.min_by("id", F.struct("ord", "pos")).alias("id"))


def dedup_authority(cells: DataFrame, order: list[str]) -> DataFrame:
    """WN-01: the first cell of each (benchmark, model, metric). A minimum over structs, combined before the shuffle."""
    first = F.min_by(F.struct(*[c for c in cells.columns if c not in KEYS]), F.struct((~F.col("own")).alias("_not_own"), *order))
    return cells.groupBy(*KEYS).agg(first.alias("c")).select(*KEYS, "c.*")


def conflicts(cells: DataFrame, order: list[str]) -> DataFrame:
    """WN-01: cells with another value than the one kept of their (benchmark, model, metric), with both values.

    The kept value is joined back, so a key with very many cells is split by adaptive execution.
    """
    kept = dedup_authority(cells, order).select(*KEYS, F.col("value").alias("kept_value"))
    return cells.join(kept, KEYS).where(F.col("value").cast("string") != F.col("kept_value").cast("string")).select(*KEYS, "kept_value", "value")


def rescaled_metrics(cells: DataFrame, low: float = 10, high: float = 50) -> DataFrame:
    """WN-03: (benchmark, metric) for which a model has values <= low and >= high, and some source of the low ones has no high one.

    A (model, source) pair is reduced to two flags first, so that sources aren't collected; values between the bounds set neither
    flag and go before that.
    """
    outer = cells.where(~F.col("metric").contains("%") & ((F.col("value") <= low) | (F.col("value") >= high)))
    per_source = outer.groupBy("benchmark", "metric", "model", "source").agg(F.bool_or(F.col("value") <= low).alias("lo"), F.bool_or(F.col("value") >= high).alias("hi"))
    per_model = per_source.groupBy("benchmark", "metric", "model").agg(F.bool_or("hi").alias("hi"), F.bool_or(F.col("lo") & ~F.col("hi")).alias("lo_only"))
    return per_model.where("hi and lo_only").select("benchmark", "metric").distinct()


def scale_guard(kept: DataFrame, cells: DataFrame, low: float = 10, high: float = 50) -> DataFrame:
    """WN-03: kept cells, relabelled by scale where the metric was rescaled in the cells before deduplication."""
    marked = kept.join(rescaled_metrics(cells, low, high).withColumn("_split", F.lit(True)), ["benchmark", "metric"], "left")
    label = F.when(F.col("value") <= low, F.concat("metric", F.lit(" [0-10 scale]"))).otherwise(F.concat("metric", F.lit(" [0-100 scale]")))
    return marked.withColumn("metric", F.when(F.col("_split"), label).otherwise(F.col("metric"))).drop("_split")


def enough_cells(kept: DataFrame, least: int = 3) -> DataFrame:
    """WN-04: the cells of models that have `least` cells or more; a count joined back, as the window would sort all cells."""
    models = kept.groupBy("model").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("model")
    return kept.join(models, "model", "left_semi")


def refusals(refused: DataFrame, bucket: Column, name: Column, samples: int = 8) -> DataFrame:
    """AG-15: of each refused (bucket, name): cells, distinct benchmarks, sources and metrics, and the first benchmarks in order."""
    rows = refused.select(bucket.alias("bucket"), name.alias("name"), "benchmark", "source", "metric")
    agg = rows.groupBy("bucket", "name").agg(
        F.count("*").alias("cells"), F.count_distinct("benchmark").alias("n_benchmarks"), F.count_distinct("source").alias("n_papers"), F.count_distinct("metric").alias("n_metrics"),
    )
    return agg.join(_samples(rows, ["bucket", "name"], "benchmark", samples).withColumnRenamed("benchmark", "benchmarks"), ["bucket", "name"])


def _samples(rows: DataFrame, by: list[str], col: str, most: int) -> DataFrame:
    """The first `most` distinct values of a column in each group, joined by commas; groups without a value have no row."""
    first = rows.where(F.col(col).isNotNull()).select(*by, col).distinct().withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(col))).where(F.col("r") <= most)
    return first.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(col)), ",").alias(col))


def refusal_samples(refused: DataFrame, bucket: Column, name: Column) -> DataFrame:
    """AG-15: of each refused (bucket, name) where it was seen: the first eight benchmarks and papers and four metrics, distinct, in order."""
    by = ["bucket", "name"]
    rows = refused.select(bucket.alias("bucket"), name.alias("name"), *[F.col(c).cast("string").alias(c) for c in ("benchmark", "source", "metric")])
    out = rows.select(*by).distinct()
    for col, most in (("benchmark", 8), ("source", 8), ("metric", 4)):
        out = out.join(_samples(rows, by, col, most), by, "left")
    return out.select(*by, *[F.coalesce(c, F.lit("")).alias(n) for c, n in (("benchmark", "benchmarks"), ("source", "papers"), ("metric", "metrics"))])
