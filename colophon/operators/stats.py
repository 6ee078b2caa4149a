"""Catalogue statistics: counts, shares, medians and crosstabs. All distinct counts are exact; all sorts have a full tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quarter_label(date: Column) -> Column:
    """FN-42: yyyyQn of a yyyy-MM[-dd] text."""
    month = F.substring(date, 6, 2).try_cast("int")
    return F.concat(F.substring(date, 1, 4), F.lit("Q"), (F.floor((month - 1) / 3) + 1).cast("string"))


def share_of_total(df: DataFrame, by: list[str], top: int) -> DataFrame:
    """AG-09: the `top` groups with most rows, ties by key, and their share of all rows."""
    counts = df.groupBy(*by).agg(F.count("*").alias("cells"))
    total = counts.agg(F.sum("cells").alias("total"))
    best = counts.orderBy(F.desc("cells"), *by).limit(top)
    return best.crossJoin(total).select(*by, "cells", (F.lit(100.0) * F.col("cells") / F.col("total")).alias("share_pct"))


def zero_filled(facts: DataFrame, dimension: DataFrame, key: str, name: str = "n") -> DataFrame:
    """AG-01: a count for each row of the dimension, zero where it has no facts."""
    counts = facts.groupBy(key).agg(F.count("*").alias(name))
    return dimension.select(key).join(counts, key, "left").select(key, F.coalesce(name, F.lit(0)).alias(name))


def since_counts(catalogue: DataFrame, cut: str) -> DataFrame:
    """AG-02: entries since and before a date (compared as text), and without one, in one pass."""
    dated = F.coalesce(F.col("date"), F.lit("")) != ""
    return catalogue.agg(F.count("*").alias("total"), F.count_if(dated & (F.col("date") >= cut)).alias("since"), F.count_if(dated & (F.col("date") < cut)).alias("pre"), F.count_if(~dated).alias("undated"))


def distinct_with_null(df: DataFrame, col: str, name: str) -> DataFrame:
    """AG-05: distinct values, where a missing value counts as one."""
    return df.agg((F.count_distinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("long")), F.lit(0))).alias(name))


def adoption(cells: DataFrame) -> DataFrame:
    """AG-07: distinct third-party sources of each benchmark."""
    return cells.where(~F.col("own")).groupBy("benchmark").agg(F.count_distinct("source").alias("papers"))


def self_reported(cells: DataFrame, by: str = "benchmark") -> DataFrame:
    """AG-08: keys with third-party results, and those with their own results only; one aggregation instead of a set difference."""
    per = cells.groupBy(by).agg(F.every("own").alias("only_own"))
    return per.agg(F.count_if(~F.col("only_own")).alias("run_by_others"), F.count_if("only_own").alias("only_self"))


def median_of_distinct(df: DataFrame, by: str, col: str, name: str) -> DataFrame:
    """AG-10: the interpolated median, over groups, of their distinct values."""
    return df.groupBy(by).agg(F.count_distinct(col).alias("n")).agg(F.median("n").alias(name))


def density(cells: DataFrame, a: str, b: str) -> DataFrame:
    """AG-11: filled pairs of the matrix a x b, in percent."""
    pairs = cells.select(a, b).distinct()
    return pairs.agg((F.lit(100.0) * F.count("*") / (F.count_distinct(a) * F.count_distinct(b))).alias("density_pct"))


def component_spread(cells: DataFrame, keys: list[str], is_total: Column, least: int = 4) -> DataFrame:
    """AG-12: of groups with a total and at least `least` components, all from 0 to 100, the largest less the smallest component."""
    value = F.when(~is_total, F.col("value"))
    per = cells.groupBy(*keys).agg(F.count_if(is_total).alias("totals"), F.count(value).alias("components"), F.min(value).alias("low"), F.max(value).alias("high"))
    return per.where((F.col("totals") >= 1) & (F.col("components") >= least) & (F.col("low") >= 0) & (F.col("high") <= 100)).select(*keys, (F.col("high") - F.col("low")).alias("spread"))


def cooccurrence(df: DataFrame, item: str, tag: str) -> DataFrame:
    """AG-37: for each pair of tags (a < b), the items that have both. The tags of an item are few; they are collected per item."""
    tags = df.select(item, tag).distinct().groupBy(item).agg(F.array_sort(F.collect_list(tag)).alias("tags"))
    pairs = tags.select(F.explode(F.flatten(F.transform("tags", lambda a: F.transform(F.filter("tags", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p"))
    return pairs.groupBy("p.a", "p.b").agg(F.count("*").alias("items"))


def disagreements(cells: DataFrame) -> DataFrame:
    """AG-37, PR-03: every observation of a (benchmark, model, metric) with several values, beside the number of observations and of values, the least and the largest."""
    cell = Window.partitionBy("benchmark", "model", "metric")
    place = F.dense_rank().over(cell.orderBy(F.asc_nulls_last("value")))
    ranked = cells.withColumn("place", F.when(F.col("value").isNotNull(), place))
    counts = {"n": F.count("*"), "n_values": F.max("place"), "low": F.min("value"), "high": F.max("value")}
    return ranked.withColumns({name: c.over(cell) for name, c in counts.items()}).where("n_values > 1").withColumn("n_values", F.col("n_values").cast("long")).drop("place")


def weighted_mode(df: DataFrame, keys: list[str], value: str, weight: Column) -> DataFrame:
    """AG-16: of each group the value with the largest weight; ties go to the smaller value, null values are left out."""
    sums = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("weight"))
    w = Window.partitionBy(*keys).orderBy(F.desc("weight"), value)
    return sums.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")
