"""Venues: evidence cascade, cross-source agreement, rollups and lags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cascade(entries: DataFrame, sources: list[tuple[str, DataFrame]], key: str = "id") -> DataFrame:
    """JN-13: each entry with the claim (venue, year) of the first source that has one; `source` names it, else preprint.

    sources: ordered (name, claims), at most one claim for each id. Claims are tagged by place and combined in one pass, instead
    of one join for each source.
    """
    tagged = [df.select(key, F.lit(k).alias("place"), F.lit(name).alias("source"), "venue", "year") for k, (name, df) in enumerate(sources)]
    claims = reduce(DataFrame.unionByName, tagged)
    best = claims.where(F.col("venue").isNotNull()).groupBy(key).agg(F.min_by(F.struct("source", "venue", "year"), "place").alias("c"))
    out = entries.join(best, key, "left")
    return out.select(*entries.columns, F.coalesce("c.source", F.lit("preprint")).alias("source"), F.col("c.venue").alias("venue"), F.col("c.year").alias("year"))


def agreement(claims: DataFrame, used: DataFrame, key: str = "id") -> DataFrame:
    """JN-14: of each entry, other sources that agree and disagree with the venue used."""
    both = claims.join(used.select(key, F.col("source").alias("_s"), F.col("venue").alias("_v")), key).where("source <> _s and venue is not null and _v is not null")
    return both.groupBy(key).agg(F.count_if(F.col("venue") == F.col("_v")).alias("agree"), F.count_if(F.col("venue") != F.col("_v")).alias("disagree"))


def state(status: Column, publishable: Column) -> Column:
    """AG-25: what isn't publishable is unchecked."""
    return F.when(F.coalesce(publishable, F.lit(False)), status).otherwise("unchecked")


def publishable(status: Column, verified: Column, evidence_url: Column, check_url: Column) -> Column:
    """FIL-09: a second read confirmed or corrected the record, and a claimed venue has an address that shows it."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.coalesce(verified.isin("confirmed", "corrected"), F.lit(False)) & (~status.isin("published", "accepted") | filled(evidence_url) | filled(check_url))


def ranking(records: DataFrame) -> DataFrame:
    """AG-26, SO-07: published, accepted and all entries of each venue, and its years as text."""
    per_year = records.groupBy("venue", F.substring("date", 1, 4).alias("year"), "status").agg(F.count("*").alias("n"))
    years = per_year.groupBy("venue", "year").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("status") == "published", F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("status") == "accepted", F.col("n")).otherwise(0)).alias("a"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "n"))), lambda x: F.concat_ws(":", x["year"], x["n"].cast("string"))), ",")
    return years.groupBy("venue").agg(F.sum("p").alias("published"), F.sum("a").alias("accepted"), F.sum("n").alias("total"), text.alias("years"))


def crosstab(df: DataFrame, row: Column, col: str, values: list[str]) -> DataFrame:
    """AG-28: counts of each row by column value; the values are given, so one pass is enough."""
    return df.groupBy(row.alias("row")).agg(*[F.count_if(F.col(col) == v).alias(v) for v in values], F.count("*").alias("total"))


def venue_ids(records: DataFrame) -> DataFrame:
    """AG-26: venue and ids, the entries of each venue in order. A venue's entries are in the result, so they meet in one row."""
    return records.groupBy("venue").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def counters(records: DataFrame, columns: list[str]) -> DataFrame:
    """AG-34: counter, value, n: how often each value of each column occurs, in one pass; null counts as the empty value."""
    cells = F.array(*[F.struct(F.lit(c).alias("counter"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns])
    return records.select(F.explode(cells).alias("c")).groupBy("c.counter", "c.value").agg(F.count("*").alias("n"))
