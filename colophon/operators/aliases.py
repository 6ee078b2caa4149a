"""Metric aliases: fingerprints of observations, reviewed groups, their evidence, the metric index and its gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.operators.graph import reached
from colophon.sources.tables import many

#: Scores at the bounds of a scale, which don't count as evidence.
BOUNDS = (0.0, 1.0, 100.0)


def json_text(c: Column) -> Column:
    """A JSON string or null."""
    return F.when(c.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(c.cast("string").alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1))


def number_text(x: Column) -> Column:
    """A double as ECMAScript prints it, between 1e-6 and 1e21: no exponent, no trailing zeros."""
    fixed = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,17)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    short = x.cast("string")
    return F.when(short.contains("E"), fixed).otherwise(F.regexp_replace(short, r"\.0$", ""))


def fingerprint(benchmark: Column, model: Column, metric: Column, kind: Column, value: Column, source: Column, url: Column, note: Column) -> Column:
    """FN-30: SHA-256 of the observation as a JSON array; kind is the value's type and value its printed form, so 0.8 and "0.8" differ."""
    parts = [json_text(x) for x in (benchmark, model, metric)] + [F.concat(F.lit("["), json_text(kind), F.lit(","), json_text(value), F.lit("]"))] + [json_text(x) for x in (source, url, note)]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")), 256)


def variant_kind(v: Column) -> tuple[Column, Column]:
    """Type and printed form of a VARIANT value: ("number", "12.3") or ("string", "12.3 ± 0.2")."""
    schema = F.schema_of_variant(v)
    text = F.when(schema == "STRING", F.variant_get(v, "$", "string")).otherwise(number_text(F.try_variant_get(v, "$", "double")))
    return F.when(schema == "STRING", "string").otherwise("number"), text


def evidence_edges(members: DataFrame) -> DataFrame:
    """JN-21: edges (group, a, b) of members that share three equal values or more, three of them distinct and not at a bound.

    members: group, member, paper, metric, model, value (double). Pairs meet on equal (group, model, value), of different papers
    and metrics.
    """
    right = members.select("group", "model", "value", F.col("member").alias("b"), F.col("paper").alias("_p"), F.col("metric").alias("_m"))
    pairs = members.where("value is not null").join(many(right), ["group", "model", "value"]).where((F.col("member") < F.col("b")) & (F.col("paper") != F.col("_p")) & (F.col("metric") != F.col("_m")))
    inner = F.when(~F.col("value").isin(*BOUNDS), F.col("value"))
    counts = pairs.groupBy("group", F.col("member").alias("a"), "b").agg(F.count_distinct("model").alias("n"), F.count_distinct(inner).alias("v"))
    return counts.where("n >= 3 and v >= 3").select("group", "a", "b")


def connectivity(members: DataFrame) -> DataFrame:
    """GR-03: of each group its members and how many of them the evidence connects to the least one."""
    return reached(members.select("group", "member").distinct(), evidence_edges(members))


def _keyed(cells: DataFrame, assigned: DataFrame) -> DataFrame:
    named = cells.join(many(assigned.select("fp", "group")), "fp", "left")
    return named.withColumn("key", F.coalesce(F.concat(F.lit("alias:"), "group"), F.concat(F.lit("raw:"), "metric")))


def metric_index(cells: DataFrame, assigned: DataFrame) -> DataFrame:
    """PR-04, JN-20: benchmark, key (alias:<group> or raw:<metric>), model, cells (their ords in order).

    cells: ord, fp, benchmark, metric, model. assigned: fp, group. Cells without an assignment stay under their raw name.
    """
    return _keyed(cells, assigned).groupBy("benchmark", "key", "model").agg(F.array_sort(F.collect_list("ord")).alias("cells"))


def option_counts(cells: DataFrame, assigned: DataFrame) -> DataFrame:
    """AG-31: of each benchmark its metric options before and after aliasing, and cells with several sources."""
    index = _keyed(cells, assigned).groupBy("benchmark", "key", "model").agg(F.count("*").alias("n"))  # counts, not lists of cells
    after = index.groupBy("benchmark").agg(F.count_distinct("key").alias("after"), F.count_if(F.col("n") > 1).alias("multi"))
    return cells.groupBy("benchmark").agg(F.count_distinct("metric").alias("before")).join(after, "benchmark")


def labels(options: DataFrame) -> DataFrame:
    """WN-05: options (benchmark, key, label, reviewed); an unreviewed label that a reviewed one shares gets a suffix."""
    both = options.groupBy("benchmark", "label").agg(F.bool_or("reviewed").alias("_r"), F.count("*").alias("_n"))
    out = options.join(both, ["benchmark", "label"])
    return out.withColumn("label", F.when(F.col("_r") & (F.col("_n") > 1) & ~F.col("reviewed"), F.concat("label", F.lit(" · other sources"))).otherwise(F.col("label"))).drop("_r", "_n")


def registry_violations(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """GT-06: gate, id, detail of an alias registry against the cells (ord, fp, benchmark, metric, model, value, source_url).

    groups: id, benchmark, label, definition, members (metric, paper, locator, evidence_url, source_urls, cell_ids).
    """
    out = lambda df, gate, detail: df.select(F.lit(gate).alias("gate"), F.col("id").cast("string").alias("id"), detail.cast("string").alias("detail"))
    none = F.lit(None)
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    m = groups.select("id", "benchmark", F.posexplode("members").alias("member", "m")).select("id", "benchmark", "member", "m.*")
    ids = m.select("id", "benchmark", "member", "metric", "paper", "source_urls", F.explode("cell_ids").alias("fp"))
    hit = ids.join(many(cells.select("fp", "ord", F.col("benchmark").alias("_b"), F.col("metric").alias("_m"), "model", "value", "source_url")), "fp")
    numeric = hit.select(F.col("id").alias("group"), "member", "paper", "metric", "model", T.number(F.col("value").cast("string")).alias("value"))
    linked = connectivity(numeric).withColumnRenamed("group", "id")
    return (
        out(groups.where(empty("id") | empty("benchmark") | empty("label") | empty("definition") | (F.coalesce(F.size("members"), F.lit(0)) < 2)), "incomplete group", none)
        .unionByName(out(groups.groupBy("id").count().where("count > 1"), "duplicate group id", none))
        .unionByName(out(m.where(empty("metric") | empty("paper") | empty("locator") | ~T.paper_of_url(F.col("evidence_url")).eqNullSafe(F.col("paper"))), "missing source evidence", F.col("metric")))
        .unionByName(out(m.where((F.coalesce(F.size("source_urls"), F.lit(0)) < 1) | F.exists("source_urls", lambda u: ~T.paper_of_url(u).eqNullSafe(F.col("paper")))), "paper identity mismatch", F.col("metric")))
        .unionByName(out(ids.join(many(cells.select("fp")), "fp", "left_anti"), "stale reviewed observation", F.col("fp")))
        .unionByName(out(ids.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n > 1"), "assigned more than once", F.col("fp")))
        .unionByName(out(hit.where((F.col("benchmark") != F.col("_b")) | (F.col("metric") != F.col("_m")) | ~F.array_contains("source_urls", F.col("source_url"))), "source scope mismatch", F.col("fp")))
        .unionByName(out(hit.groupBy("id", "model").agg(F.count_distinct("value").alias("n")).where("n > 1"), "contradictory model values", F.col("model")))
        .unionByName(out(m.groupBy("id").agg(F.count_distinct("paper").alias("n")).where("n < 2"), "cross-paper evidence required", none))
        .unionByName(out(linked.where("n_reached < n_members"), "insufficient cross-paper matching evidence", none))
    )
