"""Queries over the orders of the catalogue's tables: each row with its place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import orders as op
from colophon.plans.registry import query
from colophon.sources.tables import table


def _number(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) AS place"


@query("ledger_order", f"SELECT event_id AS id, {_number('ts DESC, event_id')} FROM events")
def ledger_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-03."""
    return op.ledger(table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("published"))).select("id", "place")


@query("roster_order", f"WITH m AS (SELECT p_name AS name, count(*) AS mentions FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) SELECT name, mentions, {_number('mentions DESC, lower(name), name')} FROM m")
def roster_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-04."""
    line, part = table(spark, d, "lineitem").select("l_partkey"), table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"))
    return op.roster(line.join(part, line["l_partkey"] == part["p_partkey"]).groupBy("name").agg(F.count("*").alias("mentions"))).select("name", "mentions", "place")


@query("catalogue_order", f"WITH c AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, o_orderpriority AS name FROM orders) SELECT id, {_number("coalesce(date, ''), lower(name), id")} FROM c")
def catalogue_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-05."""
    date = F.when(F.col("o_orderkey") % 50 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return op.catalogue(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), date.alias("date"), F.col("o_orderpriority").alias("name"))).select("id", "place")


@query("institution_order", f"""WITH i AS (SELECT s_name AS name, count(DISTINCT l_orderkey) AS bench_all, count(DISTINCT l_orderkey) FILTER (l_linenumber = 1) AS bench_lead, count(DISTINCT l_partkey) AS models_all FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
 SELECT name, bench_all, bench_lead, models_all, {_number('bench_all DESC, bench_lead DESC, models_all DESC, name')} FROM i""")
def institution_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-06."""
    per = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("bench_all"), F.count_distinct(F.when(F.col("l_linenumber") == 1, F.col("l_orderkey"))).alias("bench_lead"), F.count_distinct("l_partkey").alias("models_all"))
    names = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return op.institutions(per.join(names, per["l_suppkey"] == names["s_suppkey"]).drop("l_suppkey", "s_suppkey"))


@query("country_order", f"""WITH i AS (SELECT n_name AS name, count(DISTINCT l_orderkey) AS bench_all, count(DISTINCT l_orderkey) FILTER (l_linenumber = 1) AS bench_lead FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)
 SELECT name, bench_all, bench_lead, {_number('bench_all DESC, bench_lead DESC, name')} FROM i""")
def country_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-06."""
    line, supplier, nation = table(spark, d, "lineitem"), table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    rows = line.join(supplier, line["l_suppkey"] == supplier["s_suppkey"]).join(nation, F.col("s_nationkey") == nation["n_nationkey"])
    return op.countries(rows.groupBy("name").agg(F.count_distinct("l_orderkey").alias("bench_all"), F.count_distinct(F.when(F.col("l_linenumber") == 1, F.col("l_orderkey"))).alias("bench_lead")))


@query("venue_order", f"WITH v AS (SELECT p_type AS name, count(*) AS total FROM part GROUP BY 1) SELECT name, total, {_number('total DESC, name')} FROM v")
def venue_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-07."""
    return op.venues(table(spark, d, "part").groupBy(F.col("p_type").alias("name")).agg(F.count("*").alias("total")))


@query("registry_order", f"SELECT p_partkey AS id, {_number('p_brand, lower(p_name), p_partkey')} FROM part")
def registry_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-07."""
    return op.registry(table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("community"), F.col("p_name").alias("name"))).select("id", "place")


@query("model_order", f"WITH m AS (SELECT l_suppkey AS id, count(*) AS cells FROM lineitem GROUP BY 1) SELECT id, cells, {_number('cells DESC, id')} FROM m")
def model_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-08."""
    return op.models(table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("cells")))


@query("finding_order", f"WITH f AS (SELECT o_orderkey AS id, ['LOW', 'HIGH', 'MED'][o_orderkey % 3 + 1] AS severity, o_orderstatus AS message FROM orders) SELECT id, severity, {_number("CASE severity WHEN 'HIGH' THEN 0 WHEN 'MED' THEN 1 ELSE 2 END, id, message")} FROM f")
def finding_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-11."""
    severity = F.element_at(F.array(*map(F.lit, ("LOW", "HIGH", "MED"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return op.findings(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), severity.alias("severity"), F.col("o_orderstatus").alias("message"))).select("id", "severity", "place")


@query("refusal_order", f"""WITH r AS (SELECT ['not_a_model', 'unknown_benchmark', 'below_min_cells', 'unmapped_model'][p_size % 4 + 1] AS bucket, p_name AS name, count(*) AS cells FROM part GROUP BY 1, 2)
 SELECT bucket, name, cells, {_number("list_position(['unmapped_model', 'below_min_cells', 'unknown_benchmark', 'not_a_model'], bucket), cells DESC, name")} FROM r""")
def refusal_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-11."""
    bucket = F.element_at(F.array(*map(F.lit, ("not_a_model", "unknown_benchmark", "below_min_cells", "unmapped_model"))), F.col("p_size") % 4 + 1)
    return op.refusals(table(spark, d, "part").groupBy(bucket.alias("bucket"), F.col("p_name").alias("name")).agg(F.count("*").alias("cells")))


@query("far_order", f"SELECT c_custkey AS id, {_number('round(c_acctbal) DESC, c_custkey')} FROM customer")
def far_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-13."""
    return op.far_sites(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.round("c_acctbal").alias("km"))).select("id", "place")


@query("triage_order", f"SELECT event_id AS id, {_number('value DESC, event_id')} FROM events WHERE value >= 22")
def triage_order(spark: SparkSession, d: str) -> DataFrame:
    """SO-13, FIL-01."""
    return op.triage(table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("value").alias("score"), F.col("event_id").alias("ord")), 22).select("id", "place")
