"""Queries over canonicalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import rules as R
from colophon.operators import canon as op
from colophon.plans.registry import query
from colophon.plans.views import CELLS, LINE_ORDER, ORDER_SQL, cells, with_views
from colophon.sources.tables import table

_FIRST = f"f AS (SELECT *, row_number() OVER (PARTITION BY benchmark, model, metric ORDER BY own DESC, {ORDER_SQL}) AS rn, first_value(value) OVER (PARTITION BY benchmark, model, metric ORDER BY own DESC, {ORDER_SQL}) AS kept_value FROM v_cells)"


@query("dedup_authority", with_views(CELLS, _FIRST) + " SELECT benchmark, model, metric, value, source, own FROM f WHERE rn = 1")
def dedup_authority(spark: SparkSession, d: str) -> DataFrame:
    return op.dedup_authority(cells(spark, d), LINE_ORDER).select("benchmark", "model", "metric", "value", "source", "own")


@query("conflict_log", with_views(CELLS, _FIRST) + " SELECT benchmark, model, metric, kept_value, value FROM f WHERE rn > 1 AND value <> kept_value")
def conflict_log(spark: SparkSession, d: str) -> DataFrame:
    return op.conflicts(cells(spark, d), LINE_ORDER)


_FINE = "fine AS (SELECT p_partkey AS benchmark, l_returnflag || '/' || l_linestatus AS metric, l_suppkey AS model, l_orderkey % 50 AS source, l_quantity AS value FROM lineitem JOIN part ON p_partkey = l_partkey)"


def _fine(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    return line.select(F.col("l_partkey").alias("benchmark"), F.concat_ws("/", "l_returnflag", "l_linestatus").alias("metric"), F.col("l_suppkey").alias("model"), (F.col("l_orderkey") % 50).alias("source"), F.col("l_quantity").alias("value"))


@query("scale_guard", f"WITH {_FINE}, s AS (SELECT benchmark, metric, model, source, bool_or(value <= 10) AS lo, bool_or(value >= 50) AS hi FROM fine GROUP BY 1, 2, 3, 4), m AS (SELECT benchmark, metric, model FROM s GROUP BY 1, 2, 3 HAVING bool_or(hi) AND bool_or(lo AND NOT hi)) SELECT DISTINCT benchmark, metric FROM m")
def scale_guard(spark: SparkSession, d: str) -> DataFrame:
    return op.rescaled_metrics(_fine(spark, d))


@query("scale_labels", f"""WITH {_FINE}, s AS (SELECT benchmark, metric, model, source, bool_or(value <= 10) AS lo, bool_or(value >= 50) AS hi FROM fine GROUP BY 1, 2, 3, 4),
r AS (SELECT DISTINCT benchmark, metric FROM s GROUP BY benchmark, metric, model HAVING bool_or(hi) AND bool_or(lo AND NOT hi)),
l AS (SELECT CASE WHEN r.metric IS NULL THEN fine.metric WHEN value <= 10 THEN fine.metric || ' [0-10 scale]' ELSE fine.metric || ' [0-100 scale]' END AS label FROM fine LEFT JOIN r USING (benchmark, metric))
SELECT label, count(*) AS n FROM l GROUP BY 1""")
def scale_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = _fine(spark, d)
    return op.scale_guard(rows, rows).groupBy(F.col("metric").alias("label")).agg(F.count("*").alias("n"))


@query("min_cells", with_views(CELLS, _FIRST, "k AS (SELECT * FROM f WHERE rn = 1)", "m AS (SELECT model FROM k GROUP BY 1 HAVING count(*) >= 20)") + " SELECT benchmark, model, metric, value FROM k WHERE model IN (SELECT model FROM m)")
def min_cells(spark: SparkSession, d: str) -> DataFrame:
    kept = op.dedup_authority(cells(spark, d), LINE_ORDER)
    return op.enough_cells(kept, 20).select("benchmark", "model", "metric", "value")


_BUCKET = "CASE WHEN value < 3 THEN 'not_a_model' WHEN value < 6 THEN 'unknown_benchmark' ELSE 'unmapped_model' END"


@query("refusal_ledger", with_views(CELLS, f"r AS (SELECT {_BUCKET} AS bucket, model AS name, benchmark, source, metric FROM v_cells)", "b AS (SELECT bucket, name, array_to_string(list_sort(list(DISTINCT benchmark))[1:8], ',') AS benchmarks FROM r GROUP BY 1, 2)") + " SELECT bucket, name, count(*) AS cells, count(DISTINCT benchmark) AS n_benchmarks, count(DISTINCT source) AS n_papers, count(DISTINCT metric) AS n_metrics, any_value(benchmarks) AS benchmarks FROM r JOIN b USING (bucket, name) GROUP BY 1, 2")
def refusal_ledger(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.when(F.col("value") < 3, "not_a_model").when(F.col("value") < 6, "unknown_benchmark").otherwise("unmapped_model")
    return op.refusals(cells(spark, d), bucket, F.col("model"))


@query("benchmark_index", "WITH n AS (SELECT regexp_replace(lower(x), '[^a-z0-9]', '', 'g') AS key, p_brand || '-' || p_size AS id, p_partkey AS ord, pos FROM (SELECT *, p_brand || '-' || p_size AS x, 0 AS pos FROM part UNION ALL SELECT *, p_name, 1 FROM part UNION ALL SELECT *, p_type, 2 FROM part)) SELECT key, arg_min(id, struct_pack(o := ord, p := pos)) AS id FROM n WHERE key <> '' GROUP BY 1")
def benchmark_index(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("id"), F.col("p_name").alias("name"), F.array("p_type").alias("aka"))
    return op.benchmark_index(p)


_MODELS = (("(?i)brand#1", "alpha"), ("(?i)brand-?2[2-4]", "beta"), (r"(?i)^brand#(3[1-5])$", "gamma"))


@query("model_registry", """SELECT p_brand AS raw, CASE WHEN p_brand LIKE '%5' THEN NULL WHEN p_brand LIKE 'Brand#1%' THEN 'alpha' WHEN regexp_matches(p_brand, '(?i)brand-?2[2-4]') THEN 'beta' WHEN regexp_matches(p_brand, '(?i)^brand#(3[1-5])$') THEN 'gamma' ELSE 'UNMAPPED' END AS model, count(*) AS n FROM part GROUP BY 1, 2""")
def model_registry(spark: SparkSession, d: str) -> DataFrame:
    """JN-09, FIL-04..06: printed names by an ordered registry, on distinct names only."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("raw"))
    named = R.on_distinct(p, "raw", "model", lambda c: R.model_of(c, _MODELS, drop_any=("5$",)))
    return named.groupBy("raw", "model").agg(F.count("*").alias("n"))
