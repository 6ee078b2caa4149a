"""Queries over the statistics operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import stats as op
from colophon.plans.registry import query
from colophon.plans.views import CATALOGUE, CELLS, OCCURRENCES, PAPERS, catalogue, cells, occurrences, papers, with_views
from colophon.sources.tables import by_rows, many, table


@query("model_concentration", """
WITH m AS (SELECT l_suppkey AS model, count(*) AS cells FROM lineitem GROUP BY 1), t AS (SELECT sum(cells) AS total FROM m)
SELECT model, cells, 100.0::DOUBLE * cells / total AS share_pct FROM m, t ORDER BY cells DESC, model LIMIT 9""")
def model_concentration(spark: SparkSession, d: str) -> DataFrame:
    """AG-09: the nine models with most cells, and their share of all."""
    return op.share_of_total(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("model")), ["model"], 9)


@query("by_year", with_views(CATALOGUE) + " SELECT substr(date, 1, 4) AS year, count(*) AS n FROM v_catalogue GROUP BY 1")
def by_year(spark: SparkSession, d: str) -> DataFrame:
    return catalogue(spark, d).groupBy(F.substring("date", 1, 4).alias("year")).agg(F.count("*").alias("n"))


@query("by_quarter", with_views(CATALOGUE) + " SELECT substr(date, 1, 4) || 'Q' || ((CAST(substr(date, 6, 2) AS INT) - 1) // 3 + 1) AS quarter, count(*) AS n FROM v_catalogue WHERE date >= '1994-01' GROUP BY 1")
def by_quarter(spark: SparkSession, d: str) -> DataFrame:
    rows = catalogue(spark, d).where(F.col("date") >= "1994-01")
    return rows.groupBy(op.quarter_label(F.col("date")).alias("quarter")).agg(F.count("*").alias("n"))


@query("since_counts", with_views(CATALOGUE) + " SELECT count(*) AS total, count(*) FILTER (date >= '1996-01') AS since, count(*) FILTER (date < '1996-01') AS pre, count(*) FILTER (date IS NULL) AS undated FROM v_catalogue")
def since_counts(spark: SparkSession, d: str) -> DataFrame:
    return op.since_counts(catalogue(spark, d), "1996-01")


@query("slots_by_group", with_views(OCCURRENCES) + " SELECT region AS group_name, count(*) AS slots FROM (SELECT DISTINCT entry, country, region FROM v_occ) GROUP BY 1")
def slots_by_group(spark: SparkSession, d: str) -> DataFrame:
    """AG-04. A place (country and region) is a number until its entries are counted; a task holds a bounded number of rows."""
    line, orders, supplier, nation, region = (table(spark, d, t) for t in ("lineitem", "orders", "supplier", "nation", "region"))
    nations = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    places = nations.groupBy("n_name", "r_name").agg(F.min("n_nationkey").alias("place"))
    place_of = nations.join(places, ["n_name", "r_name"]).select("n_nationkey", "place").distinct()
    sites = supplier.join(place_of, supplier["s_nationkey"] == place_of["n_nationkey"]).select("s_suppkey", "place").distinct()
    n = line.count()
    rows = by_rows(line.join(sites, line["l_suppkey"] == sites["s_suppkey"]).select("l_orderkey", "place"), n, "l_orderkey")
    slots = rows.join(many(by_rows(orders.select("o_orderkey"), n, "o_orderkey")), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").distinct()
    per = slots.groupBy("place").agg(F.count("*").alias("n"))
    return per.join(places, "place").groupBy(F.col("r_name").alias("group_name")).agg(F.sum("n").alias("slots"))


@query("category_counts", "SELECT n_name AS country, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1")
def category_counts(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("country"))
    rich = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return op.zero_filled(rich, nations, "k").join(nations, "k").select("country", "n")


@query("distinct_sources", "SELECT count(DISTINCT nullif(l_orderkey % 7, 3)) + 1 AS sources FROM lineitem")
def distinct_sources(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.nullif(F.col("l_orderkey") % 7, F.lit(3)).alias("source_url"))
    return op.distinct_with_null(rows, "source_url", "sources")


@query("every_cell_sourced", "SELECT bool_and(l_orderkey IS NOT NULL) AS every_sourced, bool_and(l_quantity > 1) AS every_above_one FROM lineitem")
def every_cell_sourced(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").agg(F.every(F.col("l_orderkey").isNotNull()).alias("every_sourced"), F.every(F.col("l_quantity") > 1).alias("every_above_one"))


@query("adoption_hist", with_views(CELLS, "a AS (SELECT benchmark, count(DISTINCT source) AS papers FROM v_cells WHERE NOT own GROUP BY 1)") + " SELECT papers, count(*) AS benchmarks FROM a GROUP BY 1")
def adoption_hist(spark: SparkSession, d: str) -> DataFrame:
    per = op.adoption(cells(spark, d))
    return per.groupBy("papers").agg(F.count("*").alias("benchmarks"))


@query("self_reported_only", with_views(CELLS, "p AS (SELECT model, bool_and(own) AS o FROM v_cells GROUP BY 1)") + " SELECT count(*) FILTER (NOT o) AS run_by_others, count(*) FILTER (o) AS only_self FROM p")
def self_reported_only(spark: SparkSession, d: str) -> DataFrame:
    return op.self_reported(cells(spark, d), "model")


@query("median_models", with_views(CELLS, "p AS (SELECT metric || benchmark AS k, count(DISTINCT model) AS n FROM v_cells GROUP BY 1)") + " SELECT median(n) AS median_models FROM p")
def median_models(spark: SparkSession, d: str) -> DataFrame:
    rows = cells(spark, d).withColumn("k", F.concat("metric", "benchmark"))
    return op.median_of_distinct(rows, "k", "model", "median_models")


@query("matrix_density", with_views(CELLS, "p AS (SELECT DISTINCT source, model FROM v_cells)") + " SELECT 100.0::DOUBLE * count(*) / (count(DISTINCT source) * count(DISTINCT model)) AS density_pct FROM p")
def matrix_density(spark: SparkSession, d: str) -> DataFrame:
    return op.density(cells(spark, d), "source", "model")


_SPREAD = with_views(CELLS, """g AS (
  SELECT benchmark, model, max(value) FILTER (metric <> 'A/F') AS high, min(value) FILTER (metric <> 'A/F') AS low,
         count(*) FILTER (metric = 'A/F') AS totals, count(*) FILTER (metric <> 'A/F') AS components
  FROM v_cells GROUP BY 1, 2)""")


@query("component_spread", _SPREAD + " SELECT benchmark, model, high - low AS spread FROM g WHERE totals >= 1 AND components >= 4 AND low >= 0 AND high <= 100")
def component_spread(spark: SparkSession, d: str) -> DataFrame:
    return op.component_spread(cells(spark, d), ["benchmark", "model"], F.col("metric") == "A/F")


@query("median_component_spread", _SPREAD + " SELECT median(high - low) AS median_spread, count(*) AS pairs FROM g WHERE totals >= 1 AND components >= 4 AND low >= 0 AND high <= 100")
def median_component_spread(spark: SparkSession, d: str) -> DataFrame:
    return op.component_spread(cells(spark, d), ["benchmark", "model"], F.col("metric") == "A/F").agg(F.median("spread").alias("median_spread"), F.count("*").alias("pairs"))


@query("cooccurrence", with_views(OCCURRENCES, "t AS (SELECT DISTINCT entry, region FROM v_occ)") + " SELECT x.region AS a, y.region AS b, count(*) AS items FROM t x JOIN t y ON x.entry = y.entry AND x.region < y.region GROUP BY 1, 2")
def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return op.cooccurrence(occurrences(spark, d), "entry", "region")


@query("disagreements", with_views(CELLS, "g AS (SELECT benchmark, model, metric, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS low, max(value) AS high FROM v_cells GROUP BY 1, 2, 3 HAVING count(DISTINCT value) > 1)") + """
SELECT c.benchmark, c.model, c.metric, c.value, c.source, c.l_linenumber AS line, g.n, g.n_values, g.low, g.high
FROM v_cells c JOIN g ON c.benchmark IS NOT DISTINCT FROM g.benchmark AND c.model IS NOT DISTINCT FROM g.model AND c.metric IS NOT DISTINCT FROM g.metric""")
def disagreements(spark: SparkSession, d: str) -> DataFrame:
    """AG-37, PR-03: all observations that disagree, each with its source and line. A task holds a bounded number of the cells."""
    n = table(spark, d, "lineitem").count()
    rows = cells(spark, d, n).select("benchmark", "model", "metric", "value", "source", F.col("l_linenumber").alias("line"))
    return op.disagreements(by_rows(rows, n, "benchmark", "model", "metric"))


@query("keyword_absence", with_views(PAPERS) + r""" SELECT lang, count(*) AS n, count(*) FILTER (NOT regexp_matches(lower(abstract), '(^|[^a-z0-9])the([^a-z0-9]|$)')) AS without_word FROM v_papers GROUP BY 1""")
def keyword_absence(spark: SparkSession, d: str) -> DataFrame:
    """AG-37: papers of each language whose text lacks a keyword."""
    has = F.lower("abstract").rlike("(^|[^a-z0-9])the([^a-z0-9]|$)")
    return papers(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.count_if(~has).alias("without_word"))


@query("weighted_majority", with_views(OCCURRENCES, "s AS (SELECT country, type, sum(CASE WHEN lead THEN 3 ELSE 1 END)::BIGINT AS weight FROM v_occ GROUP BY 1, 2)") + " SELECT country, type, weight FROM s QUALIFY row_number() OVER (PARTITION BY country ORDER BY weight DESC, type) = 1")
def weighted_majority(spark: SparkSession, d: str) -> DataFrame:
    """AG-16: each country's type by weighted majority, the lead counting three times."""
    return op.weighted_mode(occurrences(spark, d), ["country"], "type", F.when(F.col("lead"), 3).otherwise(1))


@query("claim_manifest", with_views(CATALOGUE, CELLS) + """
SELECT 'benchmarks_total' AS claim, CAST(count(*) AS VARCHAR) AS value, 'rows of the catalogue' AS recompute FROM v_catalogue
UNION ALL SELECT 'result_cells', CAST(count(*) AS VARCHAR), 'rows of the cells' FROM v_cells
UNION ALL SELECT 'models', CAST(count(DISTINCT model) AS VARCHAR), 'distinct models' FROM v_cells
UNION ALL SELECT 'pre_1996', CAST(count(*) FILTER (date < '1996-01') AS VARCHAR), 'date before 1996-01' FROM v_catalogue""")
def claim_manifest(spark: SparkSession, d: str) -> DataFrame:
    """SNK-08: one row for each claim: its name, its value as text, and how it is recomputed."""
    cat, cell = catalogue(spark, d), cells(spark, d)
    claim = lambda df, name, value, how: df.agg(value.cast("string").alias("value")).select(F.lit(name).alias("claim"), "value", F.lit(how).alias("recompute"))
    return (
        claim(cat, "benchmarks_total", F.count("*"), "rows of the catalogue")
        .unionByName(claim(cell, "result_cells", F.count("*"), "rows of the cells"))
        .unionByName(claim(cell, "models", F.count_distinct("model"), "distinct models"))
        .unionByName(claim(cat, "pre_1996", F.count_if(F.col("date") < "1996-01"), "date before 1996-01"))
    )
