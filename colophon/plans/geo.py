"""Queries over geography and venues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import geo as G
from colophon.operators import geo as op
from colophon.operators import stats
from colophon.operators import venues as V
from colophon.plans.registry import query
from colophon.plans.views import CATALOGUE, OCCURRENCES, catalogue, occurrences, with_views
from colophon.sources.tables import table


@query("geo_institutions", with_views(OCCURRENCES) + " SELECT inst, count(DISTINCT entry) AS entries, count(DISTINCT CASE WHEN lead THEN entry END) AS leads, count(*) AS named FROM v_occ GROUP BY 1")
def geo_institutions(spark: SparkSession, d: str) -> DataFrame:
    return op.institutions(occurrences(spark, d))


@query("geo_countries", with_views(OCCURRENCES) + " SELECT country, count(DISTINCT entry) AS entries, count(DISTINCT CASE WHEN lead THEN entry END) AS leads, count(DISTINCT inst) AS insts FROM v_occ GROUP BY 1")
def geo_countries(spark: SparkSession, d: str) -> DataFrame:
    return op.countries(occurrences(spark, d))


@query("type_split", with_views(OCCURRENCES, "p AS (SELECT entry, bool_or(type = 'academia') AS a, bool_or(type = 'industry') AS i FROM v_occ GROUP BY 1)") + " SELECT CASE WHEN a AND i THEN 'mixed' WHEN a THEN 'academia' WHEN i THEN 'industry' ELSE 'other' END AS split, count(*) AS entries FROM p GROUP BY 1")
def type_split(spark: SparkSession, d: str) -> DataFrame:
    return op.type_split(occurrences(spark, d))


@query("type_rollup", with_views(OCCURRENCES) + " SELECT type, count(DISTINCT entry) AS entries, count(DISTINCT inst) AS insts FROM v_occ GROUP BY 1")
def type_rollup(spark: SparkSession, d: str) -> DataFrame:
    return op.type_rollup(occurrences(spark, d))


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("year_region_pivot", with_views(OCCURRENCES, "y AS (SELECT DISTINCT substr(date, 1, 4) AS year, region, entry FROM v_occ)") + " SELECT year, " + ", ".join(f"count(*) FILTER (region = '{r}') AS {r.lower().replace(' ', '_')}" for r in _REGIONS) + ", count(*) AS total FROM y GROUP BY 1")
def year_region_pivot(spark: SparkSession, d: str) -> DataFrame:
    return op.year_region(occurrences(spark, d), _REGIONS)


@query("year_region_rollup", with_views(OCCURRENCES, "y AS (SELECT DISTINCT substr(date, 1, 4) AS year, region, entry FROM v_occ)") + " SELECT year, region, count(*) AS n FROM y GROUP BY ROLLUP (year, region)")
def year_region_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = occurrences(spark, d).select(F.substring("date", 1, 4).alias("year"), "region", "entry").distinct()
    return rows.rollup("year", "region").agg(F.count("*").alias("n"))


@query("multi_country", with_views(OCCURRENCES, "p AS (SELECT entry, count(DISTINCT inst) AS i, count(DISTINCT country) AS c FROM v_occ GROUP BY 1)") + " SELECT count(*) AS entries, count(*) FILTER (i > 1) AS multi_inst, count(*) FILTER (c > 1) AS multi_country, count(*) FILTER (c > 0) AS with_country FROM p")
def multi_country(spark: SparkSession, d: str) -> DataFrame:
    return op.multi(occurrences(spark, d))


@query("attribution_states", "SELECT CASE WHEN o_orderstatus IS NULL THEN 'not_attributed' WHEN o_orderkey % 11 = 0 THEN 'no_affiliation' WHEN o_orderkey % 5 = 0 THEN 'pending' WHEN o_orderstatus = 'F' THEN 'attributed' ELSE 'partial' END AS state, count(*) AS n FROM orders GROUP BY 1")
def attribution_states(spark: SparkSession, d: str) -> DataFrame:
    """AG-24, FN-28."""
    k = F.col("o_orderkey")
    state = G.bench_state(F.when(k % 11 == 0, "no_affiliation").otherwise("ok"), k % 5 != 0, F.col("o_orderstatus") == "F", F.col("o_orderstatus").isNotNull())
    return table(spark, d, "orders").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


_POINTS = "pts AS (SELECT s_suppkey AS id, s_nationkey AS country, (s_suppkey * 37 % 3600) / 10.0 - 180 AS lon, (s_suppkey * 53 % 1700) / 10.0 - 85 AS lat FROM supplier)"


def _points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("id"), F.col("s_nationkey").alias("country"), (k * 37 % 3600 / 10.0 - 180).alias("lon"), (k * 53 % 1700 / 10.0 - 85).alias("lat"))


@query("bbox_check", f"WITH {_POINTS}, b AS (SELECT country, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM pts WHERE id % 2 = 0 GROUP BY 1) SELECT id, pts.country, lon::DOUBLE AS lon, lat::DOUBLE AS lat FROM pts JOIN b ON b.country = pts.country WHERE NOT (lat BETWEEN s - 1 AND n + 1 AND (pts.country = 7 OR lon BETWEEN w - 1 AND e + 1))")
def bbox_check(spark: SparkSession, d: str) -> DataFrame:
    """JN-18, AG-36: points outside their country's box by more than a degree."""
    pts = _points(spark, d)
    return op.outside_box(pts, op.boxes(pts.where("id % 2 = 0"), "country"), "country", 1.0, F.col("country") == 7).select("id", "country", "lon", "lat")


@query("haversine", f"WITH {_POINTS} SELECT id, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(48.85 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.85)) * pow(sin(radians(2.35 - lon) / 2), 2))), 4) AS km FROM pts")
def haversine(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d).select("id", F.round(G.haversine(F.col("lat"), F.col("lon"), F.lit(48.85), F.lit(2.35)), 4).alias("km"))


@query("coordinate_report", f"WITH {_POINTS}, k AS (SELECT *, 2 * 6371.0 * asin(sqrt(pow(sin(radians(48.85 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.85)) * pow(sin(radians(2.35 - lon) / 2), 2))) AS km FROM pts) SELECT CASE WHEN id % 9 = 0 THEN 'no_city' WHEN id % 10 = 0 THEN 'not_geocoded' WHEN km > 5000 THEN 'far' ELSE 'ok' END AS bucket, count(*) AS n FROM k GROUP BY 1")
def coordinate_report(spark: SparkSession, d: str) -> DataFrame:
    """AG-33."""
    km = G.haversine(F.col("lat"), F.col("lon"), F.lit(48.85), F.lit(2.35))
    bucket = F.when(F.col("id") % 9 == 0, "no_city").when(F.col("id") % 10 == 0, "not_geocoded").when(km > 5000, "far").otherwise("ok")
    return _points(spark, d).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("map_projection", f"WITH {_POINTS} SELECT id, floor((lon + 180) / 360 * 1000.0::DOUBLE * 10 + 0.5) / 10 AS x FROM pts")
def map_projection(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d).select("id", G.project(F.col("lon"), F.col("lat"))[0].alias("x"))


@query("both_roles", "SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 9000")
def both_roles(spark: SparkSession, d: str) -> DataFrame:
    """SE-05."""
    rich = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).intersect(rich)


@query("missing_and_stray", "SELECT 'missing' AS side, count(*) AS n FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'stray', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O')")
def missing_and_stray(spark: SparkSession, d: str) -> DataFrame:
    """SE-04, JN-23: ids of one side that the other lacks, both ways."""
    cust, orders, line = table(spark, d, "customer"), table(spark, d, "orders"), table(spark, d, "lineitem")
    missing = cust.join(orders, cust["c_custkey"] == orders["o_custkey"], "left_anti").agg(F.count_distinct("c_custkey").alias("n"))
    stray = line.join(orders.where("o_orderstatus <> 'O'"), line["l_orderkey"] == orders["o_orderkey"], "left_anti").agg(F.count_distinct("l_orderkey").alias("n"))
    return missing.select(F.lit("missing").alias("side"), "n").unionByName(stray.select(F.lit("stray").alias("side"), "n"))


_STATE = "CASE WHEN publishable THEN status ELSE 'unchecked' END"


@query("venue_states", with_views(CATALOGUE) + f" SELECT {_STATE} AS state, count(*) AS n FROM v_catalogue GROUP BY 1")
def venue_states(spark: SparkSession, d: str) -> DataFrame:
    return catalogue(spark, d).groupBy(V.state(F.col("status"), F.col("publishable")).alias("state")).agg(F.count("*").alias("n"))


@query("venue_rank", with_views(CATALOGUE, "y AS (SELECT kind AS venue, substr(date, 1, 4) AS year, count(*) AS n, count(*) FILTER (status = 'published') AS p, count(*) FILTER (status = 'accepted') AS a FROM v_catalogue WHERE publishable GROUP BY 1, 2)") + " SELECT venue, sum(p)::BIGINT AS published, sum(a)::BIGINT AS accepted, sum(n)::BIGINT AS total, string_agg(year || ':' || n, ',' ORDER BY year) AS years FROM y GROUP BY 1")
def venue_rank(spark: SparkSession, d: str) -> DataFrame:
    return V.ranking(catalogue(spark, d).where("publishable").withColumnRenamed("kind", "venue"))


@query("community_rollup", with_views(CATALOGUE, "v AS (SELECT CASE WHEN kind LIKE '1-%' OR kind LIKE '2-%' THEN 'ml' WHEN kind LIKE '3-%' THEN 'speech' ELSE 'other' END AS community, kind, count(*) AS n FROM v_catalogue GROUP BY 1, 2)") + " SELECT community, count(*) AS venues, sum(n)::BIGINT AS entries FROM v GROUP BY 1")
def community_rollup(spark: SparkSession, d: str) -> DataFrame:
    """AG-27: venues first, then their communities."""
    per = catalogue(spark, d).groupBy("kind").agg(F.count("*").alias("n"))
    community = F.when(F.col("kind").rlike("^[12]-"), "ml").when(F.col("kind").rlike("^3-"), "speech").otherwise("other")
    return per.groupBy(community.alias("community")).agg(F.count("*").alias("venues"), F.sum("n").alias("entries"))


@query("status_by_year", with_views(CATALOGUE, f"s AS (SELECT substr(date, 1, 4) AS row, {_STATE} AS st FROM v_catalogue)") + " SELECT row, count(*) FILTER (st = 'published') AS published, count(*) FILTER (st = 'accepted') AS accepted, count(*) FILTER (st = 'preprint') AS preprint, count(*) FILTER (st = 'unchecked') AS unchecked, count(*) AS total FROM s GROUP BY 1")
def status_by_year(spark: SparkSession, d: str) -> DataFrame:
    rows = catalogue(spark, d).withColumn("st", V.state(F.col("status"), F.col("publishable")))
    return V.crosstab(rows, F.substring("date", 1, 4), "st", ["published", "accepted", "preprint", "unchecked"])


_LAG = "g AS (SELECT l_shipmode_free AS kind, lag FROM (SELECT l_returnflag AS l_shipmode_free, abs(date_diff('day', o_orderdate::DATE, l_shipdate::DATE)) // 30 AS lag FROM lineitem JOIN orders ON o_orderkey = l_orderkey))"


def _lags(spark: SparkSession, d: str) -> DataFrame:
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    rows = line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
    return rows.select(F.col("l_returnflag").alias("kind"), F.floor(F.abs(F.datediff("l_shipdate", "o_orderdate")) / 30).alias("lag"))


@query("lag_histogram", f"WITH {_LAG} SELECT lag, count(*) AS n FROM g GROUP BY 1")
def lag_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _lags(spark, d).groupBy("lag").agg(F.count("*").alias("n"))


@query("lag_upper_median", f"WITH {_LAG}, l AS (SELECT kind, list(lag ORDER BY lag) AS x FROM g GROUP BY 1) SELECT kind, x[len(x) // 2 + 1] AS median_lag FROM l")
def lag_upper_median(spark: SparkSession, d: str) -> DataFrame:
    """AG-29: the upper median, from the counts of each lag (few values), so that no group is collected row by row."""
    counts = _lags(spark, d).groupBy("kind", "lag").agg(F.count("*").alias("n"))
    sorted_counts = F.array_sort(F.collect_list(F.struct("lag", "n")))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("m"))
    half = F.floor(F.sum("n") / 2)
    agg = counts.groupBy("kind").agg(sorted_counts.alias("c"), half.alias("half"))
    fold = F.aggregate("c", start, lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.coalesce(a["m"], F.when(a["seen"] + x["n"] > F.col("half"), x["lag"])).alias("m")))
    return agg.select("kind", fold["m"].alias("median_lag"))


@query("evidence_provenance", "SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'anthology' WHEN o_orderpriority LIKE '2%' THEN 'crossref' ELSE 'other' END AS evidence, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1")
def evidence_provenance(spark: SparkSession, d: str) -> DataFrame:
    """AG-30, FN-24: where the evidence comes from, by an ordered rule table."""
    from colophon.functions.rules import first_rule

    bucket = F.coalesce(first_rule([("^1", "anthology"), ("^2", "crossref")], F.col("o_orderpriority")), F.lit("other"))
    return table(spark, d, "orders").where("o_orderstatus <> 'O'").groupBy(bucket.alias("evidence")).agg(F.count("*").alias("n"))


_CLAIMS = """claims AS (
 SELECT c_custkey AS id, 0 AS place, 'anthology' AS source, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END AS venue, '2024' AS year FROM customer WHERE c_custkey % 2 = 0
 UNION ALL SELECT c_custkey, 1, 'crossref', c_mktsegment, '2023' FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT c_custkey, 2, 'comment', 'BUILDING', '2022' FROM customer WHERE c_custkey % 5 = 0)"""


def _claims(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    return [
        ("anthology", c.where("id % 2 = 0").select("id", F.when(F.col("id") % 4 == 0, F.col("c_mktsegment")).alias("venue"), F.lit("2024").alias("year"))),
        ("crossref", c.where("id % 3 = 0").select("id", F.col("c_mktsegment").alias("venue"), F.lit("2023").alias("year"))),
        ("comment", c.where("id % 5 = 0").select("id", F.lit("BUILDING").alias("venue"), F.lit("2022").alias("year"))),
    ]


@query("evidence_cascade", f"WITH {_CLAIMS}, b AS (SELECT * FROM claims WHERE venue IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) = 1) SELECT c_custkey AS id, coalesce(source, 'preprint') AS source, venue, year FROM customer LEFT JOIN b ON b.id = c_custkey")
def evidence_cascade(spark: SparkSession, d: str) -> DataFrame:
    return V.cascade(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), _claims(spark, d))


@query("source_agreement", f"WITH {_CLAIMS}, b AS (SELECT * FROM claims WHERE venue IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) = 1) SELECT c.id, count(*) FILTER (c.venue = b.venue) AS agree, count(*) FILTER (c.venue <> b.venue) AS disagree FROM claims c JOIN b ON b.id = c.id AND c.source <> b.source WHERE c.venue IS NOT NULL GROUP BY 1")
def source_agreement(spark: SparkSession, d: str) -> DataFrame:
    sources = _claims(spark, d)
    used = V.cascade(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), sources)
    rows = None
    for name, df in sources:
        part = df.withColumn("source", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return V.agreement(rows, used.where("venue is not null"))


@query("site_majority", "WITH s AS (SELECT c_nationkey AS country, c_mktsegment AS type, count(*) AS weight FROM customer GROUP BY 1, 2) SELECT country, type, weight FROM s QUALIFY row_number() OVER (PARTITION BY country ORDER BY weight DESC, type) = 1")
def site_majority(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("type"))
    return stats.weighted_mode(rows, ["country"], "type", F.lit(1))
