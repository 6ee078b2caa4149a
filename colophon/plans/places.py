"""Queries over places: sites of institutions, countries of entries and models, outlines over the antimeridian, affiliation gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import geo as G
from colophon.operators import gates
from colophon.operators import geo as op
from colophon.plans.registry import query
from colophon.sources.tables import table

# Occurrences are lines of orders (entries) and, for models, of parts; a line's supplier is the institution. One line of eleven
# names an institution that isn't known; one of five is unplaced, one of five has coordinates, and half of these are named.
_OCC = """i AS (SELECT s_suppkey AS id, s_name AS name, chr((65 + s_suppkey % 7)::INT) || 'A' AS home, s_suppkey % 4 = 0 AS no_site, 'Town ' || (s_suppkey % 5) AS city, (s_suppkey % 60)::DOUBLE AS lat, (s_suppkey % 90)::DOUBLE AS lon FROM supplier),
 l AS (SELECT *, l_orderkey * 100 + l_linenumber AS u FROM lineitem),
 o AS (SELECT 'bench' AS kind, l_orderkey AS key, CASE WHEN l_partkey % 11 = 0 THEN -1 - l_suppkey ELSE l_suppkey END AS inst, l_linenumber = 1 AS lead, u % 5 = 0 AS unplaced, u % 5 = 1 AS own, u % 10 = 1 AS named, 'City ' || (l_partkey % 3) AS city, (l_partkey % 50)::DOUBLE AS lat, (l_partkey % 70)::DOUBLE AS lon,
   CASE WHEN l_partkey % 4 = 0 THEN 'Z' || chr((65 + l_partkey % 5)::INT) END AS country, CASE l_partkey % 6 WHEN 1 THEN ['XA', 'XB'] WHEN 2 THEN ['XC'] END AS countries FROM l
  UNION ALL SELECT 'model', l_partkey, l_suppkey, l_linenumber = 2, u % 5 = 0, u % 5 = 1, u % 10 = 1, 'City ' || (l_partkey % 3), (l_partkey % 50)::DOUBLE, (l_partkey % 70)::DOUBLE, CASE WHEN l_partkey % 4 = 0 THEN 'Z' || chr((65 + l_partkey % 5)::INT) END, NULL FROM l WHERE l_returnflag = 'R'),
 r AS (SELECT o.*, i.id, i.name, i.home, i.no_site, i.city AS icity, i.lat AS ilat, i.lon AS ilon FROM o JOIN i ON i.id = o.inst)"""


def _letter(n: Column) -> Column:
    return F.char(65 + n)


def _institutions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    site = F.struct(F.concat(F.lit("Town "), (k % 5).cast("string")).alias("city"), (k % 60).cast("double").alias("lat"), (k % 90).cast("double").alias("lon"))
    return table(spark, d, "supplier").select(k.alias("id"), F.col("s_name").alias("name"), F.concat(_letter(k % 7), F.lit("A")).alias("country"), F.when(k % 4 != 0, site).alias("site"))


def _occurrences(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").withColumn("u", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    p, u = F.col("l_partkey"), F.col("u")
    placed = F.when(u % 5 == 0, "unplaced").when(u % 10 == 1, "named")
    own = lambda x: F.when(u % 5 == 1, x)
    cols = [placed.alias("placed"), F.concat(F.lit("City "), (p % 3).cast("string")).alias("city"), own((p % 50).cast("double")).alias("lat"), own((p % 70).cast("double")).alias("lon"), F.when(p % 4 == 0, F.concat(F.lit("Z"), _letter(p % 5))).alias("country")]
    lists = F.when(p % 6 == 1, F.array(F.lit("XA"), F.lit("XB"))).when(p % 6 == 2, F.array(F.lit("XC")))
    inst = F.when(p % 11 == 0, -1 - F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
    bench = line.select(F.lit("bench").alias("kind"), F.col("l_orderkey").alias("key"), inst.alias("inst"), (F.col("l_linenumber") == 1).alias("lead"), *cols, lists.alias("countries"))
    model = line.where("l_returnflag = 'R'").select(F.lit("model").alias("kind"), p.alias("key"), F.col("l_suppkey").alias("inst"), (F.col("l_linenumber") == 2).alias("lead"), *cols, F.lit(None).cast("array<string>").alias("countries"))
    return bench.unionByName(model)


_AT = "CASE WHEN unplaced THEN NULL WHEN own THEN city || '@' || lat || ',' || lon WHEN NOT no_site THEN icity || '@' || ilat || ',' || ilon END"


@query("site_rows", f"""WITH {_OCC}, a AS (SELECT *, {_AT} AS place FROM r),
 s AS (SELECT inst, place || ':' || count(DISTINCT key) FILTER (kind = 'bench') || '/' || count(DISTINCT key) FILTER (kind = 'bench' AND lead) || '/' || count(DISTINCT key) FILTER (kind = 'model') || '/' || count(*) FILTER (own AND named) || '/' || count(*) FILTER (NOT (own AND named)) AS t FROM a WHERE place IS NOT NULL GROUP BY inst, place),
 n AS (SELECT inst, string_agg(t, ' ' ORDER BY t) AS sites FROM s GROUP BY 1),
 t AS (SELECT inst, any_value(name) AS name, count(DISTINCT key) FILTER (kind = 'bench') AS bench_all, count(DISTINCT key) FILTER (kind = 'bench' AND lead) AS bench_lead, count(DISTINCT key) FILTER (kind = 'model') AS models_all, count(DISTINCT key) FILTER (kind = 'model' AND lead) AS models_lead FROM a GROUP BY 1)
 SELECT t.*, coalesce(sites, '') AS sites FROM t LEFT JOIN n USING (inst)""")
def site_rows(spark: SparkSession, d: str) -> DataFrame:
    """AG-18: institutions with models and the counters of their places."""
    rows = op.site_rows(_occurrences(spark, d), _institutions(spark, d))
    text = lambda s: F.concat(s["city"], F.lit("@"), s["lat"].cast("string"), F.lit(","), s["lon"].cast("string"), F.lit(":"), F.concat_ws("/", *[s[c].cast("string") for c in ("bench_all", "bench_lead", "models_all", "named", "defaulted")]))
    return rows.withColumn("sites", F.array_join(F.array_sort(F.transform("sites", text)), " "))


@query("country_rows", f"""WITH {_OCC}, c AS (SELECT kind, key, inst, unnest(CASE WHEN kind = 'bench' AND countries IS NOT NULL THEN countries ELSE [coalesce(country, home)] END) AS country FROM r),
 d AS (SELECT key, CASE WHEN countries IS NOT NULL THEN CASE WHEN len(countries) = 1 THEN countries[1] END ELSE coalesce(country, home) END AS country FROM r WHERE kind = 'bench' AND lead),
 b AS (SELECT country, count(DISTINCT key) FILTER (kind = 'bench') AS bench_all, count(DISTINCT key) FILTER (kind = 'model') AS models, count(DISTINCT inst) AS institutions FROM c GROUP BY 1), e AS (SELECT country, count(DISTINCT key) AS n FROM d WHERE country IS NOT NULL GROUP BY 1)
 SELECT coalesce(b.country, e.country) AS country, coalesce(bench_all, 0) AS bench_all, coalesce(n, 0) AS bench_lead, coalesce(models, 0) AS models, coalesce(institutions, 0) AS institutions FROM b FULL JOIN e ON e.country = b.country""")
def country_rows(spark: SparkSession, d: str) -> DataFrame:
    """AG-19: countries with entries, leads, models and institutions."""
    return op.country_rows(_occurrences(spark, d), _institutions(spark, d))


@query("model_dispositions", "SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'no_record' WHEN o_orderstatus = 'P' THEN 'composite' WHEN o_orderstatus = 'O' AND o_custkey % 3 > 0 THEN 'incomplete' WHEN o_orderstatus = 'O' THEN 'unknown' ELSE 'attributed' END AS state, count(*) AS n FROM orders GROUP BY 1")
def model_dispositions(spark: SparkSession, d: str) -> DataFrame:
    """AG-24."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = table(spark, d, "orders").select(k.alias("id"), F.when(s == "P", "composite").otherwise("ok").alias("status"), (s == "F").alias("publishable"), F.when(F.col("o_custkey") % 3 > 0, F.array("o_custkey")).alias("builders"), (k % 9 != 0).alias("present"))
    return op.model_dispositions(rows)


_RINGS = """p AS (SELECT c_custkey // 5 AS ring, c_custkey % 5 AS pos, (c_custkey * 7919 % 3600) / 10.0::DOUBLE - 180 AS lon, (c_custkey * 31 % 1500) / 10.0::DOUBLE - 62 AS lat FROM customer),
 s AS (SELECT *, lon - lag(lon) OVER (PARTITION BY ring ORDER BY pos) AS step FROM p),
 u AS (SELECT *, lon + sum(CASE WHEN step > 180 THEN -360 WHEN step < -180 THEN 360 ELSE 0 END) OVER (PARTITION BY ring ORDER BY pos) AS x FROM s),
 g AS (SELECT ring, max(abs(step)) > 180 AS crossed, min(x) AS lo, max(x) AS hi FROM u GROUP BY 1),
 k AS (SELECT * FROM g, (SELECT unnest([0, -1, 1]) AS copy) WHERE CASE WHEN crossed THEN hi + copy * 360 > -180 AND lo + copy * 360 < 180 ELSE copy = 0 END),
 t AS (SELECT u.ring, copy, pos, floor((x + copy * 360 + 180) / 360 * 1000.0::DOUBLE * 10 + 0.5) / 10 AS px, floor((84.0::DOUBLE - least(greatest(lat, -57.0::DOUBLE), 84.0::DOUBLE)) / 141.0::DOUBLE * (1000.0::DOUBLE * 141.0::DOUBLE / 360.0::DOUBLE) * 10 + 0.5) / 10 AS py FROM k JOIN u ON u.ring = k.ring)"""


@query("map_rings", f"WITH {_RINGS} SELECT ring, copy, 'M' || string_agg(px || ',' || py, 'L' ORDER BY pos) || 'Z' AS path FROM t GROUP BY 1, 2")
def map_rings(spark: SparkSession, d: str) -> DataFrame:
    """PR-07, FN-40, FN-41: outlines of five points, the latitude clamped, those that cross the antimeridian shown twice."""
    k = F.col("c_custkey")
    points = table(spark, d, "customer").select(F.floor(k / 5).alias("ring"), (k % 5).alias("pos"), (k * 7919 % 3600 / 10.0 - 180).alias("lon"), (k * 31 % 1500 / 10.0 - 62).alias("lat"))
    return G.map_rings(points)


_AFF = """a AS (SELECT o_orderkey AS id, o_orderkey % 8 AS k, o_custkey AS c, CASE WHEN o_orderkey % 8 <> 7 THEN o_orderstatus = 'F' END AS publishable FROM orders)"""


@query("affiliation_gates", f"""WITH {_AFF}, v AS (
  SELECT 'affiliations: unknown entry' AS gate FROM a WHERE id NOT IN (SELECT event_id FROM events)
  UNION ALL SELECT 'affiliations: no publishable flag' FROM a WHERE k = 7 UNION ALL SELECT 'affiliations: no countries_complete flag' FROM a WHERE k = 6
  UNION ALL SELECT 'affiliations: several leads' FROM a WHERE k = 1 UNION ALL SELECT 'affiliations: publishable without institutions' FROM a WHERE k = 0 AND publishable
  UNION ALL SELECT 'affiliations: publishable, not verified' FROM a WHERE c % 3 = 0 AND publishable UNION ALL SELECT 'affiliations: publishable without text' FROM a WHERE k = 2 AND publishable
  UNION ALL SELECT 'affiliations: corrected without a reason' FROM a WHERE c % 3 = 1 AND c % 2 = 0 AND publishable
  UNION ALL SELECT 'affiliations: unknown institution' FROM a, (SELECT unnest([0, 1]) AS j) WHERE k <> 0 AND c + j NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT 'affiliations: country code' FROM a, (SELECT unnest([0, 1]) AS j) WHERE k = 3 UNION ALL SELECT 'affiliations: countries' FROM a, (SELECT unnest([0, 1]) AS j) WHERE k = 4
  UNION ALL SELECT 'affiliations: unplaced with coordinates' FROM a, (SELECT unnest([0, 1]) AS j) WHERE k = 5 UNION ALL SELECT 'affiliations: half a coordinate' FROM a, (SELECT unnest([0, 1]) AS j) WHERE k = 6
  UNION ALL SELECT 'affiliations: range' FROM a, (SELECT unnest([0, 1]) AS j) WHERE k IN (2, 5) AND c % 2 = 0)
 SELECT gate, count(*) AS n FROM v GROUP BY 1""")
def affiliation_gates(spark: SparkSession, d: str) -> DataFrame:
    """GT-03: publishable invariants, unknown institutions, countries and coordinates."""
    k, c, no = F.col("o_orderkey") % 8, F.col("o_custkey"), F.lit(None)
    there = k.isin(2, 5)
    far = F.when(c % 2 == 0, 95.0).otherwise(45.0)
    one = lambda j: F.struct(
        (c + j).alias("inst"), ((k == 1) | F.lit(j == 0)).alias("lead"), F.when(k == 3, "Deutschland").when(k != 4, "DE").alias("country"), F.when(k == 4, F.array(F.lit("DE"), F.lit("fr"))).alias("countries"),
        F.when(k == 5, "unplaced").otherwise("default").alias("placed"), F.when(there, far).when(k == 6, 1.0).alias("lat"), F.when(there, 7.0).alias("lon"),
    )
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(k != 7, F.col("o_orderstatus") == "F").alias("publishable"), F.when(k != 6, F.lit(True)).alias("countries_complete"), F.when(c % 3 == 0, "cannot_verify").when(c % 3 == 1, "corrected").otherwise("confirmed").alias("verified"),
        F.when(c % 2 == 1, "quoted").otherwise(no).alias("verify_note"), F.when(k == 2, "no_affiliation_text").otherwise("ok").alias("status"), F.when(k != 0, F.array(one(0), one(1))).alias("institutions"),
    )
    entries = table(spark, d, "events").select(F.col("event_id").alias("id"))
    institutions = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))
    return gates.union(gates.affiliation_gates(rows, entries, institutions)).groupBy("gate").agg(F.count("*").alias("n"))
