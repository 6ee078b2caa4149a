"""Queries over aliases, gates, corrections and presentation contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import aliases as A
from colophon.operators import canon, corrections, gates, present
from colophon.plans.registry import query
from colophon.plans.views import CELLS, LINE_ORDER, ORDER_SQL, cells, with_views
from colophon.sources.tables import table


@query("fingerprint", """SELECT o_orderkey AS id, sha256('["' || o_orderstatus || '","' || o_custkey || '","' || o_orderpriority || '",["number","' || o_orderkey || '"],"src",' || CASE WHEN o_orderkey % 2 = 0 THEN '"https://x.org/' || o_orderkey || '"' ELSE 'null' END || ',null]') AS fp FROM orders""")
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    url = F.when(k % 2 == 0, F.concat(F.lit("https://x.org/"), k.cast("string")))
    fp = A.fingerprint(F.col("o_orderstatus"), F.col("o_custkey"), F.col("o_orderpriority"), F.lit("number"), A.number_text(k.cast("double")), F.lit("src"), url, F.lit(None).cast("string"))
    return table(spark, d, "orders").select(k.alias("id"), fp.alias("fp"))


_MEMBERS = "mem AS (SELECT DISTINCT p_brand AS g, l_returnflag || l_linestatus AS member, l_shipdate::DATE::VARCHAR AS model, max(l_quantity) AS value FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3)"


@query("alias_connectivity", f"""WITH RECURSIVE {_MEMBERS}, e AS (SELECT a.g, a.member AS a, b.member AS b FROM mem a JOIN mem b ON a.g = b.g AND a.model = b.model AND a.value = b.value AND a.member < b.member GROUP BY 1, 2, 3 HAVING count(DISTINCT a.model) >= 3 AND count(DISTINCT a.value) FILTER (a.value NOT IN (0, 1, 100)) >= 3),
 two AS (SELECT g, a, b FROM e UNION SELECT g, b, a FROM e), w AS (SELECT g, min(member) AS m FROM mem GROUP BY 1 UNION SELECT w.g, two.b FROM w JOIN two ON two.g = w.g AND two.a = w.m)
 SELECT g AS grp, (SELECT count(DISTINCT member) FROM mem WHERE mem.g = w.g) AS n_members, count(DISTINCT m) AS n_reached FROM w GROUP BY 1""")
def alias_connectivity(spark: SparkSession, d: str) -> DataFrame:
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    rows = line.join(part, line["l_partkey"] == part["p_partkey"]).groupBy(F.col("p_brand").alias("group"), F.concat("l_returnflag", "l_linestatus").alias("member"), F.to_date("l_shipdate").cast("string").alias("model")).agg(F.max("l_quantity").alias("value"))
    return A.connectivity(rows.withColumn("paper", F.col("member")).withColumn("metric", F.col("member"))).select(F.col("group").alias("grp"), "n_members", "n_reached")


@query("metric_options", with_views(CELLS, "k AS (SELECT *, CASE WHEN metric IN ('A/F', 'R/F') AND source % 2 = 0 THEN 'alias:old' ELSE 'raw:' || metric END AS key FROM v_cells)", "i AS (SELECT benchmark, key, model, count(*) AS n FROM k GROUP BY 1, 2, 3)") + " SELECT i.benchmark, any_value(b.before) AS before, count(DISTINCT key) AS after, count(*) FILTER (n > 1) AS multi FROM i JOIN (SELECT benchmark, count(DISTINCT metric) AS before FROM v_cells GROUP BY 1) b USING (benchmark) GROUP BY 1")
def metric_options(spark: SparkSession, d: str) -> DataFrame:
    rows = cells(spark, d).select("benchmark", "model", "metric", F.xxhash64(*LINE_ORDER).alias("fp"), F.col("l_orderkey").alias("ord"), "source")
    assigned = rows.where(F.col("metric").isin("A/F", "R/F") & (F.col("source") % 2 == 0)).select("fp", F.lit("old").alias("group"))
    return A.option_counts(rows, assigned)


@query("metric_index", with_views(CELLS) + " SELECT benchmark, 'raw:' || metric AS key, model, array_to_string(list(source ORDER BY source), ',') AS cells FROM v_cells GROUP BY 1, 2, 3")
def metric_index(spark: SparkSession, d: str) -> DataFrame:
    rows = cells(spark, d).select("benchmark", "model", "metric", F.xxhash64(*LINE_ORDER).alias("fp"), F.col("source").alias("ord"))
    index = A.metric_index(rows, rows.limit(0).select("fp", F.lit("x").alias("group")))
    return index.withColumn("cells", F.array_join(F.col("cells").cast("array<string>"), ","))


@query("gate_cells", "SELECT CASE WHEN o_orderkey IS NULL THEN 'unknown benchmark' WHEN s_suppkey IS NULL THEN 'unknown model' WHEN l_quantity = 50 THEN 'empty value' ELSE 'missing metric' END AS reason, count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey WHERE o_orderkey IS NULL OR s_suppkey IS NULL OR l_quantity = 50 OR l_returnflag = 'R' GROUP BY 1")
def gate_cells(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("benchmark"), F.col("l_suppkey").alias("model"), F.when(F.col("l_quantity") < 50, F.col("l_quantity")).alias("value"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("metric"), F.lit("s").alias("source"))
    known = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    models = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("id"))
    return gates.cell_reasons(rows, known, models).groupBy("reason").agg(F.count("*").alias("n"))


@query("gate_registry", "SELECT 'part: duplicate id' AS gate, p_brand AS id FROM part GROUP BY 2 HAVING count(*) > 70 UNION ALL SELECT 'part: id form', p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[1-4]') UNION ALL SELECT 'part: missing p_name', p_brand FROM part WHERE p_name = ''")
def gate_registry(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_brand").alias("id"), "p_name")
    dup = gates.violation(p.groupBy("id").count(), "part: duplicate id", F.col("count") > 70)
    rest = [x for x in gates.registry_gates(p, "part", ["p_name"], id_pattern="^Brand#[1-4]")]
    return gates.union([dup, rest[0], rest[2]]).select("gate", "id")


@query("gate_venues", "SELECT 'venue: preprint with venue' AS gate, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 = 0 UNION ALL SELECT 'venue: claimed without venue or display', count(*) FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey % 3 <> 0")
def gate_venues(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    v = table(spark, d, "orders").select(k.alias("id"), F.when(s == "F", "published").when(s == "P", "accepted").otherwise("preprint").alias("status"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("venue"), F.lit("x").alias("display"), F.lit("https://x.org").alias("evidence_url"), F.lit("2024").alias("year"), F.lit(True).alias("publishable"))
    return gates.union(gates.venue_gates(v)).groupBy("gate").agg(F.count("*").alias("n"))


@query("corrections", "SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 AND c_mktsegment = 'BUILDING' THEN 'HOUSES' ELSE c_mktsegment END AS segment FROM customer WHERE NOT (c_custkey % 7 = 0 AND c_mktsegment = 'MACHINERY' AND c_custkey % 5 <> 0) UNION ALL SELECT 1000000000 + n_nationkey, 'NEW' FROM nation")
def corrections_query(spark: SparkSession, d: str) -> DataFrame:
    """UP-01: replaced, deleted and inserted records."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("s"))
    one = lambda x: F.create_map(F.lit("segment"), x)
    none = F.lit(None).cast("map<string,string>")
    records = c.select("id", one(F.col("s")).alias("fields"))
    change = c.where("id % 5 = 0 and s = 'BUILDING'").select(F.lit(1).cast("long").alias("ord"), "id", one(F.lit("BUILDING")).alias("before"), one(F.lit("HOUSES")).alias("after"))
    delete = c.where("id % 7 = 0 and s = 'MACHINERY' and id % 5 <> 0").select(F.lit(2).cast("long").alias("ord"), "id", one(F.lit("MACHINERY")).alias("before"), none.alias("after"))
    insert = table(spark, d, "nation").select(F.lit(3).cast("long").alias("ord"), (F.col("n_nationkey") + F.lit(1000000000)).cast("long").alias("id"), none.alias("before"), one(F.lit("NEW")).alias("after"))
    return corrections.fold(records, change.unionByName(delete).unionByName(insert)).where("fields is not null").select("id", F.col("fields")["segment"].alias("segment"))


@query("best_metric_column", with_views(CELLS, "p AS (SELECT benchmark, metric, count(DISTINCT model) AS models FROM v_cells GROUP BY 1, 2)") + " SELECT benchmark, metric, models, count(*) OVER (PARTITION BY benchmark) - 1 AS others FROM p QUALIFY row_number() OVER (PARTITION BY benchmark ORDER BY (metric LIKE '%O') DESC, models DESC, metric) = 1")
def best_metric_column(spark: SparkSession, d: str) -> DataFrame:
    return present.best_metric(cells(spark, d), F.col("metric").endswith("O"))


_BRANDS = [f"Brand#1{k}" for k in range(1, 6)]
_KEPT = f"f AS (SELECT *, row_number() OVER (PARTITION BY benchmark, model, metric ORDER BY own DESC, {ORDER_SQL}) AS rn FROM v_cells)"


@query("matrix_pivot", with_views(CELLS, _KEPT, "w AS (SELECT model, " + ", ".join(f"max(CASE WHEN benchmark = '{b}' THEN value END) AS {b.lower().replace('#', '_')}" for b in _BRANDS) + " FROM f WHERE rn = 1 AND metric = 'A/F' GROUP BY 1)") + " SELECT *, " + " + ".join(f"({b.lower().replace('#', '_')} IS NOT NULL)::INT" for b in _BRANDS) + " AS covered FROM w")
def matrix_pivot(spark: SparkSession, d: str) -> DataFrame:
    kept = canon.dedup_authority(cells(spark, d), LINE_ORDER).where("metric = 'A/F'")
    return present.matrix(kept, _BRANDS)
