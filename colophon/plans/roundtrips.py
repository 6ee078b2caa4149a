"""Queries that write with a sink and read with a source, parse harvested text, and run gates and streams that no other query reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import affiliations, aliases, corrections, gates
from colophon.plans.registry import query
from colophon.sources import json_sources, parsers, sinks
from colophon.sources.tables import scratch, table
from colophon.streaming import crawl, state


@query("json_document", "SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS _ord, n_nationkey AS id, n_name AS name FROM nation")
def json_document(spark: SparkSession, d: str) -> DataFrame:
    """SNK-01, SRC-01, SRC-02, FN-53: the registry as one document, read back; of a missing file there are no rows."""
    path, entry = scratch(spark, "document"), F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    one = table(spark, d, "nation").agg(F.array_sort(F.collect_list(entry)).alias("entries"))  # a registry of 25 rows
    one.coalesce(1).write.json(f"{path}/registry")
    found = json_sources.document(spark, f"{path}/registry", "id INT, name STRING")
    return found.unionByName(json_sources.optional(spark, f"{path}/none.json", "id INT, name STRING"))


@query("json_lines", "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey % 10 <> 0")
def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """SNK-02, SNK-03, SRC-03: sorted lines and appended bad ones; bad lines and those without an id are skipped."""
    path, part = scratch(spark, "lines"), table(spark, d, "part")
    rows = part.select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")).alias("id"), F.col("p_name").alias("name"))
    sinks.json_lines(rows, path, ["id"])
    part.where("p_partkey % 10 = 0").select(F.lit("{not json").alias("value")).write.mode("append").text(path)
    return json_sources.lines(spark, path, "id BIGINT, name STRING")


@query("json_lines_strict", "SELECT count(*) AS n, sum(o_custkey) AS total FROM orders")
def json_lines_strict(spark: SparkSession, d: str) -> DataFrame:
    """SRC-04: every line must parse."""
    path = scratch(spark, "strict")
    sinks.append_lines(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey"), path)
    return json_sources.lines(spark, path, "id BIGINT, o_custkey BIGINT", strict=True).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("total"))


@query("json_folder", "SELECT CASE WHEN p_size % 50 = 0 THEN 'x' ELSE 'k' || p_size END AS id, count(*) AS n FROM part GROUP BY 1")
def json_folder(spark: SparkSession, d: str) -> DataFrame:
    """SRC-05, SRC-06: one file for each size, an array, a record or {records: []}; each key's last record stays."""
    path = scratch(spark, "folder")
    size = F.col("p_size")
    record = F.struct(F.when(size % 50 == 0, "x").otherwise(F.concat(F.lit("k"), size.cast("string"))).alias("id"), F.col("n"))
    per = table(spark, d, "part").groupBy("p_size").agg(F.count("*").alias("n")).withColumn("r", record)
    text = F.when(size % 3 == 0, F.to_json("r")).when(size % 3 == 1, F.to_json(F.array("r"))).otherwise(F.to_json(F.struct(F.array("r").alias("records"))))
    per.select("p_size", text.alias("value")).repartition("p_size").write.partitionBy("p_size").text(path)
    return json_sources.folder(spark, path, "id STRING, n BIGINT").select("id", "n")


@query("batch_files", "WITH b AS (SELECT (row_number() OVER (ORDER BY c_custkey) - 1) // 40 + 1 AS batch FROM customer) SELECT batch, count(*) AS rows FROM b GROUP BY 1")
def batch_files(spark: SparkSession, d: str) -> DataFrame:
    """SNK-04: batches of 40 as folders of files; rows of each as they are read back."""
    path = scratch(spark, "batches")
    sinks.write_batches(table(spark, d, "customer"), path, 40, ["c_custkey"])
    return spark.read.json(path).groupBy(F.col("batch").cast("long").alias("batch")).agg(F.count("*").alias("rows"))


@query("published_tables", "SELECT r_regionkey, r_name FROM region")
def published_tables(spark: SparkSession, d: str) -> DataFrame:
    """SNK-14, SNK-13: a table is published once its gates are empty; a dry run writes its report alone."""
    path, region = scratch(spark, "published"), table(spark, d, "region")
    none = gates.violation(region, "region: name", F.col("r_name").isNull(), "r_regionkey")
    sinks.publish({"region": region.limit(0)}, none, f"{path}/dry", dry_run=True, report=f"{path}/report")
    sinks.publish({"region": region}, none, path)
    return spark.read.parquet(f"{path}/region")


@query("safe_payload", """SELECT c_custkey, '{"id":' || c_custkey || ',"note":"a \\u003c/script> b"}' AS payload FROM customer""")
def safe_payload(spark: SparkSession, d: str) -> DataFrame:
    """SNK-06, PR-06."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("a </script> b").alias("note"))
    return rows.select(F.col("id").alias("c_custkey"), sinks.payload(rows).alias("payload"))


@query("audit_tables", "SELECT n_regionkey::VARCHAR AS gate, '<table>' || string_agg('<tr><td>' || n_name || '</td><td>a &lt; b</td></tr>', '' ORDER BY n_name || '<') || '</table>' AS html FROM nation GROUP BY 1")
def audit_tables(spark: SparkSession, d: str) -> DataFrame:
    """SNK-10, FN-31."""
    return sinks.audit_html(table(spark, d, "nation").select(F.col("n_regionkey").cast("string").alias("gate"), F.col("n_name").alias("id"), F.lit("a < b").alias("detail")))


@query("atom_feed", "SELECT '2501.' || (10000 + n_nationkey) AS id, 2 AS version, n_name AS title, 'An abstract.' AS abstract, 1 AS authors, 'cs.CL' AS primary_category FROM nation")
def atom_feed(spark: SparkSession, d: str) -> DataFrame:
    """SRC-07, SRC-08: entries of a feed that is written from the registry."""
    n = (10000 + F.col("n_nationkey")).cast("string")
    entry = F.concat(F.lit("<entry><id>http://arxiv.org/abs/2501."), n, F.lit("v2</id><title> "), "n_name", F.lit("\n</title><summary>An\n abstract.</summary><published>2025</published><author><name>A B</name></author><arxiv:primary_category xmlns:arxiv=\"http://arxiv.org/schemas/atom\" term=\"cs.CL\"/></entry>"))
    feed = table(spark, d, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("<feed>"), F.array_join(F.collect_list(entry), ""), F.lit("<entry><id>error</id></entry></feed>")).alias("value"))
    return parsers.atom_entries(feed).select("id", "version", "title", "abstract", F.size("authors").alias("authors"), "primary_category")


@query("oai_pages", "SELECT n_regionkey AS region, count(*) AS records, CASE WHEN n_regionkey % 2 = 0 THEN 'next' || n_regionkey END AS token FROM nation GROUP BY 1 UNION ALL SELECT 9, 0, NULL")
def oai_pages(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11: records and resumption tokens of harvested pages; a page without matches is empty."""
    record = F.concat(F.lit("<record><header><identifier>oai:"), "n_name", F.lit("</identifier></header></record>"))
    token = F.when(F.col("n_regionkey") % 2 == 0, F.concat(F.lit('<resumptionToken cursor="0">next'), F.col("n_regionkey").cast("string"), F.lit("</resumptionToken>"))).otherwise("<resumptionToken></resumptionToken>")
    pages = table(spark, d, "nation").groupBy("n_regionkey").agg(F.concat(F.array_join(F.collect_list(record), "\n"), F.first(token)).alias("value"))
    none = spark.createDataFrame([(9, '<error code="noRecordsMatch"/>')], "n_regionkey int, value string")
    found = [parsers.oai_records(p.where(F.col("n_regionkey") == k)).withColumn("region", F.lit(k)) for p, ks in ((pages, range(5)), (none, (9,))) for k in ks]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("region", F.size("ids").cast("long").alias("records"), "token")


@query("bib_entries", "SELECT 'k' || n_nationkey AS key, 'inproceedings' AS type, n_name || ' on two lines' AS title, '2025' AS year FROM nation")
def bib_entries(spark: SparkSession, d: str) -> DataFrame:
    """SRC-18: entries of a compressed bibliography whose values go on over lines."""
    path = scratch(spark, "bib")
    entry = F.concat(F.lit("@inproceedings{k"), F.col("n_nationkey").cast("string"), F.lit(",\n  title = {"), "n_name", F.lit(" on\n   two {lines}},\n  year = 2025\n}\n"))
    table(spark, d, "nation").select(entry.alias("value")).write.option("compression", "gzip").text(path)
    rows = parsers.bibtex(spark, path)
    return rows.select("key", "type", F.regexp_replace(F.col("fields")["title"], "[{}]", "").alias("title"), F.col("fields")["year"].alias("year"))


@query("seen_set", "SELECT user_id AS id FROM events GROUP BY 1")
def seen_set(spark: SparkSession, d: str) -> DataFrame:
    """ST-02: ids seen, each once, from two batches of a stream that overlap."""
    path = scratch(spark, "seen")
    write = crawl.append_unseen(spark, path)
    ids = table(spark, d, "events").select(F.col("user_id").alias("id"), "event_id")
    write(ids.where("event_id % 3 <> 0").select("id"), 0)
    write(ids.where("event_id % 3 <> 1").select("id"), 1)
    return spark.read.parquet(path).select("id")


_FLOW = """b AS (SELECT event_id, user_id AS id, event_id % 3 AS k, event_id AS pos, strftime(ts, '%Y-%m-%d') AS published, value AS score,
  CASE event_type WHEN 'click' THEN 'new' WHEN 'view' THEN 'already in the catalogue' WHEN 'purchase' THEN 'out of scope' ELSE '' END AS status FROM events)"""


def _flow(spark: SparkSession, d: str) -> DataFrame:
    """Events as entries of the feed in three batches; an entry's last status in a batch counts."""
    e = F.col("event_type")
    status = F.when(e == "click", "new").when(e == "view", "already in the catalogue").when(e == "purchase", "out of scope").otherwise("")
    return table(spark, d, "events").select(F.col("user_id").alias("id"), (F.col("event_id") % 3).alias("k"), F.col("event_id").alias("at"), F.date_format("ts", "yyyy-MM-dd").alias("published"), F.col("value").alias("score"), status.alias("status"))


@query("sticky_ledger", f"""WITH {_FLOW}, v AS (SELECT id, arg_max(published, (k, pos)) AS published, arg_max(score, (k, pos)) AS score, arg_max(status, (k, pos)) FILTER (status NOT IN ('', 'new')) AS verdict FROM b GROUP BY 1),
 f AS (SELECT id, arg_max(status, pos) AS status FROM b WHERE k = 2 GROUP BY 1)
 SELECT v.*, CASE WHEN id % 5 = 0 THEN 'admitted' WHEN f.status = 'new' OR verdict IS NULL AND f.id IS NOT NULL THEN 'under review' WHEN verdict LIKE 'already%' THEN 'already catalogued' ELSE 'not admitted' END AS outcome
 FROM v LEFT JOIN f USING (id)""")
def sticky_ledger(spark: SparkSession, d: str) -> DataFrame:
    """ST-05, SNK-09: the ledger after three batches, the second of which comes twice; verdicts stay when entries leave the feed."""
    flow = _flow(spark, d)
    ledger = state.StateTable(spark, scratch(spark, "ledger"), state.LEDGER, buckets=16)
    for epoch, k in enumerate((0, 1, 1, 2)):
        ledger.apply(flow.where(F.col("k") == k), min(epoch, k), state.ledger)
    feed = flow.where("k = 2").groupBy("id").agg(F.max_by("status", "at").alias("status"), F.lit(True).alias("in_feed"))
    rows = ledger.read().join(feed, "id", "left")
    return rows.select("id", "published", "score", "verdict", crawl.outcome(F.col("id") % 5 == 0, F.col("verdict"), F.col("status"), F.coalesce("in_feed", F.lit(False))).alias("outcome"))


@query("rolling_feed", f"""WITH {_FLOW}, e AS (SELECT id, k, max(score) AS score, min(published) AS published FROM b GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY id ORDER BY k DESC) = 1)
 SELECT id, score, published, row_number() OVER w AS place FROM e WINDOW w AS (ORDER BY k DESC, score DESC, published, id) QUALIFY place <= 60""")
def rolling_feed(spark: SparkSession, d: str) -> DataFrame:
    """ST-04: the feed of 60 after three batches, each a version of its own."""
    best = _flow(spark, d).groupBy("id", "k").agg(F.max("score").alias("score"), F.min("published").alias("published"))
    feed = state.StateTable(spark, scratch(spark, "feed"), "id long, score double, published string, place long", buckets=1)
    for k in range(3):
        feed.apply(best.where(F.col("k") == k).drop("k"), k, state.feed_of(60))
    return feed.read()


@query("session_windows", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g), a AS (SELECT user_id, k, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS stop, count(*) AS n FROM s GROUP BY 1, 2)
 SELECT user_id, start, n FROM a""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    """ST-07: runs of a user's events with gaps of less than half an hour."""
    rows = table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    per = rows.groupBy("user_id", F.session_window("t", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return per.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("registry_issues", "SELECT 'canonicalised two ways' AS gate, 'hard' AS severity, count(*) AS n FROM (SELECT p_name FROM part GROUP BY 1 HAVING count(DISTINCT p_brand || p_size % 2) > 1) HAVING count(*) > 0 UNION ALL SELECT 'several countries', 'soft', count(*) FROM (SELECT p_brand FROM part GROUP BY 1 HAVING count(DISTINCT p_size % 2) > 1) HAVING count(*) > 0")
def registry_issues(spark: SparkSession, d: str) -> DataFrame:
    """GT-07."""
    entries = table(spark, d, "part").select(F.col("p_name").alias("raw"), F.col("p_brand").alias("canonical"), (F.col("p_size") % 2).cast("string").alias("country"))
    return affiliations.registry_issues(entries, ["nobody"]).groupBy("gate", "severity").agg(F.count("*").alias("n"))


@query("diverged_records", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F'")
def diverged_records(spark: SparkSession, d: str) -> DataFrame:
    """GT-05: corrected records whose field was changed back by a later writer."""
    orders = table(spark, d, "orders")
    fields = F.create_map(F.lit("status"), F.to_json(F.struct("o_orderstatus")))
    records = orders.select(F.col("o_orderkey").alias("id"), fields.alias("fields"))
    after = F.create_map(F.lit("status"), F.to_json(F.struct(F.lit("F").alias("o_orderstatus"))))
    patches = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.lit(0).cast("long").alias("ord"), fields.alias("before"), after.alias("after"))
    return corrections.diverged(records, patches)


@query("metric_labels", "SELECT l_linenumber AS key, l_returnflag || CASE WHEN l_linenumber > 2 AND (bool_or(l_linenumber <= 2) OVER w) THEN ' · other sources' ELSE '' END AS label FROM (SELECT DISTINCT l_linenumber, l_returnflag FROM lineitem) WINDOW w AS (PARTITION BY l_returnflag)")
def metric_labels(spark: SparkSession, d: str) -> DataFrame:
    """WN-05: labels that reviewed options share get a suffix."""
    options = table(spark, d, "lineitem").select(F.lit("b").alias("benchmark"), F.col("l_linenumber").alias("key"), F.col("l_returnflag").alias("label"), (F.col("l_linenumber") <= 2).alias("reviewed")).distinct()
    return aliases.labels(options).select("key", "label")


@query("note_gates", "SELECT 'notes: no source' AS gate, count(*) AS n FROM orders WHERE o_custkey % 2 = 1 HAVING count(*) > 0 UNION ALL SELECT 'notes: incomplete finding', count(*) FROM orders WHERE o_orderkey % 5 = 0 HAVING count(*) > 0 UNION ALL SELECT 'notes: incomplete boundary', count(*) FROM orders WHERE o_orderkey % 7 = 0 HAVING count(*) > 0")
def note_gates(spark: SparkSession, d: str) -> DataFrame:
    """GT-08, JN-25: reading notes need a paper, and both languages of each part."""
    papers = table(spark, d, "orders").where("o_custkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.lit("https://arxiv.org/abs/2501.12345").alias("url"), F.lit("T").alias("title"), F.lit("2025-01").alias("date"))
    k, both = F.col("o_orderkey"), F.array(F.lit("en"), F.lit("zh"))
    notes = table(spark, d, "orders").select(k.alias("id"), both.alias("target"), F.when(k % 5 == 0, F.array(F.lit("en"))).otherwise(both).alias("finding"), F.when(k % 7 == 0, F.array(F.lit("en"), F.lit(""))).otherwise(both).alias("boundary"))
    found = gates.union(affiliations.literature_gates(papers, notes, papers.limit(0).select("id")))
    return found.groupBy("gate").agg(F.count("*").alias("n"))


@query("geo_gates", "SELECT 'geo: country code' AS gate, count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0 HAVING count(*) > 0 UNION ALL SELECT 'geo: half a coordinate', count(*) FROM supplier WHERE s_suppkey % 5 = 0 HAVING count(*) > 0 UNION ALL SELECT 'geo: range', count(*) FROM supplier WHERE s_suppkey % 7 = 0 HAVING count(*) > 0 UNION ALL SELECT 'geo: several leads', count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1 HAVING count(*) > 1)")
def geo_gates(spark: SparkSession, d: str) -> DataFrame:
    """GT-03."""
    k = F.col("s_suppkey")
    sites = table(spark, d, "supplier").select(k.alias("id"), F.when(k % 3 == 0, "Germany").otherwise("DE").alias("country"), F.when(k % 7 == 0, 91.0).otherwise(50.0).alias("lat"), F.when(k % 5 != 0, 8.0).alias("lon"))
    leads = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") <= 2).alias("lead"))
    return gates.union(gates.geo_gates(sites, leads)).groupBy("gate").agg(F.count("*").alias("n"))
