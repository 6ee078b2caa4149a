"""Queries over sources, parsers and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.plans.registry import query
from colophon.sources import parsers as P
from colophon.sources.sinks import stats_document
from colophon.sources.tables import scratch, table
from colophon.streaming import crawl


@query("month_windows", "SELECT strftime(d, '%Y-%m') AS month, strftime(d, '%Y%m%d') AS \"from\", strftime(d + INTERVAL 1 MONTH, '%Y%m%d') AS \"to\" FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)::DATE), date_trunc('month', max(o_orderdate)::DATE), INTERVAL 1 MONTH)) AS d FROM orders)")
def month_windows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-27: the months of all orders."""
    first, last = table(spark, d, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM"), F.date_format(F.max("o_orderdate"), "yyyy-MM")).first()
    return P.month_windows(spark, first, last)


@query("query_windows", "SELECT n_nationkey AS q, strftime(d, '%Y-%m') AS month, 'abs:' || n_name || ' AND submittedDate:[' || strftime(d, '%Y%m%d') || '0000 TO ' || strftime(d + INTERVAL 1 MONTH, '%Y%m%d') || '0000]' AS query FROM nation, (SELECT unnest(generate_series(DATE '2025-11-01', DATE '2026-02-01', INTERVAL 1 MONTH)) AS d)")
def query_windows(spark: SparkSession, d: str) -> DataFrame:
    templates = table(spark, d, "nation").select(F.col("n_nationkey").alias("q"), F.concat(F.lit("abs:"), "n_name", F.lit(" AND {D}")).alias("template"))
    return P.query_windows(templates, P.month_windows(spark, "2025-11", "2026-02"))


@query("html_text", f"SELECT page_id, {P.flatten_html_sql('html')} AS text FROM pages")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", P.flatten_html(F.col("html")).alias("text"))


@query("html_gate", f"SELECT page_id, length(html) >= 3000 AND NOT contains(left(html, 4000), 'No HTML for') AND length({P.flatten_html_sql('html')}) > 4000 AS good FROM pages")
def html_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", P.good_enough(F.col("html"), P.flatten_html(F.col("html"))).alias("good"))


@query("html_links", """SELECT page_id, (i - 1)::INT AS pos, h[i] AS href, t[i] AS title FROM (SELECT page_id, unnest(range(1, len(h) + 1)) AS i, h, t FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2) AS t FROM pages)) WHERE trim(t[i]) <> ''""".replace("\\\\", "\\"))
def html_links(spark: SparkSession, d: str) -> DataFrame:
    return P.html_links(table(spark, d, "pages"), "page_id", "html")


@query("resume_todo", "SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)")
def resume_todo(spark: SparkSession, d: str) -> DataFrame:
    """SRC-29: ids that aren't on disk yet."""
    done = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").join(done, "p_partkey", "left_anti").select(F.col("p_partkey").alias("id"))


@query("probe", "SELECT 'orders' AS source, o_orderkey AS ref FROM orders WHERE o_custkey = 7 UNION ALL SELECT 'events', event_id FROM events WHERE user_id = 7")
def probe(spark: SparkSession, d: str) -> DataFrame:
    """SRC-30: all evidence on one id; the filter reaches each source's scan."""
    a = table(spark, d, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("ref"), F.col("o_custkey").alias("id"))
    b = table(spark, d, "events").select(F.lit("events").alias("source"), F.col("event_id").alias("ref"), F.col("user_id").alias("id"))
    return a.unionByName(b).where("id = 7").select("source", "ref")


@query("stats_document", """SELECT '{"benchmarks":' || (SELECT count(*) FROM orders) || ',"cells":' || (SELECT count(*) FROM lineitem) || ',"models":' || (SELECT count(DISTINCT l_suppkey) FROM lineitem) || '}' AS json""")
def stats_json(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").agg(F.count("*").alias("benchmarks"))
    b = table(spark, d, "lineitem").agg(F.count("*").alias("cells"), F.count_distinct("l_suppkey").alias("models"))
    return stats_document(a.crossJoin(b))


def _streamed(spark: SparkSession, sf_dir: str, make, name: str) -> DataFrame:
    """The table of events as a file stream, through make, appended to a table of its own until all is read."""
    path = scratch(spark, f"stream-{name}")
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    out = make(stream)
    crawl.run_once(out, f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{path}/out")


@query("stream_dedup", "SELECT DISTINCT event_id, user_id, event_type FROM events WHERE value >= 20")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """ST-01, ST-03: flagged events once each, by a stream with a ten-day watermark."""
    return _streamed(spark, d, lambda s: crawl.flagged_stream(s, 20.0), "dedup").select("event_id", "user_id", "event_type")


@query("stream_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """ST-07: hourly counts of each event type that the watermark has closed."""
    return _streamed(spark, d, crawl.window_counts, "windows").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
 SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """ST-07: the sessions of each user that the watermark has closed."""
    return _streamed(spark, d, crawl.session_counts, "sessions").withColumn("start", F.col("start").cast("timestamp_ntz"))
