"""The catalogue's entities as views over the star-schema tables, in Spark and as SQL for the oracles.

cells: result cells from order lines. catalogue: dated entries from orders. occurrences: which institution (supplier), in which
country, takes part in which entry (order). papers: documents. feed: events. Each has `ord`, a total order of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.sources.tables import by_rows, many, table

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def cells(spark: SparkSession, sf_dir: str, lines: int = 0) -> DataFrame:
    """benchmark, model, metric, value, source, ord..., own: whether the source is the benchmark's own (a third of the sources).

    With the number of order lines given, parts are met by a shuffle whose tasks hold a bounded number of lines, and never broadcast.
    """
    line, part, supplier = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    part = part.select("p_partkey", "p_brand")
    if lines:
        line, part = by_rows(line, lines, "l_partkey"), many(by_rows(part, lines, "p_partkey"))
    rows = line.join(part, line["l_partkey"] == part["p_partkey"])
    rows = rows.join(supplier.select("s_suppkey", "s_name"), rows["l_suppkey"] == supplier["s_suppkey"])
    return rows.select(
        F.col("p_brand").alias("benchmark"), F.col("s_name").alias("model"), F.concat_ws("/", "l_returnflag", "l_linestatus").alias("metric"),
        F.col("l_quantity").alias("value"), F.col("l_orderkey").alias("source"), (F.col("l_orderkey") % 3 == 0).alias("own"), *LINE_ORDER,
    )


CELLS = f"""
v_cells AS (
  SELECT p_brand AS benchmark, s_name AS model, l_returnflag || '/' || l_linestatus AS metric, l_quantity AS value,
         l_orderkey AS source, l_orderkey % 3 = 0 AS own, {", ".join(LINE_ORDER)}
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
"""
ORDER_SQL = ", ".join(LINE_ORDER)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, date (yyyy-MM-dd), status (of publication), kind, owner."""
    status = F.when(F.col("o_orderstatus") == "F", "published").when(F.col("o_orderstatus") == "P", "accepted").otherwise("preprint")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), status.alias("status"),
        F.col("o_orderpriority").alias("kind"), F.col("o_custkey").alias("owner"), (F.col("o_orderkey") % 5 != 0).alias("publishable"),
    )


CATALOGUE = """
v_catalogue AS (
  SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date,
         CASE o_orderstatus WHEN 'F' THEN 'published' WHEN 'P' THEN 'accepted' ELSE 'preprint' END AS status,
         o_orderpriority AS kind, o_custkey AS owner, o_orderkey % 5 <> 0 AS publishable
  FROM orders)
"""


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entry, date, inst, type, country, region, lead (the entry's first line)."""
    line, orders, supplier, nation, region = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "supplier", "nation", "region"))
    rows = line.join(orders.select("o_orderkey", "o_orderdate"), line["l_orderkey"] == orders["o_orderkey"])
    rows = rows.join(supplier.select("s_suppkey", "s_name", "s_nationkey"), rows["l_suppkey"] == supplier["s_suppkey"])
    rows = rows.join(nation, rows["s_nationkey"] == nation["n_nationkey"]).join(region, nation["n_regionkey"] == region["r_regionkey"])
    kind = F.when(F.col("s_suppkey") % 3 == 0, "academia").when(F.col("s_suppkey") % 3 == 1, "industry").otherwise("nonprofit")
    return rows.select(
        F.col("l_orderkey").alias("entry"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("s_name").alias("inst"),
        kind.alias("type"), F.col("n_name").alias("country"), F.col("r_name").alias("region"), (F.col("l_linenumber") == 1).alias("lead"),
    )


OCCURRENCES = """
v_occ AS (
  SELECT l_orderkey AS entry, strftime(o_orderdate, '%Y-%m-%d') AS date, s_name AS inst,
         CASE s_suppkey % 3 WHEN 0 THEN 'academia' WHEN 1 THEN 'industry' ELSE 'nonprofit' END AS type,
         n_name AS country, r_name AS region, l_linenumber = 1 AS lead
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title (first line), abstract (the text), lang, source."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), "lang", "source")


PAPERS = """
v_papers AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS abstract, lang, source FROM documents)
"""


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, published, status, score, author."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("ts").alias("published"), F.col("event_type").alias("status"), F.col("value").alias("score"), F.col("user_id").alias("author"), F.get_json_object("props", "$.k").cast("int").alias("k"))


FEED = """
v_feed AS (
  SELECT event_id AS id, ts AS published, event_type AS status, value AS score, user_id AS author,
         CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views)
