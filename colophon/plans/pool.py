"""Queries over candidate pools, mentions, ledgers and mail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.operators import pool as op
from colophon.plans.registry import query
from colophon.plans.views import FEED, PAPERS, catalogue, feed, papers, with_views
from colophon.sources.tables import table


@query("first_seen_pool", with_views(PAPERS) + " SELECT md5(abstract) AS paper, arg_min(source, id) AS first_source, array_to_string(list(source ORDER BY id), ',') AS found_in, count(DISTINCT source) AS n_sources FROM v_papers GROUP BY 1")
def first_seen_pool(spark: SparkSession, d: str) -> DataFrame:
    rows = papers(spark, d).select(F.md5("abstract").alias("paper"), "source", "id")
    pool = op.first_seen(rows, "paper", "source", ["id"])
    return pool.select("paper", "first_source", F.array_join("found_in", ",").alias("found_in"), F.size("found_by").cast("long").alias("n_sources"))


@query("pool_coverage", with_views(PAPERS, "p AS (SELECT md5(abstract) AS k, arg_min(source, id) AS first_source, count(DISTINCT source) AS s FROM v_papers GROUP BY 1)") + " SELECT first_source, count(*) AS ids, count(*) FILTER (s > 1) AS several FROM p GROUP BY 1")
def pool_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = papers(spark, d).select(F.md5("abstract").alias("paper"), "source", "id")
    return op.coverage(op.sources_of(rows, "paper", "source", ["id"]))


@query("anti_seen", "SELECT l_orderkey AS id, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_orderkey NOT IN (SELECT event_id FROM events WHERE event_type = 'click') GROUP BY 1")
def anti_seen(spark: SparkSession, d: str) -> DataFrame:
    """JN-03, JN-04, SE-01: candidates that neither list has seen."""
    seen = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    seen = seen.union(table(spark, d, "events").where("event_type = 'click'").select("event_id"))
    found = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"))
    return found.join(seen, "id", "left_anti")


@query("feed_top60", with_views(FEED) + """ SELECT id, status, score FROM (SELECT id, status, score, true AS fresh, score AS s, published AS p FROM v_feed WHERE published >= (SELECT max(published) FROM v_feed) - INTERVAL 1 DAY AND score >= 18
 UNION ALL SELECT id, status, score, false, NULL, NULL FROM v_feed WHERE NOT (published >= (SELECT max(published) FROM v_feed) - INTERVAL 1 DAY) AND status = 'purchase') ORDER BY fresh DESC, s DESC, p, id LIMIT 60""")
def feed_top60(spark: SparkSession, d: str) -> DataFrame:
    rows = feed(spark, d).select("id", "published", "status", "score")
    last = rows.agg(F.max("published").alias("_last"))
    rows = rows.crossJoin(last).withColumn("new", F.col("published") >= F.col("_last") - F.expr("interval 1 day")).drop("_last")
    fresh = rows.where("new and score >= 18").drop("new")
    previous = rows.where("not new and status = 'purchase'").drop("new").withColumn("place", F.lit(0).cast("long"))
    return op.feed(fresh, previous).select("id", "status", "score")


@query("batching", "SELECT (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 200 + 1 AS batch, o_orderkey AS id FROM orders")
def batching(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return op.batches(rows, 200, [F.desc("o_totalprice"), F.col("o_orderkey")]).select("batch", F.col("o_orderkey").alias("id"))


_MENTIONS = r"""v_mentions AS (SELECT l_orderkey * 10 + l_linenumber AS ord, p_name AS name, p_type AS title,
  CASE WHEN l_partkey % 3 = 0 THEN '2501.' || (10000 + l_partkey // 4) END AS paper
  FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1) JOIN part ON p_partkey = l_partkey)"""


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    line = line.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")).alias("r"))
    rows = line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("r.l_partkey").alias("p_partkey")).join(part, "p_partkey")
    k = F.col("p_partkey")
    paper = F.when(k % 3 == 0, F.concat(F.lit("2501."), (10000 + F.floor(k / 4)).cast("string")))
    return rows.select("ord", F.col("p_name").alias("name"), F.col("p_type").alias("title"), paper.alias("paper"))


_KEYED = "k AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS key FROM v_mentions)"


@query("mention_merge", with_views(_MENTIONS, _KEYED, "t AS (SELECT key, title, count(*) AS n, min(ord) AS o FROM k GROUP BY 1, 2)", "m AS (SELECT key, title FROM t QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, o) = 1)") + " SELECT key, count(*) AS mentions, any_value(m.title) AS full_title, count(DISTINCT paper) AS papers FROM k JOIN m USING (key) GROUP BY 1")
def mention_merge(spark: SparkSession, d: str) -> DataFrame:
    """AG-13: mentions by normalised name; the title is the most frequent one, the first seen of equals."""
    rows = _mentions(spark, d).withColumn("key", T.mention_key(F.col("name")))
    title = op.mode_first_seen(rows, ["key"], "title", "ord").withColumnRenamed("title", "full_title")
    return rows.groupBy("key").agg(F.count("*").alias("mentions"), F.count_distinct("paper").alias("papers")).join(title, "key")


_WHOLE = r"""v_whole AS (SELECT l_orderkey * 10 + l_linenumber AS ord, CASE WHEN l_suppkey % 5 = 0 THEN ' ' || upper(p_name) || ' (x)' WHEN l_suppkey % 5 = 1 THEN replace(p_name, ' ', '-') ELSE p_name END AS name, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE p_type END AS full_title,
  CASE WHEN l_partkey % 3 = 0 THEN '2501.' || (10000 + l_partkey // 4) END AS paper, ['https://x.org/' || (l_suppkey % 5), '', NULL][l_suppkey % 3 + 1] AS url, CASE WHEN l_suppkey % 4 <> 0 THEN ' ' || (2019 + l_suppkey % 6) END AS year,
  CASE WHEN l_suppkey % 11 <> 0 THEN p_brand END AS category, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag || l_linestatus || l_suppkey END AS one_line, CASE WHEN l_suppkey % 9 <> 0 THEN repeat('paper ' || (l_suppkey % 40) || ' ', 14) END AS evidence
  FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus) = 1) JOIN part ON p_partkey = l_partkey)"""
_LONG = """k AS (SELECT *, regexp_replace(regexp_replace(lower(trim(name)), '\\s*\\(.*?\\)\\s*', ' ', 'g'), '[^a-z0-9]+', '', 'g') AS key FROM v_whole),
 l AS (""" + " UNION ALL ".join(f"SELECT key, ord, '{f}' AS f, trim({c}) AS v FROM k WHERE coalesce(trim({c}), '') <> ''" for f, c in (("name", "name"), ("title", "full_title"), ("paper", "paper"), ("url", "url"), ("year", "year"), ("category", "category"))) + """),
 r AS (SELECT key, f, v, row_number() OVER (PARTITION BY key, f ORDER BY count(*) DESC, min(ord)) AS r FROM l GROUP BY 1, 2, 3),
 m AS (SELECT key, """ + ", ".join(f"max(v) FILTER (f = '{f}' AND r = 1) AS {n}" for f, n in (("name", "name"), ("title", "full_title"), ("paper", "paper"), ("url", "url"), ("year", "year"))) + """, string_agg(v, '|' ORDER BY v) FILTER (f = 'name' AND r > 1) AS aliases, string_agg(v, '|' ORDER BY r) FILTER (f = 'paper' AND r > 1) AS conflicts, string_agg(v, '|' ORDER BY r) FILTER (f = 'category') AS categories FROM r GROUP BY 1),
 o AS (SELECT key, count(*) AS mention_count, array_to_string(list(one_line ORDER BY ord) FILTER (one_line IS NOT NULL)[1:4], '|') AS one_lines, array_to_string(list_sort(list(DISTINCT substr(coalesce(evidence, ''), 1, 110)))[1:5], '|') AS sources FROM k GROUP BY 1)"""


def _whole_mentions(spark: SparkSession, d: str) -> DataFrame:
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    line = line.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")).alias("r"))
    rows = line.select("l_orderkey", "l_linenumber", "r.*").join(part, F.col("l_partkey") == part["p_partkey"])
    s, p, no = F.col("l_suppkey"), F.col("l_partkey"), F.lit(None).cast("string")
    text = lambda c: c.cast("string")
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.when(s % 5 == 0, F.concat(F.lit(" "), F.upper("p_name"), F.lit(" (x)"))).when(s % 5 == 1, F.replace("p_name", F.lit(" "), F.lit("-"))).otherwise(F.col("p_name")).alias("name"),
        F.when(s % 7 == 0, no).otherwise(F.col("p_type")).alias("full_title"), F.when(p % 3 == 0, F.concat(F.lit("2501."), text(10000 + F.floor(p / 4)))).alias("paper"), F.when(s % 3 == 0, F.concat(F.lit("https://x.org/"), text(s % 5))).when(s % 3 == 1, "").alias("url"),
        F.when(s % 4 != 0, F.concat(F.lit(" "), text(2019 + s % 6))).alias("year"), F.when(s % 11 != 0, F.col("p_brand")).alias("category"), F.when(F.col("l_linenumber") % 2 == 0, F.concat("l_returnflag", "l_linestatus", text(s))).alias("one_line"),
        F.when(s % 9 != 0, F.repeat(F.concat(F.lit("paper "), text(s % 40), F.lit(" ")), 14)).alias("evidence"),
    )


@query("merged_mentions", with_views(_WHOLE, _LONG) + " SELECT key, name, coalesce(aliases, '') AS aliases, full_title, paper, coalesce(conflicts, '') AS conflicts, url, year, coalesce(categories, '') AS categories, coalesce(one_lines, '') AS one_lines, mention_count, sources FROM m JOIN o USING (key)")
def merged_mentions(spark: SparkSession, d: str) -> DataFrame:
    """AG-13: the whole record of each mentioned name."""
    rows = _whole_mentions(spark, d).withColumn("key", T.mention_key(F.col("name")))
    lists = ("aliases", "conflicts", "categories", "one_lines", "sources")
    return op.merged_mentions(rows).withColumns({c: F.array_join(c, "|") for c in lists})


_SEEN = "t AS (SELECT user_id AS id, event_type AS source, arg_min(value, (ts, event_id)) AS v, min((ts, event_id)) AS place, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT id, arg_min(source, place) AS first_source, arg_min(v, place) AS score, count(*) AS s FROM t GROUP BY 1)"


def _event_pool(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("source"), "ts", "event_id", "value")
    score = e.groupBy("id").agg(F.min_by("value", F.struct("ts", "event_id")).alias("score"))
    return op.sources_of(e, "id", "source", ["ts", "event_id"]).join(score, "id")


@query("pool_bands", f"WITH {_SEEN} SELECT first_source, count(*) AS ids, count(*) FILTER (s > 1) AS several, count(*) FILTER (score >= 20) AS score_ge_20, count(*) FILTER (score >= 8 AND score < 20) AS score_8_19, count(*) FILTER (score < 8) AS score_lt_8 FROM p GROUP BY 1")
def pool_bands(spark: SparkSession, d: str) -> DataFrame:
    """AG-14: first sources with the score bands of what they found first."""
    return op.coverage(_event_pool(spark, d), "score")


@query("pool_sources", f"WITH {_SEEN} SELECT source, sum(n)::BIGINT AS records, count(*) AS ids FROM t GROUP BY 1")
def pool_sources(spark: SparkSession, d: str) -> DataFrame:
    """AG-14, SE-03: records and ids of each source."""
    return op.per_source(_event_pool(spark, d))


@query("mention_aliases", with_views(_MENTIONS, _KEYED, "f AS (SELECT key, min(ord) AS ko FROM k GROUP BY 1)", "o AS (SELECT paper, arg_min(key, struct_pack(a := ko, b := ord)) AS owner FROM k JOIN f USING (key) WHERE paper IS NOT NULL GROUP BY 1)") + " SELECT key, arg_max(owner, ord) AS target FROM k JOIN o USING (paper) WHERE owner <> key GROUP BY 1")
def mention_aliases(spark: SparkSession, d: str) -> DataFrame:
    return op.single_hop_aliases(_mentions(spark, d).select("ord", T.mention_key(F.col("name")).alias("key"), "paper"))


@query("citing_rank", "SELECT l_suppkey AS citing, count(DISTINCT l_partkey) AS n, 2 * count(DISTINCT l_partkey) + 3 * count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') - 12 * (l_suppkey % 7 = 0)::INT AS rank FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY 1")
def citing_rank(spark: SparkSession, d: str) -> DataFrame:
    """JN-19, GR-04, FN-34: citation edges inverted, without catalogued papers, ranked."""
    line = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("citing"), "l_partkey", "l_returnflag")
    known = table(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("citing"))
    per = line.join(known, "citing", "left_anti").groupBy("citing").agg(F.count_distinct("l_partkey").alias("n"), F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("r"))
    return per.select("citing", "n", (2 * F.col("n") + 3 * F.col("r") - 12 * (F.col("citing") % 7 == 0).cast("int")).alias("rank"))


@query("ledger_outcome", with_views(FEED) + """, c AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P'), j AS (
 SELECT f.id, f.status, CASE WHEN k = 3 THEN 'already in catalogue' WHEN k % 4 = 1 THEN 'out of scope' END AS verdict, c.id IS NOT NULL AS known FROM v_feed f LEFT JOIN c ON c.id = f.id)
 SELECT id, CASE WHEN known THEN 'admitted' WHEN regexp_matches(status, '^(view|new)') OR (verdict IS NULL AND status <> 'error') THEN 'under review' WHEN regexp_matches(lower(coalesce(verdict, '')), 'catalogu|already') THEN 'already catalogued' ELSE 'not admitted' END AS outcome FROM j""")
def ledger_outcome(spark: SparkSession, d: str) -> DataFrame:
    """ST-05, JN-05: the outcome of each ledger entry from the catalogue, the feed's status and the verdict."""
    from colophon.streaming.crawl import outcome

    rows = feed(spark, d).select("id", "status", "k")
    known = catalogue(spark, d).where("status = 'accepted'").select("id", F.lit(True).alias("known"))
    rows = rows.join(known, "id", "left").withColumn("verdict", F.when(F.col("k") == 3, "already in catalogue").when(F.col("k") % 4 == 1, "out of scope"))
    return rows.select("id", outcome(F.coalesce("known", F.lit(False)), F.col("verdict"), F.col("status"), F.col("status") != "error", "^(view|new)").alias("outcome"))


@query("ledger_upsert", "SELECT coalesce(a.id, b.id) AS id, coalesce(a.v, b.v) AS score, a.id IS NOT NULL AS fresh FROM (SELECT o_orderkey AS id, nullif(o_totalprice, 0) AS v FROM orders) a FULL JOIN (SELECT event_id AS id, value AS v FROM events) b ON a.id = b.id")
def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    """JN-06, SNK-09: fields of the new rows over those of the previous ledger."""
    new = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"), F.lit(True).alias("fresh"))
    old = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("value").alias("w"))
    return new.join(old, "id", "full_outer").select("id", F.coalesce("v", "w").alias("score"), F.coalesce("fresh", F.lit(False)).alias("fresh"))


@query("stranger_mail", "SELECT conv_id, text FROM conversations WHERE turn = 0 AND role <> 'assistant' AND regexp_matches(lower(text), '(^|[^a-z0-9])(the|der|le)([^a-z0-9]|$)') AND NOT regexp_matches(lower(text), 'unsubscribe|newsletter')")
def stranger_mail(spark: SparkSession, d: str) -> DataFrame:
    """FIL-16, FIL-17: first messages of a thread, of unknown senders, that a keyword lets through."""
    from colophon.operators.mail import is_new_thread, wanted

    m = table(spark, d, "conversations")
    keep = is_new_thread(F.when(F.col("turn") > 0, F.lit("ref")), F.lit(None).cast("string")) & (F.col("role") != "assistant")
    return m.where(keep & wanted(F.col("text"), ["(^|[^a-z0-9])(the|der|le)([^a-z0-9]|$)"], ["unsubscribe|newsletter"])).select("conv_id", "text")


@query("merge_chain", """WITH RECURSIVE e AS (SELECT n_nationkey AS a, CASE WHEN n_nationkey % 6 = 0 THEN NULL WHEN n_nationkey = 23 THEN 22 ELSE n_nationkey - 1 END AS b FROM nation),
 w AS (SELECT a AS start, a AS now, [a] AS path FROM e UNION ALL SELECT w.start, e.b, list_append(path, e.b) FROM w JOIN e ON e.a = w.now WHERE e.b IS NOT NULL AND NOT list_contains(path, e.b))
 SELECT start AS id, now AS target, len(path) - 1 AS hops FROM w WHERE now NOT IN (SELECT a FROM e WHERE b IS NOT NULL)""")
def merge_chain(spark: SparkSession, d: str) -> DataFrame:
    """GR-01: merge pointers followed to their ends."""
    from colophon.operators.graph import resolve_chains

    k = F.col("n_nationkey")
    nodes = table(spark, d, "nation").select(k.alias("id"), F.when(k % 6 == 0, None).otherwise(k - 1).alias("into"))
    return resolve_chains(nodes).where("not cyclic").select("id", "target", "hops")


@query("top_sources", "SELECT source, n FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1) ORDER BY n DESC, source LIMIT 6")
def top_sources(spark: SparkSession, d: str) -> DataFrame:
    """SO-09: the six most used, ties by name."""
    return papers(spark, d).groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(6)


@query("worklist", "SELECT o_custkey AS owner, o_orderkey AS id FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 4")
def worklist(spark: SparkSession, d: str) -> DataFrame:
    """SO-10, SO-12: the first four entries of each owner; ranks are limited before the shuffle."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice").withColumn("r", F.row_number().over(w)).where("r <= 4")
    return rows.select(F.col("o_custkey").alias("owner"), F.col("o_orderkey").alias("id"))
