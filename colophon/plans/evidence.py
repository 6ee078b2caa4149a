"""Queries over venue evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import evidence as op
from colophon.operators import venue_records as R
from colophon.plans.assembly import _at
from colophon.plans.registry import query
from colophon.sources.tables import spread, table

_MATCH = ("exact", "weak", None, "fuzzy", "weak", "none")
_HITS = """h AS (SELECT l_orderkey AS id, l_linenumber AS ord, l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey AS place, l_partkey, l_suppkey, ['exact', 'weak', NULL, 'fuzzy', 'weak', 'none'][l_partkey % 6 + 1] AS match, 'https://x.org/' || (l_suppkey % 9) AS url,
  CASE l_partkey % 4 WHEN 0 THEN '10.48550/a' WHEN 1 THEN '10.1/' || (l_suppkey % 5) WHEN 2 THEN '' END AS doi FROM lineitem)"""
_PROMOTED = "p AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'https://x.org/' || (o_custkey % 9) ELSE 'https://doi.org/10.1/' || (o_custkey % 5) END AS url FROM orders WHERE o_orderstatus <> 'P')"


def _hits(spark: SparkSession, d: str) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    doi = F.when(part % 4 == 0, "10.48550/a").when(part % 4 == 1, F.concat(F.lit("10.1/"), (supplier % 5).cast("string"))).when(part % 4 == 2, "")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("ord"), (F.col("l_linenumber") * 1000000000000 + part * 100000 + supplier).alias("place"), part, supplier, _at(_MATCH, part).alias("match"), F.concat(F.lit("https://x.org/"), (supplier % 9).cast("string")).alias("url"), doi.alias("doi"))


def _promoted(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("o_custkey")
    url = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://x.org/"), (c % 9).cast("string"))).otherwise(F.concat(F.lit("https://doi.org/10.1/"), (c % 5).cast("string")))
    return table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), url.alias("url"))


_USABLE = "u AS (SELECT h.*, coalesce(match, 'exact') = 'weak' AS promoted FROM h WHERE coalesce(match, 'exact') IN ('exact', 'fuzzy') OR match = 'weak' AND EXISTS (SELECT 1 FROM p WHERE p.id = h.id AND (p.url = h.url OR h.doi <> '' AND p.url = 'https://doi.org/' || h.doi)))"


@query("usable_hits", f"WITH {_HITS}, {_PROMOTED}, {_USABLE} SELECT id, count(*) AS hits, count(*) FILTER (promoted) AS promoted FROM u GROUP BY 1")
def usable_hits(spark: SparkSession, d: str) -> DataFrame:
    """FIL-10."""
    return op.usable(_hits(spark, d), _promoted(spark, d)).groupBy("id").agg(F.count("*").alias("hits"), F.count_if("promoted").alias("promoted"))


_SEARCH = "A New Corpus of Spoken Dialogue for the Evaluation of Voice Agents in Noise"
_FOUND = (_SEARCH, "a new corpus of spoken dialogue, for the evaluation of {Voice} agents in noise", _SEARCH[:66], "Another Title Altogether", "A New Corpus")
_FOUND_LIST = "[" + ", ".join(f"'{f}'" for f in _FOUND) + "]"


@query("title_candidates", f"""WITH {_HITS}, c AS (SELECT *, CASE WHEN id % 3 = 0 THEN 'A New Corpus' ELSE '{_SEARCH}' END AS title, {_FOUND_LIST}[l_suppkey % 5 + 1] AS found FROM h WHERE ord < 6)
 SELECT CASE WHEN l_suppkey % 5 IN (0, 1) THEN 'exact' ELSE 'fuzzy' END AS match, count(*) AS n FROM c WHERE id % 3 <> 0 AND l_suppkey % 5 <> 3 AND l_suppkey % 5 IN (0, 1, 2, 4) AND coalesce(doi, '') NOT LIKE '10.48550%' GROUP BY 1""")
def title_candidates(spark: SparkSession, d: str) -> DataFrame:
    """JN-12, FIL-12, FIL-13, FIL-19. The found title that is only the head of the searched one is a prefix of it."""
    rows = _hits(spark, d).withColumn("title", F.when(F.col("id") % 3 == 0, "A New Corpus").otherwise(_SEARCH)).withColumn("found", _at(_FOUND, F.col("l_suppkey")))
    return op.candidates(rows).groupBy("match").agg(F.count("*").alias("n"))


@query("tree_candidates", "SELECT p_partkey AS id, ['exact', '', 'weak', '', 'fuzzy', ''][p_partkey % 6 + 1] AS kind FROM part WHERE p_partkey % 6 IN (0, 2, 4) AND p_size % 8 < 6")
def tree_candidates(spark: SparkSession, d: str) -> DataFrame:
    """JN-12, FN-10: results with the same title, a preprint's, another title by the same four authors, another title, a shorter title by the same two, two words."""
    k = F.col("p_partkey") % 6
    w = F.initcap(F.translate(F.col("p_partkey").cast("string"), "0123456789", "abcdefghij"))
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    title = F.when(k == 5, c("Two ", w)).otherwise(c("Measuring ", w, " voices in quiet rooms under heavy noise"))
    found = F.when(k <= 1, F.upper(c(title, "!"))).when(k == 4, c("Measuring ", w, " voices in quiet rooms")).when(k == 5, title).otherwise(c("Something else entirely about ", w, " rivers and hills"))
    people = lambda n, s: F.array(*[c(x, " ", w, s) for x in ("Ann", "Bob", "Cyd", "Dia")[:n]])
    authors, others = F.when(k == 4, people(2, "s")).otherwise(people(4, "s")), F.when(k == 3, people(4, "other")).when(k == 4, people(2, "s")).otherwise(people(4, "s"))
    part = spread(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey")  # the title match is heavy for each row
    rows = part.select(F.col("p_partkey").alias("id"), (F.col("p_size") % 8).alias("ord"), title.alias("title"), authors.alias("authors"), found.alias("found"), others.alias("found_authors"), F.when(k == 1, "10.48550/x").otherwise("10.1/x").alias("doi"))
    return op.tree_candidates(rows).select("id", "kind")


_TYPES = ("posted-content", "journal-article", "proceedings-article", "dataset")
_PLACES = ("Interspeech 2025", "Proceedings of the Small Workshop on Sounds", "Computer Speech & Language", "")
_CR = f"""c AS (SELECT id, place AS ord, ['posted-content', 'journal-article', 'proceedings-article', 'dataset'][l_partkey % 4 + 1] AS type, ['Interspeech 2025', 'Proceedings of the Small Workshop on Sounds', 'Computer Speech & Language', ''][l_suppkey % 4 + 1] AS container, doi FROM h),
 e AS (SELECT *, nullif(container, '') AS filled FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN type IN ('journal-article', 'proceedings-article') THEN 0 ELSE 1 END, ord) = 1)"""


def _crossref(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    h = _hits(spark, d)
    return h.select("id", F.col("place").alias("ord"), _at(_TYPES, F.col("l_partkey")).alias("type"), _at(_PLACES, F.col("l_suppkey")).alias("container"), F.lit("").alias("event"), none.alias("year"), F.lit("T").alias("title"), "doi", F.lit("").alias("url"))


@query("crossref_records", f"""WITH {_HITS}, {_CR} SELECT id, CASE container WHEN 'Interspeech 2025' THEN '2025' ELSE '' END AS venue_year,
 CASE container WHEN 'Interspeech 2025' THEN 'conference' WHEN 'Computer Speech & Language' THEN 'journal' WHEN 'Proceedings of the Small Workshop on Sounds' THEN 'workshop' ELSE CASE type WHEN 'journal-article' THEN 'journal' ELSE 'conference' END END AS venue_kind, coalesce(filled, '') AS venue_full, 'https://doi.org/' || coalesce(doi, '') AS evidence_url, 'T - ' || coalesce(filled, '') AS evidence_quote FROM e""")
def crossref_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51, WN-11, FN-58."""
    return R.from_crossref(_crossref(spark, d)).select("id", "venue_year", "venue_kind", "venue_full", "evidence_url", "evidence_quote")


_VENUES = ("ICLR 2025 Poster", "Submitted to ICLR 2025", "CoRR 2024", "", "NeurIPS 2024 Datasets and Benchmarks Track", "TMLR")


@query("openreview_records", f"""WITH {_HITS}, c AS (SELECT id, place AS ord, ['ICLR 2025 Poster', 'Submitted to ICLR 2025', 'CoRR 2024', '', 'NeurIPS 2024 Datasets and Benchmarks Track', 'TMLR'][l_partkey % 6 + 1] AS venue, l_suppkey % 4 = 0 AS mirror, l_suppkey % 2 = 1 AS decided FROM h),
 e AS (SELECT * FROM c WHERE NOT mirror AND venue IN ('ICLR 2025 Poster', 'NeurIPS 2024 Datasets and Benchmarks Track', 'TMLR') QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)
 SELECT id, CASE WHEN decided THEN 'published' ELSE 'accepted' END AS status, split_part(venue, ' ', 1) AS venue_name, regexp_extract(venue, '[0-9]+') AS venue_year, trim(regexp_replace(venue, '^[A-Za-z]+( [0-9]+)?', '')) AS track FROM e""")
def openreview_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51, WN-11."""
    rows = _hits(spark, d).select("id", F.col("place").alias("ord"), _at(_VENUES, F.col("l_partkey")).alias("venue"), (F.col("l_suppkey") % 4 == 0).alias("mirror"), (F.col("l_suppkey") % 2 == 1).alias("decided"), "url")
    return R.from_openreview(rows.withColumn("venueid", F.lit(""))).select("id", "status", "venue_name", "venue_year", "track")


@query("isca_records", f"WITH {_HITS}, c AS (SELECT id, ord, ['Interspeech', 'SSW', 'Odyssey Workshop'][l_partkey % 3 + 1] AS name, 2000 + l_suppkey % 25 AS year FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) = 1) SELECT id, name AS venue_name, year::VARCHAR AS venue_year, name || ' ' || year || ' (ISCA Archive)' AS venue_full FROM c")
def isca_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51."""
    event = F.concat(_at(("Interspeech", "SSW", "Odyssey Workshop"), F.col("l_partkey")), F.lit(" "), (2000 + F.col("l_suppkey") % 25).cast("string"))
    return R.from_isca(_hits(spark, d).select("id", F.col("place").alias("ord"), event.alias("event"), F.lit("T").alias("title"), "url")).select("id", "venue_name", "venue_year", "venue_full")


@query("accepted_history", "SELECT id, arg_max(url, turn) AS url FROM (SELECT o_orderkey AS id, o_orderpriority AS url, 0 AS turn FROM orders UNION ALL SELECT event_id, event_type, 1 FROM events) GROUP BY 1")
def accepted_history(spark: SparkSession, d: str) -> DataFrame:
    """SE-07."""
    previous = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("url"))
    return op.accepted_history(previous, table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("url")))


_CONFIRMED = "f AS (SELECT DISTINCT id, url FROM h WHERE match = 'weak' AND l_suppkey % 3 = 0 AND id NOT IN (SELECT id FROM u)), "


@query("promotion_fixpoint", f"WITH {_HITS}, {_PROMOTED}, {_USABLE}, {_CONFIRMED} q AS (SELECT * FROM p UNION ALL SELECT * FROM f) SELECT id, count(*) AS hits FROM h WHERE coalesce(match, 'exact') IN ('exact', 'fuzzy') OR match = 'weak' AND EXISTS (SELECT 1 FROM q WHERE q.id = h.id AND (q.url = h.url OR h.doi <> '' AND q.url = 'https://doi.org/' || h.doi)) GROUP BY 1")
def promotion_fixpoint(spark: SparkSession, d: str) -> DataFrame:
    """GR-05."""
    decided, _ = op.promotion_fixpoint(_hits(spark, d), lambda weak: weak.where("l_suppkey % 3 = 0"), _promoted(spark, d))
    return decided.groupBy("id").agg(F.count("*").alias("hits"))
