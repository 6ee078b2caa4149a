"""Queries over inputs with many distinct values, which take every branch of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import geo, venue_text
from colophon.functions import textnorm as T
from colophon.operators import affiliations, aliases, canon, gates, venues
from colophon.operators import geo as places
from colophon.plans.assembly import _at
from colophon.plans.registry import query
from colophon.plans.views import CELLS, LINE_ORDER, cells, with_views
from colophon.sources import sinks
from colophon.sources.tables import table


def _text(c: Column) -> Column:
    return c.cast("string")


#: Hosts with the bucket that each must give, texts likewise.
_HOST_BUCKETS = (
    ("aclanthology.org", "acl_anthology"), ("www.isca-archive.org", "isca_archive"), ("isca-speech.org", "isca_archive"), ("openreview.net", "openreview"), ("ieeexplore.ieee.org", "ieee"), ("dl.acm.org", "acm"), ("dblp.uni-trier.de", "dblp"),
    ("doi.org", "publisher"), ("api.crossref.org", "publisher"), ("proceedings.mlr.press", "publisher"), ("papers.nips.cc", "publisher"), ("www.jmlr.org", "publisher"), ("openaccess.thecvf.com", "publisher"), ("nowhere.example", ""),
)
_NEEDLE_BUCKETS = (
    ("the Anthology page", "acl_anthology"), ("ISCA list", "isca_archive"), ("on OpenReview", "openreview"), ("its journal_ref", "arxiv_journal_ref"), ("a journal reference", "arxiv_journal_ref"), ("arXiv listing", "arxiv_comment"), ("IEEE page", "ieee"),
    ("ACM library", "acm"), ("DBLP entry", "dblp"), ("Crossref record", "publisher"), ("a DOI", "publisher"), ("printed proceedings", "publisher"), ("word of mouth", "other"),
)
_SQL_LIST = lambda x: "[" + ", ".join("'" + v + "'" for v in x) + "]"


@query("bucketed_evidence", f"""WITH e AS (SELECT o_orderkey AS id, {_SQL_LIST(b for _, b in _HOST_BUCKETS)}[o_orderkey % {len(_HOST_BUCKETS)} + 1] AS host, {_SQL_LIST(b for _, b in _NEEDLE_BUCKETS)}[o_custkey % {len(_NEEDLE_BUCKETS)} + 1] AS needle, o_custkey % 17 AS k FROM orders)
 SELECT id, CASE WHEN k = 0 THEN 'isca_archive' WHEN k = 1 THEN CASE needle WHEN 'arxiv_journal_ref' THEN 'arxiv_journal_ref' ELSE 'arxiv_comment' END WHEN host <> '' THEN host ELSE needle END AS bucket FROM e""")
def bucketed_evidence(spark: SparkSession, d: str) -> DataFrame:
    """FN-24: sources named outright, hosts, the two kinds behind one host, and words of the text."""
    k = F.col("o_custkey") % 17
    host, text = _at(tuple(h for h, _ in _HOST_BUCKETS), F.col("o_orderkey")), _at(tuple(n for n, _ in _NEEDLE_BUCKETS), F.col("o_custkey"))
    url = F.when(k == 1, F.concat(F.lit("https://arxiv.org/abs/"), _text(F.col("o_orderkey")))).otherwise(F.concat(F.lit("https://"), host, F.lit("/x/"), _text(F.col("o_orderkey"))))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), venue_text.evidence_bucket(url, F.when(k == 0, " isca_archive ").otherwise(F.concat(text, F.lit(" "), _text(k)))).alias("bucket"))


_XY = "p AS (SELECT c_custkey AS id, (c_custkey * 7919 % 3600) / 10.0::DOUBLE - 180 AS lon, (c_custkey * 31 % 1800) / 10.0::DOUBLE - 90 AS lat FROM customer)"


@query("projected_places", f"WITH {_XY} SELECT id, floor((lon + 180) / 360 * 1000.0::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE) / 10 AS x, floor((84.0::DOUBLE - least(greatest(lat, -57.0::DOUBLE), 84.0::DOUBLE)) / 141.0::DOUBLE * (1000.0::DOUBLE * 141.0::DOUBLE / 360.0::DOUBLE) * 10.0::DOUBLE + 0.5::DOUBLE) / 10 AS y FROM p")
def projected_places(spark: SparkSession, d: str) -> DataFrame:
    """FN-40: both coordinates, with latitudes beyond the map on either side."""
    k = F.col("c_custkey")
    x, y = geo.project(k * 7919 % 3600 / 10.0 - 180, k * 31 % 1800 / 10.0 - 90)
    return table(spark, d, "customer").select(k.alias("id"), x.alias("x"), y.alias("y"))


@query("nation_regions", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 6 = 0 THEN 'Unknown' WHEN s_suppkey % 6 = 1 THEN 'Other' ELSE r_name END AS region FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey")
def nation_regions(spark: SparkSession, d: str) -> DataFrame:
    """FN-27: suppliers by the region of their nation, with nations that are empty or of no region."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    per = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).groupBy("r_name").agg(F.collect_list("n_name").alias("names")).collect()  # the regions' own table
    k, s = F.col("s_suppkey") % 6, table(spark, d, "supplier")
    rows = s.join(nation, s["s_nationkey"] == nation["n_nationkey"])
    country = F.when(k == 0, F.when(F.col("s_suppkey") % 12 == 0, "")).when(k == 1, F.concat("n_name", F.lit(" II"))).otherwise(F.col("n_name"))
    return rows.select(F.col("s_suppkey").alias("id"), geo.region(country, [(r["r_name"], r["names"]) for r in per]).alias("region"))


_PRINTED = """o AS (SELECT o_orderkey AS entry, o_custkey % 40 AS r, o_orderkey % 8 AS k FROM orders),
 p AS (SELECT *, CASE WHEN r < 30 THEN 'C' || (r % 3) END AS a_country, ['Town 0', 'Town 1', 'TOWN ' || (r % 4), 'Hong Kong Island', 'Macao', 'Orchard Road', 'Nowhere', NULL][k + 1] AS city, CASE k WHEN 2 THEN 'XX' WHEN 5 THEN 'SG' WHEN 3 THEN 'CN' END AS printed FROM o)"""


@query("printed_sites", f"""WITH {_PRINTED}, q AS (SELECT *, CASE k WHEN 3 THEN 'HK' WHEN 4 THEN 'MO' ELSE coalesce(printed, a_country) END AS country FROM p)
 SELECT entry, CASE WHEN r < 30 THEN 'inst' || r END AS inst, country,
  CASE WHEN k = 3 THEN 'Hong Kong' WHEN k = 4 THEN 'Macau' WHEN k = 7 THEN CASE WHEN r < 30 THEN 'Town' END WHEN k IN (0, 1) AND country = 'C' || k THEN city WHEN k IN (0, 1) AND r < 30 THEN 'Town' ELSE city END AS city,
  CASE WHEN k IN (3, 4, 5) THEN 'named' WHEN k IN (0, 1) AND country = 'C' || k THEN 'named' WHEN k IN (0, 1) AND r < 30 THEN 'named' WHEN r < 30 AND k IN (6, 7) THEN 'default' ELSE 'none' END AS placed FROM q""")
def printed_sites(spark: SparkSession, d: str) -> DataFrame:
    """JN-17, FN-50: printed cities with a site of their own, alike to the alias's city, in another country, in places of their own, unknown, and none."""
    r, k, no = F.col("o_custkey") % 40, F.col("o_orderkey") % 8, F.lit(None).cast("string")
    city = F.element_at(F.array(F.lit("Town 0"), F.lit("Town 1"), F.concat(F.lit("TOWN "), _text(r % 4)), F.lit("Hong Kong Island"), F.lit("Macao"), F.lit("Orchard Road"), F.lit("Nowhere"), no), (k + 1).cast("int"))
    printed = F.when(k == 2, "XX").when(k == 5, "SG").when(k == 3, "CN")
    occ = table(spark, d, "orders").select(F.col("o_orderkey").alias("entry"), F.concat(F.lit("raw"), _text(r)).alias("raw"), city.alias("printed_city"), printed.alias("printed_country"))
    occ = affiliations.own_places(occ)
    n = F.col("id")
    country = F.concat(F.lit("C"), _text(n % 3))
    known = spark.range(30).select(F.concat(F.lit("raw"), _text(n)).alias("raw"), F.concat(F.lit("inst"), _text(n)).alias("inst"), country.alias("inst_country"), country.alias("country"), F.lit("Town").alias("city"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    sites = spark.createDataFrame([("Town 0", "C0", 5.0, 6.0), ("Town 1", "C1", 7.0, 8.0)], "city string, country string, lat double, lon double")
    return affiliations.placed(occ, known, affiliations.with_own_sites(sites, occ)).select("entry", "inst", "country", "city", "placed")


@query("sites_apart", "SELECT s_nationkey AS inst, (s_suppkey % 4) / 1.0::DOUBLE AS lat, count(*) AS weight FROM supplier GROUP BY 1, 2")
def sites_apart(spark: SparkSession, d: str) -> DataFrame:
    """AG-17: of each institution four places a degree apart, each printed with two slightly different coordinates; the heavier one is kept."""
    k = F.col("s_suppkey")
    sites = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("inst"), (k % 4).alias("at"), F.floor(k % 8 / 4).alias("off")).agg(F.count("*").alias("weight"))
    rows = sites.select("inst", F.lit("Town").alias("city"), (F.col("at") + F.col("off") * 0.001).cast("double").alias("lat"), (F.col("at") * 2.0).alias("lon"), "weight")
    return places.merged_sites(rows, ["inst", "city"]).groupBy("inst", F.floor("lat").cast("double").alias("lat")).agg(F.sum("weight").alias("weight"))


@query("search_hits", """WITH s AS (SELECT p_partkey AS id, p_partkey % 4 AS k, string_split(p_name, ' ') AS w FROM part), t AS (SELECT *, list_distinct(w) AS want, list_distinct(CASE k WHEN 3 THEN ['other', 'words'] ELSE list_concat(w, ['one', 'two', 'three', 'four', 'five', 'six', 'seven']) END) AS got FROM s),
 b AS (SELECT *, len(list_intersect(want, got)) AS i FROM t), c AS (SELECT *, greatest(i / len(list_distinct(list_concat(want, got)))::DOUBLE, 0.92 * i / len(want)) AS base FROM b)
 SELECT id, CASE WHEN k IN (0, 2) AND base > 0 THEN greatest(base, 0.78) WHEN k = 1 THEN greatest(i / (len(got) + 3)::DOUBLE, 0.92 * i / 5) ELSE base END AS score FROM c""")
def search_hits(spark: SparkSession, d: str) -> DataFrame:
    """FN-35: a name in the title verbatim, or with its words apart and among longer wants, and not at all."""
    k, w = F.col("p_partkey") % 4, F.split("p_name", " ")
    want = F.when(k == 1, F.array_distinct(F.concat(w, F.array(*map(F.lit, ("x1", "x2", "x3")))))).otherwise(F.array_distinct(w))
    got = F.when(k == 3, F.array(F.lit("other"), F.lit("words"))).otherwise(F.array_distinct(F.concat(w, F.array(*map(F.lit, ("one", "two", "three", "four", "five", "six", "seven"))))))
    title = F.when(k.isin(0, 2), F.concat(F.lit("One two of "), F.initcap("p_name"), F.lit(": three"))).otherwise(F.concat(F.lit("x"), F.replace("p_name", F.lit(" "), F.lit(" of ")), F.lit("x")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), venue_text.search_score(F.col("p_name"), want, title, got).alias("score"))


@query("aliased_index", with_views(CELLS, "k AS (SELECT *, CASE WHEN metric IN ('A/F', 'R/F') AND source % 2 = 0 THEN 'alias:old' ELSE 'raw:' || metric END AS key FROM v_cells)") + " SELECT benchmark, key, model, array_to_string(list(source ORDER BY source), ',') AS cells FROM k GROUP BY 1, 2, 3")
def aliased_index(spark: SparkSession, d: str) -> DataFrame:
    """PR-04, JN-20: the metric index with reviewed groups over some observations."""
    rows = cells(spark, d).select("benchmark", "model", "metric", F.xxhash64(*LINE_ORDER).alias("fp"), F.col("source").alias("ord"), "source")
    assigned = rows.where(F.col("metric").isin("A/F", "R/F") & (F.col("source") % 2 == 0)).select("fp", F.lit("old").alias("group")).distinct()
    return aliases.metric_index(rows, assigned).withColumn("cells", F.array_join(F.col("cells").cast("array<string>"), ","))


@query("limited_lists", "WITH p AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\n]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL) SELECT doc_id, array_to_string(w[1:3], ' ') AS categories, array_to_string(w[1:6], ' ') AS tasks, array_to_string(w[1:4], ' ') AS aka, array_to_string(w[1:12], ' ') AS authors FROM p")
def limited_lists(spark: SparkSession, d: str) -> DataFrame:
    """SO-12: the first values of an entry's lists, without empty ones."""
    w = F.filter(F.split("text", "[ \\n]+"), lambda x: x != "")
    most = {"categories": 3, "tasks": 6, "aka": 4, "authors": 12}
    return table(spark, d, "documents").where("text is not null").select("doc_id", w.alias("w")).select("doc_id", *[F.array_join(F.slice("w", 1, n), " ").alias(c) for c, n in most.items()])


@query("filled_template", """SELECT c_custkey, '<html>' || c_name || '$0 \\1<script>{"id":' || c_custkey || ',"note":"a \\u003c/script> ' || c_mktsegment || '"}</script></html>' AS page FROM customer""")
def filled_template(spark: SparkSession, d: str) -> DataFrame:
    """SNK-06, GT-12, PR-06: a page from a template, its markers, which must be there, replaced literally by a name and a safe payload."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("a </script> "), "c_mktsegment").alias("note"), "c_name")
    template = "<html>@NAME@<script>@DATA@</script></html>"
    page = sinks.filled(template, {"@NAME@": F.concat("c_name", F.lit("$0 \\1")), "@DATA@": sinks.payload(rows.select("id", "note"))})
    return rows.select(F.col("id").alias("c_custkey"), page.alias("page"))


@query("venue_ids", "SELECT p_brand AS venue, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS ids FROM part GROUP BY 1")
def venue_ids(spark: SparkSession, d: str) -> DataFrame:
    """AG-26: the entries of each venue."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("venue"), F.col("p_partkey").alias("id"))
    return venues.venue_ids(rows).select("venue", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query("record_counters", "SELECT 'status' AS counter, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'source', o_orderpriority, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'verdict', CASE WHEN o_custkey % 3 = 0 THEN 'confirmed' WHEN o_custkey % 3 = 1 THEN 'cannot_verify' ELSE '' END, count(*) FROM orders GROUP BY 2")
def record_counters(spark: SparkSession, d: str) -> DataFrame:
    """AG-34: statuses, sources and verdicts in one pass."""
    c = F.col("o_custkey") % 3
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("source"), F.when(c == 0, "confirmed").when(c == 1, "cannot_verify").alias("verdict"))
    return venues.counters(rows, ["status", "source", "verdict"])


@query("refusal_samples", with_views(CELLS, "r AS (SELECT CASE WHEN value < 3 THEN 'not_a_model' WHEN value < 6 THEN 'unknown_benchmark' ELSE 'unmapped_model' END AS bucket, model AS name, benchmark::VARCHAR AS b, source::VARCHAR AS s, metric AS m FROM v_cells)") + " SELECT bucket, name, array_to_string(list_sort(list(DISTINCT b))[1:8], ',') AS benchmarks, array_to_string(list_sort(list(DISTINCT s))[1:8], ',') AS papers, array_to_string(list_sort(list(DISTINCT m))[1:4], ',') AS metrics FROM r GROUP BY 1, 2")
def refusal_samples(spark: SparkSession, d: str) -> DataFrame:
    """AG-15: where refused names were seen."""
    bucket = F.when(F.col("value") < 3, "not_a_model").when(F.col("value") < 6, "unknown_benchmark").otherwise("unmapped_model")
    return canon.refusal_samples(cells(spark, d), bucket, F.col("model"))


_ADDRESS = ("https://arxiv.org/abs/{N}v2", "https://arxiv.org/pdf/{N}.pdf", "http://arxiv.org/abs/{N}", "https://arxiv.org/html/{N}#S1", "https://arxiv.org/abs/{N}12", "https://arxiv.org/pdf/{N}v3.pdf?x=1", "see https://arxiv.org/abs/{N}", "https://arxiv.org/list/{N}")


@query("numbered_addresses", f"SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 3, 5) THEN n END AS paper FROM (SELECT o_orderkey, (1901 + o_custkey % 700)::VARCHAR || '.' || lpad((o_orderkey % 100000)::VARCHAR, 5, '0') AS n FROM orders)")
def numbered_addresses(spark: SparkSession, d: str) -> DataFrame:
    """FN-13, FN-12: addresses of many papers in eight forms."""
    n = F.concat(_text(1901 + F.col("o_custkey") % 700), F.lit("."), F.lpad(_text(F.col("o_orderkey") % 100000), 5, "0"))
    return table(spark, d, "orders").select("o_orderkey", T.paper_of_url(F.replace(_at(_ADDRESS, F.col("o_orderkey")), F.lit("{N}"), n)).alias("paper"))


_REG = """r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN 'Bad Id' WHEN o_orderkey % 50 = 1 THEN 'twice-' || (o_custkey % 3) ELSE 'id-' || o_orderkey END AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS name, CASE o_orderkey % 9 WHEN 0 THEN '' ELSE o_orderpriority END AS kind,
  ['2024-05', '2024-05-06', '', '2024', 'May 2024'][o_orderkey % 5 + 1] AS date, ['https://x.org', 'http://x.org', '', 'ftp://x.org', NULL][o_orderkey % 5 + 1] AS url FROM orders)"""


@query("registry_gates", f"""WITH {_REG}, v AS (SELECT 'entry: missing name' AS gate FROM r WHERE name IS NULL UNION ALL SELECT 'entry: missing kind' FROM r WHERE kind = '' UNION ALL SELECT 'entry: duplicate id' FROM r GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT 'entry: id form' FROM r WHERE id = 'Bad Id' UNION ALL SELECT 'entry: date form' FROM r WHERE date IN ('2024', 'May 2024') UNION ALL SELECT 'entry: url scheme' FROM r WHERE url LIKE 'ftp%') SELECT gate, count(*) AS n FROM v GROUP BY 1""")
def registry_gates(spark: SparkSession, d: str) -> DataFrame:
    """GT-01: each gate of a registry: required keys, unique ids, forms of ids, dates and addresses."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ident = F.when(k % 50 == 0, "Bad Id").when(k % 50 == 1, F.concat(F.lit("twice-"), _text(c % 3))).otherwise(F.concat(F.lit("id-"), _text(k)))
    rows = table(spark, d, "orders").select(
        ident.alias("id"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("name"), F.when(k % 9 == 0, "").otherwise(F.col("o_orderpriority")).alias("kind"),
        _at(("2024-05", "2024-05-06", "", "2024", "May 2024"), k).alias("date"), _at(("https://x.org", "http://x.org", "", "ftp://x.org", None), k).alias("url"),
    )
    return gates.union(gates.registry_gates(rows, "entry", ["name", "kind"], date="date", url="url")).groupBy("gate").agg(F.count("*").alias("n"))


@query("counted_claims", "SELECT CASE WHEN o_custkey % 4 IN (0, 1) AND NOT (o_orderstatus IN ('F', 'P') AND o_orderkey % 3 = 0) THEN CASE o_orderstatus WHEN 'F' THEN 'published' WHEN 'P' THEN 'accepted' ELSE 'preprint' END ELSE 'unchecked' END AS state, count(*) AS n FROM orders GROUP BY 1")
def counted_claims(spark: SparkSession, d: str) -> DataFrame:
    """FIL-09, AG-25: venue records count if a second read confirmed or corrected them and, if they claim a venue, there is an address to show."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    status = F.when(s == "F", "published").when(s == "P", "accepted").otherwise("preprint")
    rows = table(spark, d, "orders").select(status.alias("status"), _at(("confirmed", "corrected", "cannot_verify", None), F.col("o_custkey")).alias("verified"), F.when(k % 3 != 0, "https://x.org").alias("evidence_url"), F.lit("").alias("check_url"))
    shown = venues.publishable(F.col("status"), F.col("verified"), F.col("evidence_url"), F.col("check_url"))
    return rows.groupBy(venues.state(F.col("status"), shown).alias("state")).agg(F.count("*").alias("n"))
