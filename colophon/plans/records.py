"""Queries over venue texts, affiliation records and literature gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.functions import venue_text as V
from colophon.functions.rules import on_distinct
from colophon.operators import affiliations as A
from colophon.operators import gates
from colophon.plans.registry import query
from colophon.sources.tables import table

NAMES = (
    "Interspeech 2026", "2026 IEEE Symposium on Security and Privacy", "ICLR2025", "34th ACM Multimedia 2026 (MM '26)", "Computer Speech & Language",
    "Findings of EMNLP 2024", "Annual Meeting of the Association for Computational Linguistics", "Workshop on Small Things", "NeurIPS 2025 Workshop", "",
)
_LIST = "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in NAMES) + "]"
_RAW = f"raw AS (SELECT o_orderkey AS id, {_LIST}[o_orderkey % {len(NAMES)} + 1] AS name, CASE WHEN o_orderkey % 3 = 0 THEN '2025' ELSE '' END AS year, CASE WHEN o_orderkey % 7 = 0 THEN 'Demo' END AS track, o_custkey FROM orders)"


def _raw(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (k % len(NAMES) + 1).cast("int"))
    return table(spark, d, "orders").select(k.alias("id"), name.alias("name"), F.when(k % 3 == 0, "2025").otherwise("").alias("year"), F.when(k % 7 == 0, "Demo").alias("track"), "o_custkey")


def _tidy_sql(n: str) -> str:
    for pattern, put in ((r"^\s*(?:19|20)\d{2}\s+", ""), (r"\s*(?:19|20)\d{2}\s*$", ""), (r"([A-Za-z])(?:19|20)\d{2}$", r"\1"), (r"^\s*\d+(?:st|nd|rd|th)\s+", ""), (r"\s*\([^()]*''?\d{2,4}\)\s*$", ""), (r"\s*(?:19|20)\d{2}\s*$", ""), (r"^[ \-:,]+|[ \-:,]+$", "")):
        n = f"regexp_replace({n}, '{pattern}', '{put}', 'g')"
    return n


@query("venue_display", f"WITH {_RAW} SELECT id, concat_ws(' ', nullif({_tidy_sql('name')}, ''), nullif(year, ''), track) AS display FROM raw")
def venue_display(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("id", V.display(F.col("name"), F.col("year"), F.col("track")).alias("display"))


_FAMILY = "CASE " + " ".join(f"WHEN regexp_matches(' ' || lower(name) || ' ', '{p.replace(chr(39), chr(39) * 2)}') THEN '{f}'" for p, f in V.FAMILIES) + " END"


@query("venue_family", f"WITH {_RAW} SELECT {_FAMILY} AS family, count(*) AS n FROM raw GROUP BY 1")
def venue_family(spark: SparkSession, d: str) -> DataFrame:
    return on_distinct(_raw(spark, d), "name", "family", V.family).groupBy("family").agg(F.count("*").alias("n"))


_BUCKET = "CASE WHEN p_type IN ('acl_anthology') THEN p_type " + " ".join(f"WHEN contains(u, '{h}') THEN " + ("'arxiv_comment'" if t == "arxiv" else f"'{t}'") for h, t in V.HOSTS) + " ELSE 'other' END"


@query("evidence_buckets", f"WITH u AS (SELECT p_partkey, p_type, CASE p_partkey % 4 WHEN 0 THEN 'https://aclanthology.org/' WHEN 1 THEN 'https://doi.org/10.1' WHEN 2 THEN 'https://ARXIV.org/abs/' ELSE 'x' END AS l FROM part), v AS (SELECT p_type, lower(l) AS u FROM u) SELECT {_BUCKET} AS bucket, count(*) AS n FROM v GROUP BY 1")
def evidence_buckets(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    url = F.when(k == 0, "https://aclanthology.org/").when(k == 1, "https://doi.org/10.1").when(k == 2, "https://ARXIV.org/abs/").otherwise("x")
    return table(spark, d, "part").groupBy(V.evidence_bucket(url, F.lit("note")).alias("bucket")).agg(F.count("*").alias("n"))


@query("venue_registry", f"""WITH {_RAW}, k AS (SELECT *, trim(regexp_replace(lower(name), '[^a-z0-9&]+', ' ', 'g')) AS key FROM raw),
 b AS (SELECT *, trim(regexp_replace(key, '\\s*(?:19|20)[0-9]{{2}}$', '')) AS bare FROM k)
 SELECT id, CASE WHEN bare = 'interspeech' THEN 'interspeech' WHEN bare = 'computer speech & language' THEN 'csl' ELSE nullif(regexp_replace(left(regexp_replace(bare, '[^a-z0-9]+', '-', 'g'), 48), '^-+|-+$', '', 'g'), '') END AS venue,
        bare NOT IN ('interspeech', 'computer speech & language') AS unregistered FROM b""".replace("\\\\s", "\\s"))
def venue_registry(spark: SparkSession, d: str) -> DataFrame:
    registry = spark.createDataFrame([("interspeech", "Interspeech", "Interspeech", "speech"), ("csl", "Computer Speech & Language", "", "speech")], "id string, name string, full string, community string")
    names = _raw(spark, d).select("id", F.col("name").alias("venue_name"), F.lit("").alias("venue_full"), F.lit(None).cast("string").alias("parent"))
    return A.canonical_venues(names, registry).select("id", "venue", "unregistered")


_OCC = """occ AS (SELECT l_orderkey AS entry, min(l_linenumber) AS ord, l_suppkey AS inst, n_name AS country, bool_or(l_quantity > 10) AS own FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 3, 4)"""


@query("affiliation_records", f"""WITH {_OCC}, p AS (SELECT entry, count(*) AS n, bool_and(own) AS complete FROM occ GROUP BY 1),
 e AS (SELECT o_orderkey AS entry, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN 'unverified' WHEN o_orderkey % 3 = 0 THEN 'corrected' WHEN o_orderkey % 3 = 1 THEN 'confirmed' ELSE 'unverified' END AS verified FROM orders)
 SELECT e.entry, verified, coalesce(n, 0) AS n, coalesce(n, 0) > 0 AND verified IN ('confirmed', 'corrected') AS publishable, coalesce(complete, false) AS countries_complete FROM e LEFT JOIN p ON p.entry = e.entry""")
def affiliation_records(spark: SparkSession, d: str) -> DataFrame:
    """UP-05."""
    line, supplier = table(spark, d, "lineitem"), table(spark, d, "supplier")
    occ = line.join(supplier, line["l_suppkey"] == supplier["s_suppkey"]).groupBy(F.col("l_orderkey").alias("entry"), F.col("l_suppkey").alias("inst")).agg(F.min("l_linenumber").alias("ord"), F.bool_or(F.col("l_quantity") > 10).alias("own_country"))
    k = F.col("o_orderkey")
    entries = table(spark, d, "orders").select(k.alias("entry"), F.lit(None).cast("string").alias("status"), F.when(k % 3 == 0, "corrected").when(k % 3 == 1, "confirmed").alias("verified"), F.when(k % 2 == 0, "reason").alias("verify_reason"))
    return A.records(occ.withColumn("lead", F.lit(False)), entries).select("entry", "verified", "n", "publishable", "countries_complete")


@query("model_builders", """WITH l AS (SELECT o_custkey AS model, o_orderkey AS ord, o_orderkey % 4 AS inst, o_orderkey % 9 = 0 AS lead FROM orders WHERE o_custkey % 13 <> 0), k AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY model, inst ORDER BY ord) = 1),
 p AS (SELECT model, count(*) AS n, coalesce(arg_min(inst, ord) FILTER (lead), arg_min(inst, ord)) AS lead_inst FROM k GROUP BY 1)
 SELECT c_custkey AS model, CASE WHEN c_custkey % 13 = 0 THEN 'composite' WHEN n IS NULL THEN 'unknown' ELSE 'ok' END AS status, coalesce(n, 0) AS n, lead_inst, c_custkey % 13 <> 0 AND n IS NOT NULL AND c_custkey % 2 = 0 AS publishable FROM customer LEFT JOIN p ON p.model = c_custkey""")
def model_builders(spark: SparkSession, d: str) -> DataFrame:
    """UP-06."""
    k = F.col("c_custkey")
    models = table(spark, d, "customer").select(k.alias("model"), F.lit("ok").alias("status"), F.when(k % 2 == 0, "https://x.org").otherwise("note").alias("evidence_url"))
    listed = table(spark, d, "orders").select(F.col("o_custkey").alias("model"), F.col("o_orderkey").alias("ord"), (F.col("o_orderkey") % 4).alias("inst"), (F.col("o_orderkey") % 9 == 0).alias("lead"))
    return A.builders(models, listed, models.where("model % 13 = 0"))


@query("adjudicated", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 = 0 THEN 'preprint' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 8 = 0 THEN 'corrected' WHEN o_orderkey % 5 = 0 THEN 'confirmed' END AS verdict FROM orders")
def adjudicated(spark: SparkSession, d: str) -> DataFrame:
    """JN-15, UP-02."""
    k = F.col("o_orderkey")
    resolved = table(spark, d, "orders").select(k.alias("id"), F.col("o_orderstatus").alias("status"), F.when(k % 5 == 0, "confirmed").alias("verdict"))
    ruled = table(spark, d, "orders").where(k % 4 == 0).select(k.alias("id"), F.when(k % 8 == 0, "preprint").otherwise("").alias("status"), F.lit(None).cast("string").alias("verdict"))
    return A.overridden(resolved, ruled, ["status"])


@query("gate_literature", "SELECT 'literature: not a primary address' AS gate, count(*) AS n FROM part WHERE p_partkey % 6 <> 0 UNION ALL SELECT 'literature: title or date', count(*) FROM part WHERE p_partkey % 10 = 0 UNION ALL SELECT 'literature: excluded', count(*) FROM part WHERE p_size = 7")
def gate_literature(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, d, "part").select(k.alias("id"), "p_size", F.when(k % 6 == 0, "https://arxiv.org/abs/1").otherwise("https://x.org").alias("url"), F.col("p_name").alias("title"), F.when(k % 10 == 0, "24").otherwise("2024-05").alias("date"))
    notes = spark.createDataFrame([], "id long, target array<string>, finding array<string>, boundary array<string>")
    return gates.union(A.literature_gates(p, notes, p.where("p_size = 7").select("id"))).groupBy("gate").agg(F.count("*").alias("n"))


@query("name_quotes", "SELECT doc_id, regexp_extract(trim(regexp_replace(text, '\\s+', ' ', 'g')), '(?i)(.{0,90}(?:^|[^a-z0-9])(?:the)(?:[^a-z0-9].{0,89}|$))', 1) <> '' AS named FROM documents".replace("\\\\", "\\"))
def name_quotes(spark: SparkSession, d: str) -> DataFrame:
    """FN-38: whether a text has a name between word bounds."""
    return table(spark, d, "documents").select("doc_id", (V.quote_of(F.lit("the"), F.col("text")) != "").alias("named"))
