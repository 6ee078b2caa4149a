"""Queries over text normalisation, scoring and title matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import scoring as S
from colophon.functions import textnorm as T
from colophon.operators.match import best_matches
from colophon.operators.pool import numbered_in
from colophon.plans.registry import query
from colophon.plans.views import PAPERS, papers, with_views
from colophon.sources.tables import table

NORM = "trim(regexp_replace(lower(regexp_replace({0}, '[{{}}\\\\]', '', 'g')), '[^a-z0-9]+', ' ', 'g'))"
WORDS = f"list_filter(string_split({NORM}, ' '), lambda x: x <> '')"
STOPS = "[" + ", ".join(f"'{w}'" for w in T.STOP) + "]"
STEM = "CASE " + " ".join(f"WHEN x LIKE '%{s}' AND length(x) > {len(s) + 3} THEN left(x, length(x) - {len(s)})" for s in T.SUFFIXES) + " ELSE x END"
TOKENS = "list_distinct(list_transform(list_filter(" + WORDS + f", lambda x: length(x) > 2 AND NOT list_contains({STOPS}, x)), lambda x: {STEM}))"


@query("norm_titles", with_views(PAPERS) + f" SELECT id, {NORM.format('title')} AS norm FROM v_papers")
def norm_titles(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d).select("id", T.norm(F.col("title")).alias("norm"))


@query("title_tokens", with_views(PAPERS) + f" SELECT id, array_to_string(list_sort({TOKENS.format('title')}), ' ') AS tokens FROM v_papers")
def title_tokens(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d).select("id", F.array_join(F.array_sort(T.tokens(F.col("title"))), " ").alias("tokens"))


@query("token_jaccard", with_views(PAPERS, f"t AS (SELECT id, {TOKENS.format('abstract')} AS t FROM v_papers)", "p AS (SELECT a.id, len(list_intersect(a.t, b.t)) AS i, len(a.t) AS x, len(b.t) AS y FROM t a JOIN t b ON b.id = a.id + 1)") + " SELECT id, CASE WHEN x = 0 OR y = 0 THEN 0 ELSE round(i / least(x, y), 9) END AS containment, CASE WHEN x = 0 OR y = 0 THEN 0 ELSE round(i / (x + y - i), 9) END AS jaccard FROM p")
def token_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Each paper with the next one."""
    t = papers(spark, d).select("id", T.tokens(F.col("abstract")).alias("t"))
    pairs = t.join(t.select((F.col("id") - 1).alias("id"), F.col("t").alias("u")), "id")
    return pairs.select("id", F.round(T.containment(F.col("t"), F.col("u")), 9).alias("containment"), F.round(T.jaccard(F.col("t"), F.col("u")), 9).alias("jaccard"))


@query("heads_surnames", with_views(PAPERS, f"h AS (SELECT id, title, {NORM.format('split_part(title, chr(44), 1)')} AS h FROM v_papers)") + f" SELECT id, CASE WHEN length(h) <= 40 THEN h ELSE '' END AS head, coalesce(list_extract({WORDS.format('split_part(title, chr(44), 1)')}, -1), '') AS surname FROM h")
def heads_surnames(spark: SparkSession, d: str) -> DataFrame:
    """Commas stand for colons, which these titles lack."""
    t = F.col("title")
    return papers(spark, d).select("id", T.head(F.replace(t, F.lit(","), F.lit(":"))).alias("head"), T.surname(t).alias("surname"))


@query("keys_and_slugs", with_views(PAPERS) + r""" SELECT id, regexp_replace(lower(title), '[^a-z0-9]', '', 'g') AS key, regexp_replace(lower(title), '[^a-z0-9&]', '', 'g') AS venue_key,
  left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 48) AS slug,
  replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM v_papers""")
def keys_and_slugs(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    escaped = F.replace(F.replace(T.html_escape(t), F.lit("&quot;"), F.lit('"')), F.lit("&#39;"), F.lit("'"))
    return papers(spark, d).select("id", T.key(t).alias("key"), T.venue_key(t).alias("venue_key"), T.slug(t).alias("slug"), escaped.alias("escaped"))


@query("ascii_slugs", with_views(PAPERS) + r""" SELECT id, left(regexp_replace(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 48) AS slug FROM v_papers""")
def ascii_slugs(spark: SparkSession, d: str) -> DataFrame:
    """FN-16: slugs of titles without marks."""
    return papers(spark, d).select("id", T.slug(T.ascii_fold(F.lower("title"))).alias("slug"))


_SLUGS = r"s AS (SELECT id, left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 24) AS base FROM v_papers)"


@query("unique_slugs", with_views(PAPERS, _SLUGS, "n AS (SELECT id, base, row_number() OVER (PARTITION BY base ORDER BY id) AS k FROM s)") + " SELECT id, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS slug FROM n")
def unique_slugs(spark: SparkSession, d: str) -> DataFrame:
    """FN-17: a slug that occurred before gets -2, -3 and so on, in order."""
    s = papers(spark, d).select("id", T.slug(F.col("title"), 24).alias("base"))
    return numbered_in(s, "base", ["id"], "k").select("id", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("k").cast("string"))).alias("slug"))


#: A profile for the generated prose, whose words are those of no language.
PROSE = S.Profile(model=("tion", "the ", "eau"), bench=("ment", "ung", "ción", " of "), negative=("idiot", "licensed", "###"), hints=("the", "le"), name="[A-Z][a-z]*ion[ .]")


@query("score_docs", with_views(PAPERS) + f" SELECT id, {S.relevance_sql(PROSE, 'title', 'abstract')} AS score FROM v_papers")
def score_docs(spark: SparkSession, d: str) -> DataFrame:
    """FN-32."""
    return papers(spark, d).select("id", S.relevance(F.col("title"), F.col("abstract"), PROSE).alias("score"))


_REASON = {"modality": S.any_of(["the", "le", "der", "el"]), "signal": S.any_of(["of", "de", "und"]), "hard": S.any_of(["with", "pour", "mit"]), "general": S.any_of(["for", "que", "nicht"])}


@query("drop_reasons", with_views(PAPERS, f"""r AS (SELECT CASE WHEN {S.relevance_sql(PROSE, 'title', 'abstract')} < 18 THEN 'low_score'
  WHEN NOT regexp_matches(lower(abstract), '{_REASON['modality']}') THEN 'no_modality' WHEN NOT regexp_matches(lower(abstract), '{_REASON['signal']}') THEN 'no_signal'
  WHEN regexp_matches(lower(abstract), '{_REASON['hard']}') AND NOT regexp_matches(lower(abstract), '{_REASON['general']}') THEN 'hard_drop' ELSE 'kept' END AS reason FROM v_papers)""") + " SELECT reason, count(*) AS n FROM r GROUP BY 1")
def drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    """FIL-01, FIL-03: the recall filter's counters."""
    score = S.relevance(F.col("title"), F.col("abstract"), PROSE)
    reason = F.coalesce(S.drop_reason(score, F.col("abstract"), 18, **_REASON), F.lit("kept"))
    return papers(spark, d).select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


_PEOPLE = "list_filter([w[1] || ' ' || w[2], w[3] || ' ' || w[4], w[5] || ' ' || w[6]], lambda x: x IS NOT NULL)"
_SIDE = f"""side AS (SELECT id, title, {NORM.format('title')} AS n, {TOKENS.format('title')} AS t, {NORM.format('split_part(title, chr(58), 1)')} AS h0,
  list_distinct(list_transform(list_filter({_PEOPLE}, lambda p: len(list_distinct(string_split(p, ' '))) >= 2), lambda p: array_to_string(list_sort(list_distinct(string_split(p, ' '))), ' '))) AS f
  FROM (SELECT id, title, list_filter({WORDS.format('abstract')}, lambda x: length(x) >= 4)[-6:] AS w FROM v_papers))"""


@query("blocked_match", with_views(PAPERS, _SIDE, """
a AS (SELECT *, CASE WHEN length(h0) <= 40 THEN h0 ELSE '' END AS h FROM side WHERE id % 2 = 0), b AS (SELECT *, CASE WHEN length(h0) <= 40 THEN h0 ELSE '' END AS h FROM side WHERE id % 2 = 1),
same AS (SELECT a.id, min(b.id) AS rec FROM a JOIN b ON a.n = b.n WHERE a.n <> '' GROUP BY 1),
rest AS (SELECT * FROM a WHERE id NOT IN (SELECT id FROM same)),
pairs AS (SELECT DISTINCT x.id, y.id AS rec FROM (SELECT id, unnest(f) AS k FROM rest) x JOIN (SELECT id, unnest(f) AS k FROM b) y USING (k)),
v AS (SELECT pairs.id, rec, rest.h AS ah, b.h AS bh, len(list_intersect(rest.t, b.t)) AS i, len(rest.t) AS x, len(b.t) AS y, len(list_intersect(rest.f, b.f)) AS fo, least(len(rest.f), len(b.f)) AS fm
      FROM pairs JOIN rest ON pairs.id = rest.id JOIN b ON pairs.rec = b.id),
s AS (SELECT *, i / least(x, y) AS cont, i / (x + y - i) AS jac, greatest(i / least(x, y), i / (x + y - i)) AS sim, fo / fm AS ff FROM v WHERE x >= 3 AND y >= 3),
m AS (SELECT id, rec, CASE WHEN ah <> '' AND ah = bh AND cont >= 0.5 THEN 'fuzzy' WHEN cont >= 0.75 AND jac >= 0.6 THEN 'fuzzy' WHEN fo >= 4 AND ff >= 0.9 THEN 'weak' END AS kind,
             CASE WHEN ah <> '' AND ah = bh AND cont >= 0.5 THEN greatest(sim, 0.8) ELSE sim END AS score
      FROM s WHERE (fo >= 2 AND ff >= 0.5) OR ff >= 0.75)
""") + """
SELECT id, rec, 'exact' AS kind, 1.0::DOUBLE AS score FROM same
UNION ALL SELECT id, rec, kind, score::DOUBLE FROM (SELECT * FROM m WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE kind WHEN 'fuzzy' THEN 2 ELSE 1 END DESC, score DESC, rec) = 1)""")
def blocked_match(spark: SparkSession, d: str) -> DataFrame:
    """JN-11: papers with even ids against those with odd ones; pairs of the last long words of a text stand for its authors."""
    w = F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), 6), F.filter(T.words(F.col("abstract")), lambda x: F.length(x) >= 4)), -6, 6)
    pair = lambda i: F.concat(F.get("w", F.lit(i)), F.lit(" "), F.get("w", F.lit(i + 1)))
    side = papers(spark, d).select("id", "title", F.filter(w, lambda x: x.isNotNull()).alias("w")).select("id", "title", F.filter(F.array(pair(0), pair(2), pair(4)), lambda x: x.isNotNull()).alias("authors"))
    records = side.where("id % 2 = 1").select(F.col("id").alias("rec"), F.col("title").alias("rec_title"), F.col("authors").alias("rec_authors"))
    return best_matches(side.where("id % 2 = 0"), records)


@query("years_and_numbers", r"""SELECT p_partkey AS id, nullif(regexp_extract(t, '([0-9]{4}\.[0-9]{4,5})', 1), '') AS paper, coalesce(nullif(regexp_extract(t, '(^|[^0-9A-Za-z_])((19|20)[0-9]{2})($|[^0-9A-Za-z_])', 2), ''), nullif(regexp_extract(t, '(^|[^0-9])((19|20)[0-9]{2})($|[^0-9])', 2), '')) AS year
FROM (SELECT p_partkey, p_name || ' ' || (1900 + p_partkey % 150) || 'x v' || (2000 + p_partkey % 40) || '.' || (10000 + p_partkey % 999) AS t FROM part)""")
def years_and_numbers(spark: SparkSession, d: str) -> DataFrame:
    """FN-12, FN-20."""
    p = F.col("p_partkey")
    t = F.concat(F.col("p_name"), F.lit(" "), (1900 + p % 150).cast("string"), F.lit("x v"), (2000 + p % 40).cast("string"), F.lit("."), (10000 + p % 999).cast("string"))
    return table(spark, d, "part").select(p.alias("id"), T.paper_number(t).alias("paper"), T.year_of(t).alias("year"))


@query("batch_text", with_views(PAPERS) + " SELECT id, '[' || id || '] ' || title || chr(10) || CASE WHEN length(abstract) > 1400 THEN left(abstract, 1400) || ' …' ELSE abstract END AS entry FROM v_papers")
def batch_text(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05: the rendered entry of a reading batch."""
    return papers(spark, d).select("id", F.concat(F.lit("["), F.col("id").cast("string"), F.lit("] "), F.col("title"), F.lit("\n"), T.shortened(F.col("abstract"), 1400)).alias("entry"))
