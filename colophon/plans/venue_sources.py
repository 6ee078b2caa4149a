"""Queries over records from the venue sources. Texts are made from the parts' numbers; the SQL states what each form must give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import venue_records as op
from colophon.plans.registry import query
from colophon.sources.tables import spread, table

#: Of each form: the text, and id, name, kind, track and display of its record. {Y} is a year, {W} a name.
ACL = "Association for Computational Linguistics"
BOOKS = (
    (f"Findings of the {ACL}: EMNLP {{Y}}", "", "emnlp", "EMNLP", "conference", "", "Findings of EMNLP {Y}"),
    (f"Findings of the {ACL} IJCNLP {{Y}}", "", "aacl", "AACL-IJCNLP", "conference", "", "Findings of AACL-IJCNLP {Y}"),
    (f"Proceedings of the 61st Annual Meeting of the {ACL} (Volume 1: Long Papers)", "", "acl", "ACL", "conference", "Volume 1: Long Papers", "ACL {Y}"),
    ("Proceedings of the {Y} Conference on Empirical Methods in Natural Language Processing (System Demonstrations)", "", "emnlp", "EMNLP", "conference", "System Demonstrations", "EMNLP {Y}"),
    (f"Proceedings of the {{Y}} Conference of the Nations of the Americas Chapter of the {ACL}", "", "naacl", "NAACL", "conference", "", "NAACL {Y}"),
    (f"Proceedings of the 18th Conference of the European Chapter of the {ACL} (Student Research Workshop)", "", "eacl", "EACL", "conference", "Student Research Workshop", "EACL {Y}"),
    (f"Proceedings of the 2nd Conference of the Asia-Pacific Chapter of the {ACL} (Tutorial Abstracts)", "", "aacl", "AACL-IJCNLP", "conference", "Tutorial Abstracts", "AACL-IJCNLP {Y}"),
    ("Proceedings of the 29th International Conference on Computational Linguistics", "", "coling", "COLING", "conference", "", "COLING {Y}"),
    ("Proceedings of the Thirteenth Language Resources and Evaluation Conference", "", "lrec", "LREC", "conference", "", "LREC {Y}"),
    ("Proceedings of the 27th Conference on Computational Natural Language Learning", "", "conll", "CoNLL", "conference", "", "CoNLL {Y}"),
    ("", f"Transactions of the {ACL}, Volume 9", "tacl", "TACL", "journal", "", "TACL {Y}"),
    ("", "Computational Linguistics", "cl", "Computational Linguistics", "journal", "", "Computational Linguistics {Y}"),
    ("Proceedings of the 1st Workshop on {W} for Music and Audio (NLP4MusA {Y})", "", "", "NLP4MusA", "workshop", "", "NLP4MusA {Y}"),
    ("Proceedings of the {W} Seminar", "", "", "{W} Seminar", "other", "", "{W} Seminar {Y}"),
    ("The {W} Workshop (held {Y})", "", "", "The {W} Workshop (held {Y})", "workshop", "", "The {W} Workshop (held {Y})"),
)
REFS = (
    ("Proc. Interspeech {Y}, 100-104", "interspeech", "Interspeech", "conference", "", "Interspeech {Y}"),
    ("Published as a conference paper at RLC {Y}", "", "RLC", "conference", "", "RLC {Y}"),
    ("Proceedings of the {W} Society, vol. 3", "", "{W} Society, vol. 3", "conference", "", "{W} Society, vol. 3"),
    (f"Transactions of the {ACL} {{Y}}", "tacl", "TACL", "journal", "", "TACL {Y}"),
    (f"Annual Meeting of the {ACL} ({{Y}})", "acl", "ACL", "conference", "", "ACL {Y}"),
    ("Computer Speech &amp; Language, {Y}", "csl", "Computer Speech & Language", "journal", "", "Computer Speech & Language {Y}"),
    ("{W} Letters {Y}, 4", "", "{W} Letters", "conference", "", "{W} Letters {Y}"),
)
# the second text is the type; CoRR gives no record
INDEXED = (
    ("INTERSPEECH", "Conference and Workshop Papers", "interspeech", "Interspeech", "conference", "", "Interspeech {Y}"),
    ("Trans. Assoc. Comput. Linguistics", "Journal Articles", "", "Trans. Assoc. Comput. Linguistics", "journal", "", "Trans. Assoc. Comput. Linguistics {Y}"),
    ("ACL (1)", "Conference and Workshop Papers", "acl", "ACL", "conference", "", "ACL {Y}"),
    ("NIPS", "Conference and Workshop Papers", "neurips", "NIPS", "conference", "", "NIPS {Y}"),
    ("Computational Linguistics", "Journal Articles", "cl", "Computational Linguistics", "journal", "", "Computational Linguistics {Y}"),
    ("CoRR", "Informal Publications", "", "", "", "", ""),
    ("IEEE/ACM Transactions on Audio, Speech, and Language Processing", "Conference and Workshop Papers", "taslp", "IEEE/ACM TASLP", "journal", "", "IEEE/ACM TASLP {Y}"),
    ("The {W} Days", "Conference and Workshop Papers", "", "The {W} Days", "conference", "", "The {W} Days {Y}"),
)
# a comment without acceptance gives no record
SAID = (
    ("Accepted at INTERSPEECH {Y}", "interspeech", "Interspeech", "conference", "", "Interspeech {Y}"),
    ("To appear in the {Y} IEEE Spoken Language Technology Workshop", "slt", "SLT", "conference", "", "SLT {Y}"),
    ("Accepted at ICML {Y} Workshop on {W} Models (SPIGM)", "", "SPIGM", "workshop", "", "ICML {Y} SPIGM Workshop"),
    ("Accepted to NeurIPS {Y} Workshop on {W} Signals", "", "{W} Signals", "workshop", "", "NeurIPS {Y} {W} Signals Workshop"),
    ("Accepted at INTERSPEECH {Y} and as a non-archival paper in the {W} part of the ICML {Y} Workshop", "interspeech", "Interspeech", "conference", "", "Interspeech {Y}"),
    ("Accepted as ICASSP {Y} (oral)", "icassp", "ICASSP", "conference", "Oral", "ICASSP {Y} Oral"),
    ("Accepted to ACL {Y} Findings", "acl", "ACL", "conference", "", "Findings of ACL {Y}"),
    ("accepted for publication at the {W} Symposium {Y}", "", "publication at the {W} Symposium", "conference", "", "publication at the {W} Symposium {Y}"),
    ("Camera-ready version, NIPS {Y} industry track; 9 pages", "neurips", "NIPS", "conference", "Industry", "NIPS {Y} Industry"),
    ("Accepted at ISMIR {Y} late-breaking demo", "ismir", "ISMIR", "conference", "Late-Breaking Demo", "ISMIR {Y} Late-Breaking Demo"),
    ("Accepted to ICLR {Y} Workshop", "", "Workshop", "workshop", "", "ICLR {Y} Workshop Workshop"),
    ("Submitted to ICLR {Y}, accepted by its {W} reviewers", "", "", "", "", ""),
    ("18 pages, 4 figures", "", "", "", "", ""),
)
# the second text is the group's id; submissions and preprint servers give no record
GROUPS = (
    ("ICLR {Y} Poster", "ICLR.cc/{Y}/Conference", "iclr", "ICLR", "conference", "Poster", "ICLR {Y} Poster"),
    ("Submitted to ICLR {Y}", "ICLR.cc/{Y}/Conference", "", "", "", "", ""),
    ("NeurIPS {Y} Datasets and Benchmarks Track", "NeurIPS.cc/{Y}/Track", "neurips", "NeurIPS", "conference", "Datasets and Benchmarks Track", "NeurIPS {Y} Datasets and Benchmarks Track"),
    ("CoRR {Y}", "dblp.org", "", "", "", "", ""),
    ("The {W} Meeting {Y}", "{W}.org/{Y}/Meeting", "", "The {W} Meeting", "conference", "", "The {W} Meeting {Y}"),
    ("COLM {Y}", "colmweb.org/COLM/{Y}", "colm", "COLM", "conference", "", "COLM {Y}"),
)
COLS = ("venue_id", "venue_name", "venue_kind", "track", "display")
#: Year and name of a part in SQL.
_P = "p AS (SELECT p_partkey AS id, (2011 + p_partkey % 13)::VARCHAR AS y, upper(substr(t, 1, 1)) || substr(t, 2) AS w FROM (SELECT p_partkey, translate(p_partkey::VARCHAR, '0123456789', 'abcdefghij') AS t FROM part))"


def _year(n: Column) -> Column:
    return (2011 + n % 13).cast("string")


def _filled(forms: tuple, col: int, n: Column, shift: int = 0, letters: str = "abcdefghij") -> Column:
    """The form's text of each row, with its year and name, whose letters stand for the number's digits."""
    text = F.element_at(F.array(*[F.lit(f[col]) for f in forms]), ((n + shift) % len(forms) + 1).cast("int"))
    name = F.initcap(F.translate(n.cast("string"), "0123456789", letters))
    return F.replace(F.replace(text, F.lit("{Y}"), _year(n)), F.lit("{W}"), name)


def _cell(forms: tuple, col: int, shift: int = 0) -> str:
    cells = ", ".join("'" + f[col].replace("'", "''") + "'" for f in forms)
    return f"replace(replace([{cells}][(id + {shift}) % {len(forms)} + 1], '{{Y}}', y), '{{W}}', w)"


def _expected(forms: tuple, first: int, shift: int = 0) -> str:
    """SQL of the records that the forms give; a form without a display gives none."""
    cells = ", ".join(f"{_cell(forms, first + k, shift)} AS {c}" for k, c in enumerate(COLS))
    return f"SELECT * FROM (SELECT id, {cells} FROM p) WHERE display <> ''"


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "part").select(F.col("p_partkey").alias("id")), "id")


def _with_second(hits: DataFrame, **other: Column) -> DataFrame:
    """hits at place 1 and, before or behind it in the table, another hit at place 2 that mustn't count."""
    return hits.withColumn("ord", F.lit(1)).unionByName(hits.withColumns(other).withColumn("ord", F.lit(2)))


def anthology_hits(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("id")
    said = F.concat(_filled(BOOKS, 0, n), _filled(BOOKS, 1, n))
    rows = _parts(spark, d).select("id", _filled(BOOKS, 0, n).alias("booktitle"), _filled(BOOKS, 1, n).alias("journal"), F.when(~F.contains(said, _year(n)), _year(n)).alias("year"), F.lit("https://aclanthology.org/x").alias("url"), F.lit("").alias("doi"))
    return _with_second(rows, booktitle=F.lit("Another Book"))


def journal_refs(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("id")
    return _parts(spark, d).select("id", _filled(REFS, 0, n).alias("journal_ref"), F.lit("2501.00001").alias("paper"))


def dblp_hits(spark: SparkSession, d: str) -> DataFrame:
    n, no = F.col("id"), F.lit(None).cast("string")
    rows = _parts(spark, d).select("id", _filled(INDEXED, 0, n).alias("venue"), _filled(INDEXED, 1, n).alias("type"), _year(n).alias("year"), F.lit(True).alias("title_exact"), F.lit("conf/x").alias("key"), no.alias("ee"), no.alias("url"), no.alias("doi"))
    return _with_second(rows, venue=F.lit("INTERSPEECH"), title_exact=F.lit(False))


def comments(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select("id", _filled(SAID, 0, F.col("id")).alias("comment"), F.lit("2501.00001").alias("paper"))


def openreview_hits(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("id")
    rows = _parts(spark, d).select("id", _filled(GROUPS, 0, n).alias("venue"), _filled(GROUPS, 1, n).alias("venueid"), F.lit(False).alias("mirror"), F.lit(True).alias("decided"), F.lit("https://openreview.net/x").alias("url"))
    return _with_second(rows, venue=F.lit("ICLR 2020"), mirror=F.lit(True))


_RECORDS = ("id", *COLS)


@query("anthology_records", f"WITH {_P} {_expected(BOOKS, 2)}")
def anthology_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51: journals, Findings, proceedings with their tracks, workshops by acronym, other books by title."""
    return op.from_anthology(anthology_hits(spark, d)).select(*_RECORDS)


@query("journal_ref_records", f"WITH {_P} {_expected(REFS, 1)}")
def journal_ref_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51."""
    return op.from_journal_ref(journal_refs(spark, d)).select(*_RECORDS)


@query("dblp_records", f"WITH {_P} {_expected(INDEXED, 2)}")
def dblp_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51: exact titles outside CoRR only."""
    return op.from_dblp(dblp_hits(spark, d)).select(*_RECORDS)


@query("comment_records", f"WITH {_P} {_expected(SAID, 1)}")
def comment_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51: claims of acceptance, workshops only right behind the venue's name."""
    return op.from_comment(comments(spark, d)).select(*_RECORDS)


@query("group_records", f"WITH {_P} {_expected(GROUPS, 2)}")
def group_records(spark: SparkSession, d: str) -> DataFrame:
    """FN-51: OpenReview records named by the group's id."""
    return op.from_openreview(openreview_hits(spark, d)).select(*_RECORDS)


# which entries each source knows, and its expected rows; a source's id is its place in the cascade
_KNOWN = (("acl_anthology", "id % 7 = 0"), ("isca_archive", "id % 5 = 0"), ("publisher", "id % 4 = 0"), ("openreview", "id % 3 = 0"), ("arxiv_journal_ref", "id % 11 < 3"), ("dblp", "id % 2 = 0"), ("arxiv_comment", "true"))
_ISCA = "SELECT id, 'interspeech' AS venue_id, 'Interspeech' AS venue_name, 'conference' AS venue_kind, '' AS track, 'Interspeech ' || y AS display FROM p"
_CROSSREF = "SELECT id, 'kdd' AS venue_id, 'KDD' AS venue_name, 'conference' AS venue_kind, '' AS track, 'KDD ' || y AS display FROM p"
_ROWS = (_expected(BOOKS, 2), _ISCA, _CROSSREF, _expected(GROUPS, 2), _expected(REFS, 1), _expected(INDEXED, 2), _expected(SAID, 1))
_ALL = " UNION ALL ".join(f"SELECT {k} AS place, '{name}' AS evidence_source, * FROM ({rows}) WHERE {cond}" for k, ((name, cond), rows) in enumerate(zip(_KNOWN, _ROWS, strict=True)))


def _sources(spark: SparkSession, d: str) -> list[DataFrame]:
    n, no = F.col("id"), F.lit("")
    isca = _parts(spark, d).select("id", F.lit(1).alias("ord"), F.concat(F.lit("Interspeech "), _year(n)).alias("event"), F.lit("T").alias("title"), no.alias("url"))
    crossref = _parts(spark, d).select("id", F.lit(1).alias("ord"), F.lit("proceedings-article").alias("type"), F.concat(F.lit("Conference on Knowledge Discovery and Data Mining "), _year(n)).alias("container"), no.alias("event"), no.alias("year"), F.lit("T").alias("title"), no.alias("doi"), no.alias("url"))
    made: list[tuple[Callable, DataFrame]] = [(op.from_anthology, anthology_hits(spark, d)), (op.from_isca, isca), (op.from_crossref, crossref), (op.from_openreview, openreview_hits(spark, d)), (op.from_journal_ref, journal_refs(spark, d)), (op.from_dblp, dblp_hits(spark, d)), (op.from_comment, comments(spark, d))]
    return [record(rows.where(cond)) for (record, rows), (_, cond) in zip(made, _KNOWN, strict=True)]


@query("venue_records", f"""WITH {_P}, r AS ({_ALL}), b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) = 1)
 SELECT p.id, coalesce(evidence_source, 'arxiv') AS evidence_source, {', '.join(f"coalesce({c}, '') AS {c}" for c in COLS)}, CASE coalesce(evidence_source, 'arxiv') WHEN 'arxiv' THEN 'preprint' WHEN 'arxiv_comment' THEN 'accepted' ELSE 'published' END AS status FROM p LEFT JOIN b ON b.id = p.id""")
def venue_records(spark: SparkSession, d: str) -> DataFrame:
    """JN-13: the record of the first of eight sources (the last is the preprint itself)."""
    return op.resolved(comments(spark, d), _sources(spark, d)).select("id", "evidence_source", *COLS, "status")


_FAMILIES = (("Proceedings of Interspeech {Y}", "interspeech"), ("Conference on Acoustics, Speech and Signal Processing of {W}", "icassp"), ("The {W} Gathering", ""), ("Neural Information Processing Systems {Y}", "neurips"), (f"Transactions of the {ACL}, {{W}}", "tacl"), ("EMNLP {Y} ({W})", "emnlp"))
_OTHERS = ("acl_anthology", "crossref", "openreview", "dblp", "semantic_scholar", "openalex", "arxiv_journal_ref")
#: Letters for digits that spell no family: with a to j, 89208 is "ijcai".
_NEUTRAL = "bfghkqvwxz"
_USED = ("acl_anthology", "publisher", "openreview", "dblp", "arxiv_comment")
_LIST = lambda x: "[" + ", ".join(f"'{v}'" for v in x) + "]"


@query("family_agreement", f"""WITH f AS (SELECT p_partkey AS id, {_LIST(f for _, f in _FAMILIES)} AS fam, {_LIST(_USED)}[p_partkey % 5 + 1] AS used FROM part),
 o AS (SELECT id, s.n, {_LIST(_OTHERS)}[s.n + 1] AS source, fam[(id + s.n * (id % 4)) % 6 + 1] AS theirs, fam[id % 6 + 1] AS own, used FROM f, (SELECT unnest(range(7)) AS n) s WHERE (id + s.n) % 3 <> 0)
 SELECT id, coalesce(string_agg(source, ',' ORDER BY source) FILTER (own = theirs), '') AS agree, coalesce(string_agg(source, ',' ORDER BY source) FILTER (own <> theirs), '') AS disagree
 FROM o WHERE own <> '' AND theirs <> '' AND CASE source WHEN 'crossref' THEN 'publisher' ELSE source END <> used GROUP BY 1""")
def family_agreement(spark: SparkSession, d: str) -> DataFrame:
    """JN-14: seven other sources against the record's family."""
    n, no = F.col("id"), F.lit("")
    parts = _parts(spark, d)
    text = lambda forms: _filled(forms, 0, n, letters=_NEUTRAL)
    at = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))
    records = parts.select("id", at(_USED, n % 5).alias("evidence_source"), F.when(n % 2 == 0, text(_FAMILIES)).otherwise("").alias("display"), text(_FAMILIES).alias("venue_full"), no.alias("venue_name"))
    others = parts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(6)))).where("(id + s) % 3 <> 0")
    shift = F.col("s") * (n % 4)
    others = others.select("id", at(_OTHERS, F.col("s")).alias("source"), F.element_at(F.array(*[text(((t, f),)) for t, f in _FAMILIES]), ((n + shift) % 6 + 1).cast("int")).alias("text"))
    found = op.family_agreement(records, others)
    return found.select("id", F.array_join("agree", ",").alias("agree"), F.array_join("disagree", ",").alias("disagree"))
