"""Parsers of harvested text: feeds, bibliographies, HTML. All are built-in expressions; connectors are not part of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import textnorm as T

_FEED = "STRUCT<entry: ARRAY<STRUCT<id: STRING, title: STRING, summary: STRING, published: STRING, author: ARRAY<STRUCT<name: STRING>>, primary_category: STRUCT<_term: STRING>>>>"


def atom_entries(feeds: DataFrame, xml: str = "value", most_authors: int = 8) -> DataFrame:
    """SRC-07, SRC-08: entries of Atom feeds: id, version, title, abstract, published, authors, primary_category, url."""
    body = F.regexp_replace(F.col(xml), "(</?)arxiv:", "$1")
    e = feeds.select(F.explode(F.from_xml(body, _FEED, {"rowTag": "feed"})["entry"]).alias("e")).select("e.*")
    number = F.regexp_extract("id", r"abs/([^v]+)v([0-9]+)", 1)
    return e.where(number != "").select(
        number.alias("id"), F.regexp_extract("id", r"abs/([^v]+)v([0-9]+)", 2).cast("int").alias("version"), T.squeeze(F.col("title")).alias("title"),
        T.squeeze(F.col("summary")).alias("abstract"), T.or_empty(F.col("published")).alias("published"),
        F.slice(F.transform("author", lambda a: a["name"]), 1, most_authors).alias("authors"),
        T.or_empty(F.col("primary_category._term")).alias("primary_category"), F.concat(F.lit("https://arxiv.org/abs/"), number).alias("url"),
    )


def oai_records(pages: DataFrame, xml: str = "value") -> DataFrame:
    """SRC-10: records of OAI-PMH pages, the resumption token, and an error code (noRecordsMatch is an empty page, others are for a gate)."""
    body = F.col(xml)
    ids = F.regexp_extract_all(body, F.lit(r"(?s)<record>.*?<identifier>([^<]*)</identifier>.*?</record>"), F.lit(1))
    return pages.select(ids.alias("ids"), F.nullif(F.regexp_extract(body, r"<resumptionToken[^>]*>([^<]+)</resumptionToken>", 1), F.lit("")).alias("token"), F.nullif(F.regexp_extract(body, r'<error code="([^"]+)"', 1), F.lit("")).alias("error"))


def bibtex(spark: SparkSession, path: str) -> DataFrame:
    """SRC-18: type, key, fields (map) of a BibTeX file (gzip or not); values may continue over lines."""
    raw = spark.read.option("lineSep", "\n@").text(path)
    return bibtex_entries(raw)


def bibtex_entries(raw: DataFrame, col: str = "value") -> DataFrame:
    entry = F.regexp_replace(F.col(col), r"^\s*@", "")
    kind, key = F.regexp_extract(entry, r"^(\w+)\{\s*([^,\s]+)\s*,", 1), F.regexp_extract(entry, r"^(\w+)\{\s*([^,\s]+)\s*,", 2)
    pattern = r"(?s)(?:^|,)\s*([\w-]+)\s*=\s*(\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}|\"[^\"]*\"|[\w.-]+)"
    body = F.regexp_replace(entry, r"^(\w+)\{\s*([^,\s]+)\s*,", "")
    names, values = (F.regexp_extract_all(body, F.lit(pattern), F.lit(k)) for k in (1, 2))
    plain = F.transform(values, lambda v: T.squeeze(F.regexp_replace(v, r"(?s)^[{\"](.*)[}\"]$", "$1")))
    fields = F.map_from_entries(F.arrays_zip(F.transform(names, lambda n: F.lower(n)), plain))
    return raw.select(F.lower(kind).alias("type"), key.alias("key"), fields.alias("fields")).where("key <> ''")


def html_links(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """SRC-19: id, pos, href, title of each link with text."""
    pattern = F.lit(r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>')
    href, title = (F.regexp_extract_all(F.col(html), pattern, F.lit(k)) for k in (1, 2))
    rows = pages.select(id_col, F.posexplode(F.arrays_zip(href.alias("href"), title.alias("title"))).alias("pos", "x"))
    return rows.select(id_col, "pos", "x.href", T.squeeze(F.regexp_replace("x.title", "<[^>]+>", " ")).alias("title")).where("title <> ''")


#: Tags that end a line, and the references that are decoded (& last).
_BLOCK = "p|div|section|article|header|footer|nav|aside|main|h[1-6]|ul|ol|li|br|figure|figcaption|blockquote|pre|hr|form|dl|dt|dd"
_REFS = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def flatten_html(html: Column) -> Column:
    """SRC-20: HTML as text that keeps tables: [TABLE] and [/TABLE], "ROW: " for each row, " | " for each cell."""
    s = F.regexp_replace(T.or_empty(html), r"(?is)<(script|style|noscript)\b[^>]*>.*?</(script|style|noscript)>", " ")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    for pattern, put in ((r"(?i)<table\b[^>]*>", "\n[TABLE]\n"), (r"(?i)</table>", "\n[/TABLE]\n"), (r"(?i)<tr\b[^>]*>", "\nROW: "), (r"(?i)<t[dh]\b[^>]*>", " | "), (rf"(?i)</?({_BLOCK})\b[^>]*>", "\n"), (r"<[^>]*>", "")):
        s = F.regexp_replace(s, pattern, put)
    for a, b in _REFS:
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"[ \t]+", " "), r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def flatten_html_sql(html: str) -> str:
    """The same in DuckDB's SQL."""
    s = rf"regexp_replace({html}, '(?is)<(script|style|noscript)\b[^>]*>.*?</(script|style|noscript)>', ' ', 'g')"
    s = rf"regexp_replace({s}, '(?s)<!--.*?-->', ' ', 'g')"
    for pattern, put in ((r"(?i)<table\b[^>]*>", "chr(10) || '[TABLE]' || chr(10)"), (r"(?i)</table>", "chr(10) || '[/TABLE]' || chr(10)"), (r"(?i)<tr\b[^>]*>", "chr(10) || 'ROW: '"), (r"(?i)<t[dh]\b[^>]*>", "' | '"), (rf"(?i)</?({_BLOCK})\b[^>]*>", "chr(10)"), (r"<[^>]*>", "''")):
        s = f"regexp_replace({s}, '{pattern}', {put}, 'g')"
    for a, b in _REFS:
        s = f"replace({s}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')"
    return rf"regexp_replace(regexp_replace(regexp_replace({s}, '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"


def good_enough(html: Column, text: Column, raw: int = 3000, flat: int = 4000) -> Column:
    """SRC-21: the page is long enough, isn't the notice of a missing version, and gives enough text."""
    return (F.length(html) >= raw) & ~F.substring(html, 1, 4000).contains("No HTML for") & (F.length(text) > flat)


def month_windows(spark: SparkSession, first: str, last: str) -> DataFrame:
    """SRC-27: month, from, to (the next month's first day) from yyyy-MM to yyyy-MM, both included."""
    months = spark.range(1).select(F.explode(F.sequence(F.lit(f"{first}-01").cast("date"), F.lit(f"{last}-01").cast("date"), F.expr("interval 1 month"))).alias("d"))
    return months.select(F.date_format("d", "yyyy-MM").alias("month"), F.date_format("d", "yyyyMMdd").alias("from"), F.date_format(F.add_months("d", 1), "yyyyMMdd").alias("to"))


def query_windows(templates: DataFrame, windows: DataFrame) -> DataFrame:
    """SRC-28: each template (q, template) for each month; both sides are short lists by nature."""
    clause = F.concat(F.lit("submittedDate:["), "from", F.lit("0000 TO "), "to", F.lit("0000]"))
    return templates.join(windows, F.lit(True)).select("q", "month", F.replace("template", F.lit("{D}"), clause).alias("query"))
