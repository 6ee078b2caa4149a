"""Validation gates: constraints as queries that give violations (gate, id, detail); a build raises before anything is written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """Violations were found; nothing has been written."""


def violation(df: DataFrame, gate: str, failing: Column, id_col: str = "id", detail: Column | None = None) -> DataFrame:
    return df.where(failing).select(F.lit(gate).alias("gate"), F.col(id_col).cast("string").alias("id"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing(c: Column) -> Column:
    """Null, absent and empty are missing; 0 is a value."""
    return F.coalesce(c.cast("string"), F.lit("")) == ""


def registry_gates(df: DataFrame, name: str, required: list[str], id_pattern: str = "^[a-z0-9][a-z0-9-]*$", date: str | None = None, url: str | None = None) -> list[DataFrame]:
    """GT-01: required keys, unique ids, the forms of ids, partial dates and addresses."""
    parts = [violation(df, f"{name}: missing {c}", missing(F.col(c))) for c in required]
    parts.append(violation(df.groupBy("id").count(), f"{name}: duplicate id", F.col("count") > 1))
    parts.append(violation(df, f"{name}: id form", ~F.coalesce(F.col("id").rlike(id_pattern), F.lit(False))))
    if date:
        parts.append(violation(df, f"{name}: date form", ~missing(F.col(date)) & ~F.col(date).rlike(r"^\d{4}-\d{2}(-\d{2})?$"), detail=F.col(date)))
    if url:
        parts.append(violation(df, f"{name}: url scheme", ~missing(F.col(url)) & ~F.col(url).rlike("^https?://"), detail=F.col(url)))
    return parts


def cell_reasons(cells: DataFrame, benchmarks: DataFrame, models: DataFrame) -> DataFrame:
    """GT-02, JN-01: bad cells with their first failing reason, in order: unknown benchmark, unknown model, empty value, metric, source."""
    b, m = benchmarks.select(F.col("id").alias("benchmark"), F.lit(True).alias("_b")).distinct(), models.select(F.col("id").alias("model"), F.lit(True).alias("_m")).distinct()
    rows = cells.join(b, "benchmark", "left").join(m, "model", "left")
    reason = (
        F.when(F.col("_b").isNull(), "unknown benchmark").when(F.col("_m").isNull(), "unknown model").when(missing(F.col("value")), "empty value")
        .when(missing(F.col("metric")), "missing metric").when(missing(F.col("source")), "missing source")
    )
    return rows.withColumn("reason", reason).where("reason is not null").drop("_b", "_m")


def venue_gates(v: DataFrame) -> list[DataFrame]:
    """GT-04: records (id, status, venue, display, evidence_url, year, publishable)."""
    claimed = F.col("status").isin("published", "accepted")
    return [
        violation(v, "venue: status", ~F.col("status").isin("published", "accepted", "preprint", "unclear"), detail=F.col("status")),
        violation(v, "venue: claimed without venue or display", claimed & (missing(F.col("venue")) | missing(F.col("display")))),
        violation(v, "venue: publishable claim without url", claimed & F.col("publishable") & missing(F.col("evidence_url"))),
        violation(v, "venue: preprint with venue", (F.col("status") == "preprint") & ~missing(F.col("venue"))),
        violation(v, "venue: year", ~missing(F.col("year")) & ~F.col("year").rlike(r"^\d{4}$"), detail=F.col("year")),
    ]


def geo_gates(sites: DataFrame, occ: DataFrame) -> list[DataFrame]:
    """GT-03: sites (id, country, lat, lon) and occurrences (id, lead)."""
    return [
        violation(sites, "geo: country code", ~F.coalesce(F.col("country").rlike("^[A-Z]{2}$"), F.lit(False)), detail=F.col("country")),
        violation(sites, "geo: half a coordinate", F.col("lat").isNull() != F.col("lon").isNull()),
        violation(sites, "geo: range", ~(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))),
        violation(occ.groupBy("id").agg(F.count_if("lead").alias("leads")), "geo: several leads", F.col("leads") > 1),
    ]


def affiliation_gates(records: DataFrame, entries: DataFrame, institutions: DataFrame) -> list[DataFrame]:
    """GT-03: records (id, publishable, countries_complete, verified, verify_note, status, institutions) of entries (id) against the
    institutions (id). Each of a record's institutions has inst, lead, country, countries, placed, lat, lon.
    """
    occ = records.select("id", F.explode_outer("institutions").alias("a")).select("id", "a.*")
    occ_there = occ.where("inst is not null")
    p, v = F.coalesce("publishable", F.lit(False)), F.col("verified")
    code = lambda c: F.coalesce(c.rlike("^[A-Z]{2}$"), F.lit(False))
    of = lambda df, ref, c: df.join(ref.select(F.col("id").alias(c)).distinct(), c, "left_anti")
    lists = F.coalesce(F.size("countries"), F.lit(-1)) >= 0
    return [
        violation(of(records.withColumn("entry", F.col("id")), entries, "entry"), "affiliations: unknown entry", F.lit(True)),
        violation(records, "affiliations: no publishable flag", F.col("publishable").isNull()),
        violation(records, "affiliations: no countries_complete flag", F.col("countries_complete").isNull()),
        violation(occ.groupBy("id").agg(F.count_if("lead").alias("leads")), "affiliations: several leads", F.col("leads") > 1),
        violation(records, "affiliations: publishable without institutions", p & (F.coalesce(F.size("institutions"), F.lit(0)) < 1)),
        violation(records, "affiliations: publishable, not verified", p & ~F.coalesce(v.isin("confirmed", "corrected"), F.lit(False)), detail=v),
        violation(records, "affiliations: publishable without text", p & (F.col("status") == "no_affiliation_text")),
        violation(records, "affiliations: corrected without a reason", p & (v == "corrected") & missing(F.col("verify_note"))),
        violation(of(occ_there, institutions, "inst"), "affiliations: unknown institution", F.lit(True), detail=F.col("inst")),
        violation(occ_there, "affiliations: country code", ~missing(F.col("country")) & ~code(F.col("country")), detail=F.col("country")),
        violation(occ_there, "affiliations: countries", lists & ((F.size("countries") == 0) | F.exists("countries", lambda c: ~code(c)) | ~missing(F.col("country")))),
        violation(occ_there, "affiliations: unplaced with coordinates", (F.col("placed") == "unplaced") & (F.col("lat").isNotNull() | F.col("lon").isNotNull())),
        violation(occ_there, "affiliations: half a coordinate", F.col("lat").isNull() != F.col("lon").isNull()),
        violation(occ_there, "affiliations: range", ~(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))),
    ]


def uncovered(catalogue: DataFrame, records: DataFrame, gate: str) -> DataFrame:
    """GT-09: a warning for each entry without a record."""
    return violation(catalogue.join(records.select("id"), "id", "left_anti"), gate, F.lit(True))


def require(violations: DataFrame, show: int = 25) -> None:
    """SNK-14: raises if there is a violation, naming the first of them in order."""
    found = violations.orderBy("gate", "id").limit(show).collect()
    if found:
        raise GateError("; ".join(f"{r['gate']}: {r['id']}" + (f" ({r['detail']})" if r["detail"] else "") for r in found))


def verdict(r: dict[str, Column]) -> Column:
    """GT-11: the second read of a venue claim, the first rule that holds."""
    return (
        F.when(r["year"] < r["preprint_year"], "cannot_verify").when(r["promoted"], "confirmed").when(r["page_kind"] == "spa", F.when(r["agree"] > 0, "confirmed").otherwise("cannot_verify"))
        .when(r["page_kind"] == "error", "cannot_verify").when(r["disagree"] > 0, "cannot_verify")
        .when((r["status"] == "preprint") & (r["named"] > 0), "cannot_verify").when((r["agree"] > 0) | (r["page_hit"] >= 0.6), "confirmed").otherwise("cannot_verify")
    )


def audit(v: DataFrame, as_of_year: int) -> DataFrame:
    """GT-10, AG-32: findings (gate, id, detail, severity) over venue records (id, status, display, year, preprint_year, comment, url)."""
    year, pre = F.col("year").try_cast("int"), F.col("preprint_year").try_cast("int")
    accepted, submitted = F.col("comment").rlike("(?i)accepted|to appear"), F.col("comment").rlike("(?i)submitted|under review")
    near = v.withColumn("_k", F.regexp_replace(F.lower("display"), "[^a-z0-9]", "")).groupBy("_k").agg(F.count_distinct("display").alias("n"), F.min("display").alias("id"))
    rules = [
        ("missed publication", "HIGH", v.where((F.col("status") == "preprint") & accepted & ~submitted)),
        ("unusable url", "MED", v.where(F.col("status").isin("published", "accepted") & ~F.coalesce(F.col("url").rlike("^https?://"), F.lit(False)))),
        ("year before preprint", "HIGH", v.where(pre - year > 1)),
        ("year before preprint", "LOW", v.where(pre - year == 1)),
        ("future year", "MED", v.where(year > as_of_year + 1)),
        ("near-duplicate display", "LOW", near.where("n > 1")),
    ]
    return union([violation(df, gate, F.lit(True)).withColumn("severity", F.lit(s)) for gate, s, df in rules])


#: Venues that have a Findings track.
FINDINGS_OK = ("acl", "emnlp", "naacl", "eacl", "aacl")


def audit_sources(v: DataFrame, registry: DataFrame) -> DataFrame:
    """GT-10, rules 4 to 6: findings (gate, id, detail, severity) over claimed records (id, status, venue, display, track, kind, year,
    journal_ref, dblp_years) against the registry (id, name, full, kind, unregistered).

    A journal reference agrees with a venue if it has the venue's short name, its id (spaces aside), or half (and two at least) of
    the words of more than four letters of its full name. dblp_years: the years of exact titles outside the preprint list.
    """
    r = registry.select(F.col("id").alias("venue"), F.lower(F.coalesce("name", F.lit(""))).alias("_name"), F.lower(F.coalesce("full", F.lit(""))).alias("_full"), F.col("kind").alias("_kind"), F.coalesce("unregistered", F.lit(False)).alias("_un"))
    rows = v.where(F.col("status").isin("published", "accepted")).join(r, "venue", "left")
    ref = F.lower("journal_ref")
    words = F.filter(F.split(F.coalesce("_full", F.lit("")), "[^a-z]+"), lambda w: F.length(w) > 4)
    there = F.size(F.filter(words, lambda w: F.contains(ref, w)))
    by_name = (F.coalesce("_name", F.lit("")) != "") & F.contains(ref, F.coalesce("_name", F.lit("")))
    by_id = F.contains(F.replace(ref, F.lit(" "), F.lit("")), F.coalesce("venue", F.lit("")))
    agrees = by_name | by_id | ((F.size(words) > 0) & (there >= F.greatest(F.lit(2), F.floor(F.size(words) / 2))))
    ref_year = F.nullif(F.regexp_extract("journal_ref", r"\b(20\d{2})\b", 1), F.lit(""))
    year = F.when(F.col("year").rlike("^[0-9]+$"), F.col("year"))
    said = ~missing(F.col("journal_ref"))
    findings = F.lower(F.coalesce("track", F.lit(""))).contains("findings") | F.lower(F.coalesce("display", F.lit(""))).contains("findings")
    rules = [
        ("findings outside the family", "MED", findings & ~F.coalesce(F.col("venue").isin(*FINDINGS_OK), F.lit(False)), F.col("display")),
        ("venue disagrees with the journal reference", "MED", said & ~agrees, F.col("journal_ref")),
        ("year disagrees with the journal reference", "MED", said & year.isNotNull() & ref_year.isNotNull() & (ref_year != year), ref_year),
        ("year not among the index's", "MED", year.isNotNull() & (F.size("dblp_years") > 0) & ~F.array_contains("dblp_years", year), F.array_join(F.array_sort("dblp_years"), ",")),
        ("venue not registered", "LOW", F.coalesce("_un", F.lit(False)), F.col("venue")),
        ("kind differs from the registry", "LOW", ~missing(F.col("kind")) & F.col("_kind").isNotNull() & (F.col("kind") != F.col("_kind")) & ~F.col("_un"), F.col("kind")),
    ]
    return union([violation(rows, gate, F.coalesce(cond, F.lit(False)), detail=detail).withColumn("severity", F.lit(s)) for gate, s, cond, detail in rules])
