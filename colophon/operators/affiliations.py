"""Affiliation records: occurrences joined to institutions and sites, leads, flags, and their issues; venue records and their registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.functions import textnorm as T

CONFIRMED = ("confirmed", "corrected")
# Cities that are places of their own: how a printed city begins, its name and code; and where they are.
OWN_PLACES = (("hong kong", "Hong Kong", "HK"), ("maca", "Macau", "MO"))
OWN_SITES = (("HK", "Hong Kong", 22.32, 114.17), ("MO", "Macau", 22.2, 113.55), ("SG", "Singapore", 1.35, 103.82))


def own_places(occ: DataFrame) -> DataFrame:
    """FN-50: occurrences (printed_city, printed_country) with the city and the code of places of their own put right."""
    low = F.lower("printed_city")
    city, country = F.col("printed_city"), F.col("printed_country")
    for start, name, code in OWN_PLACES:
        city, country = F.when(low.startswith(start), name).otherwise(city), F.when(low.startswith(start), code).otherwise(country)
    return occ.withColumns({"printed_city": city, "printed_country": country})


def with_own_sites(sites: DataFrame, occ: DataFrame) -> DataFrame:
    """FN-50: printed sites (city, country, lat, lon), and for printed cities of OWN_SITES' countries that they lack the country's own site."""
    spark = sites.sparkSession
    own = spark.createDataFrame([(code, lat, lon) for code, _, lat, lon in OWN_SITES], "country string, lat double, lon double")
    printed = occ.where("printed_city is not null").select(F.col("printed_city").alias("city"), F.col("printed_country").alias("country")).distinct()
    known = sites.select(F.lower("city").alias("_c"), F.col("country").alias("_k"))
    lacking = printed.join(known, (F.lower("city") == F.col("_c")) & (F.col("country") == F.col("_k")), "left_anti").join(F.broadcast(own), "country")
    return sites.select("city", "country", "lat", "lon").unionByName(lacking.select("city", "country", "lat", "lon"))


def placed(occ: DataFrame, aliases: DataFrame, sites: DataFrame) -> DataFrame:
    """JN-16, JN-17: occurrences with their institution, country and place.

    occ: entry, ord, raw, printed_city (normalised), printed_country (a code), ...; aliases: raw, inst, inst_country, country, city,
    lat, lon; sites: city, country, lat, lon. The paper wins: its country over the alias's, its city over the default site, and
    the default is never used in another country than the printed one. inst is null of an unknown name, which a gate rejects.
    """
    a = aliases.select("raw", "inst", "inst_country", F.col("country").alias("a_country"), F.col("city").alias("a_city"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    s = sites.select(F.col("city").alias("s_city"), F.col("country").alias("s_country"), F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    rows = occ.join(a, "raw", "left").withColumn("country", F.coalesce("printed_country", "a_country", "inst_country"))
    rows = rows.join(s, (F.lower(F.col("printed_city")) == F.lower(F.col("s_city"))) & (F.col("country") == F.col("s_country")), "left")
    same = F.col("printed_country").isNull() | F.col("printed_country").eqNullSafe(F.col("a_country"))
    alike = F.contains(F.lower("a_city"), F.lower("printed_city")) | F.contains(F.lower("printed_city"), F.lower("a_city"))
    site, has = F.col("a_lat").isNotNull(), F.col("printed_city").isNotNull()
    named = F.coalesce(has & site & alike & same, F.lit(False))
    how = (
        F.when(has & F.col("s_lat").isNotNull(), "printed").when(named, "alias").when(has & site & same, "fallback").when(has, "none")
        .when(site & same, "default").otherwise("none")
    )
    rows = rows.withColumn("_how", how)
    pick = lambda printed, alias: F.when(F.col("_how") == "printed", F.col(printed)).when(F.col("_how") != "none", F.col(alias))
    city = F.when(F.col("_how") == "printed", F.col("s_city")).when(F.col("_how").isin("alias", "default"), F.col("a_city")).otherwise(F.col("printed_city"))
    kind = F.when(F.col("_how").isin("printed", "alias"), "named").when(F.col("_how") == "none", "none").otherwise("default")
    return rows.select(*occ.columns, "inst", "country", city.alias("city"), pick("s_lat", "a_lat").alias("lat"), pick("s_lon", "a_lon").alias("lon"), kind.alias("placed"), F.coalesce("printed_country", "a_country").isNotNull().alias("own_country"))


def once_per_site(occ: DataFrame) -> DataFrame:
    """WN-09: the first of occurrences of an entry with the same institution, country and city."""
    w = Window.partitionBy("entry", "inst", "country", F.lower(F.coalesce("city", F.lit("")))).orderBy("ord")
    return occ.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_lead(occ: DataFrame, lead_inst: Column) -> DataFrame:
    """WN-08: the first occurrence of the lead institution leads, and no other."""
    w = Window.partitionBy("entry", lead_inst == F.col("inst")).orderBy("ord")
    return occ.withColumn("lead", F.coalesce((lead_inst == F.col("inst")) & (F.row_number().over(w) == 1), F.lit(False)))


def records(occ: DataFrame, entries: DataFrame) -> DataFrame:
    """UP-05: entries (entry, status, verified, verify_reason) with their number of occurrences and flags.

    corrected without a reason counts as unverified; publishable: some occurrence, verified, and some affiliation text; complete:
    the country of every occurrence is its own.
    """
    per = occ.groupBy("entry").agg(F.count("*").alias("n"), F.every("own_country").alias("complete"), F.bool_or("lead").alias("has_lead"))
    verified = F.when((F.col("verified") == "corrected") & (T.or_empty(F.col("verify_reason")) == ""), "unverified").otherwise(F.coalesce("verified", F.lit("unverified")))
    rows = entries.join(per, "entry", "left").withColumn("verified", verified).withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.coalesce("status", F.when(F.col("n") > 0, "ok").otherwise("no_affiliation_text"))
    rows = rows.withColumn("status", status)
    flag = (F.col("n") > 0) & F.col("verified").isin(*CONFIRMED) & (F.col("status") != "no_affiliation_text")
    return rows.select("entry", "status", "verified", "n", flag.alias("publishable"), F.coalesce(F.col("complete"), F.lit(False)).alias("countries_complete"), F.coalesce("has_lead", F.lit(False)).alias("has_lead"))


def builders(models: DataFrame, listed: DataFrame, composite: DataFrame) -> DataFrame:
    """UP-06: models (model, status, evidence_url) with their builders (model, ord, inst, lead), once for each institution.

    Composites have none; without a lead the first listed leads; publishable: status ok, a builder, and an http address.
    """
    w = Window.partitionBy("model", "inst").orderBy("ord")
    kept = listed.join(composite.select("model"), "model", "left_anti").withColumn("_n", F.row_number().over(w)).where("_n = 1")
    per = kept.groupBy("model").agg(F.count("*").alias("n"), F.coalesce(F.min_by("inst", F.when(F.col("lead"), F.col("ord"))), F.min_by("inst", "ord")).alias("lead_inst"))
    rows = models.join(per, "model", "left").join(composite.select("model", F.lit(True).alias("_c")), "model", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("_c"), "composite").when(F.col("n") == 0, "unknown").otherwise(F.col("status"))
    flag = ~F.coalesce("_c", F.lit(False)) & (F.col("status") == "ok") & (F.col("n") > 0) & F.coalesce(F.col("evidence_url").startswith("http"), F.lit(False))
    return rows.select("model", status.alias("status"), "n", "lead_inst", flag.alias("publishable"))


def overridden(resolved: DataFrame, adjudicated: DataFrame, fields: list[str]) -> DataFrame:
    """JN-15, UP-02: adjudicated fields over the resolved ones where there is an adjudicated status; its verdict is corrected unless it says."""
    a = adjudicated.where(T.or_empty(F.col("status")) != "").select("id", *[F.col(f).alias(f"_{f}") for f in fields], F.coalesce("verdict", F.lit("corrected")).alias("_verdict"))
    rows = resolved.join(a, "id", "full_outer")
    return rows.select("id", *[F.coalesce(f"_{f}", f).alias(f) for f in fields], F.coalesce("_verdict", "verdict").alias("verdict"))


def canonical_venues(names: DataFrame, registry: DataFrame) -> DataFrame:
    """FN-52: id, venue, community, unregistered of names (id, venue_name, venue_full, parent).

    registry: id, name, full, community. A name, or without its year, or the full name likewise, that the registry knows has its
    id; any other gets an id of its own, in the community of its parent if that is known.
    """
    bare = lambda k: F.trim(F.regexp_replace(k, r"\s*(?:19|20)[0-9]{2}$", ""))
    key = lambda c: F.trim(F.regexp_replace(F.lower(T.or_empty(F.col(c))), "[^a-z0-9&]+", " "))
    known = registry.select("id", "community", F.explode(F.array_distinct(F.array(key("name"), key("full")))).alias("k")).where("k <> ''").groupBy("k").agg(F.min("id").alias("rid"), F.min_by("community", "id").alias("rc"))
    tries = F.array(key("venue_name"), bare(key("venue_name")), key("venue_full"), bare(key("venue_full")))
    rows = names.select("id", F.posexplode(tries).alias("place", "k")).where("k <> ''").join(known, "k").groupBy("id").agg(F.min_by(F.struct("rid", "rc"), "place").alias("m"))
    own = bare(F.when(key("venue_name") != "", key("venue_name")).otherwise(key("venue_full")))
    slug = F.regexp_replace(F.substring(F.regexp_replace(own, "[^a-z0-9]+", "-"), 1, 48), "^-+|-+$", "")
    parent = known.select(F.col("k").alias("pk"), F.col("rc").alias("pc"))
    out = names.withColumn("pk", bare(key("parent"))).withColumn("slug", slug).join(rows, "id", "left").join(parent, "pk", "left")
    venue = F.coalesce(F.col("m.rid"), F.nullif("slug", F.lit("")))
    return out.select("id", venue.alias("venue"), F.when(F.col("m").isNotNull(), F.col("m.rc")).otherwise(F.coalesce("pc", F.lit("other"))).alias("community"), F.col("m").isNull().alias("unregistered"))


def registry_issues(entries: DataFrame, excluded: list[str]) -> DataFrame:
    """GT-07: gate, id, severity of canonical entries (raw, canonical, country): two readings of a name are hard, the rest soft."""
    out = lambda df, gate, severity: df.select(F.lit(gate).alias("gate"), F.col("id"), F.lit(severity).alias("severity"))
    two = entries.groupBy(F.col("raw").alias("id")).agg(F.count_distinct(F.struct("canonical", F.coalesce("country", F.lit("")))).alias("n")).where("n > 1")
    pseudo = entries.where(F.lower("canonical").isin(*excluded) | F.lower("raw").isin(*excluded)).select(F.col("raw").alias("id"))
    many = entries.groupBy(F.col("canonical").alias("id")).agg(F.count_distinct("country").alias("n")).where("n > 1")
    return out(two, "canonicalised two ways", "hard").unionByName(out(pseudo, "excluded pseudo-organisation", "soft")).unionByName(out(many, "several countries", "soft"))


def literature_gates(papers: DataFrame, notes: DataFrame, exclusions: DataFrame) -> list[DataFrame]:
    """GT-08, JN-25: papers (id, url, title, date), notes (id, target, finding, boundary: pairs), exclusions (id)."""
    from colophon.operators.gates import missing, violation

    pair = lambda c: F.coalesce(F.size(c), F.lit(0)) != 2
    empty = lambda c: F.exists(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda s: T.or_empty(s) == "")
    return [
        violation(papers.groupBy("id").count(), "literature: duplicate id", F.col("count") > 1),
        violation(papers, "literature: not a primary address", ~F.coalesce(F.col("url").rlike(r"^https://(arxiv\.org|aclanthology\.org|www\.isca-archive\.org)/"), F.lit(False))),
        violation(papers, "literature: title or date", missing(F.col("title")) | ~F.coalesce(F.col("date").rlike(r"^\d{4}(-\d{2})?$"), F.lit(False))),
        violation(papers.join(exclusions, "id", "left_semi"), "literature: excluded", F.lit(True)),
        violation(notes.groupBy("id").count(), "notes: duplicate", F.col("count") > 1),
        violation(notes.join(papers, "id", "left_anti"), "notes: no source", F.lit(True)),
        *[violation(notes, f"notes: incomplete {c}", pair(c) | empty(c)) for c in ("target", "finding", "boundary")],
    ]
