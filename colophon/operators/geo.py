"""Geography of institutions: distinct counts by institution, country, type and region over occurrences.

occurrences: entry, date, inst, type, country, region, lead. Institutions are counted once per entry whatever they print.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def institutions(occ: DataFrame) -> DataFrame:
    """AG-18: entries of each institution, all and as lead."""
    lead = F.when(F.col("lead"), F.col("entry"))
    return occ.groupBy("inst").agg(F.count_distinct("entry").alias("entries"), F.count_distinct(lead).alias("leads"), F.count("*").alias("named"))


def countries(occ: DataFrame) -> DataFrame:
    """AG-19: entries, leads and institutions of each country."""
    lead = F.when(F.col("lead"), F.col("entry"))
    return occ.groupBy("country").agg(F.count_distinct("entry").alias("entries"), F.count_distinct(lead).alias("leads"), F.count_distinct("inst").alias("insts"))


def type_split(occ: DataFrame) -> DataFrame:
    """AG-20: entries by who takes part: academia alone, industry alone, both, or neither."""
    per = occ.groupBy("entry").agg(F.bool_or(F.col("type") == "academia").alias("a"), F.bool_or(F.col("type") == "industry").alias("i"))
    kind = F.when(F.col("a") & F.col("i"), "mixed").when(F.col("a"), "academia").when(F.col("i"), "industry").otherwise("other")
    return per.groupBy(kind.alias("split")).agg(F.count("*").alias("entries"))


def type_rollup(occ: DataFrame) -> DataFrame:
    """AG-21: entries of each type: the union over its institutions, not their sum."""
    return occ.groupBy("type").agg(F.count_distinct("entry").alias("entries"), F.count_distinct("inst").alias("insts"))


def year_region(occ: DataFrame, regions: list[str]) -> DataFrame:
    """AG-22: entries of each year and region, with totals, one column for each region."""
    rows = occ.select(F.substring("date", 1, 4).alias("year"), "region", "entry").distinct()
    sums = [F.count_if(F.col("region") == r).alias(r.lower().replace(" ", "_")) for r in regions]
    return rows.groupBy("year").agg(*sums, F.count("*").alias("total"))


def multi(occ: DataFrame) -> DataFrame:
    """AG-23: entries with several institutions, and several countries among those with a known country."""
    per = occ.groupBy("entry").agg(F.count_distinct("inst").alias("i"), F.count_distinct("country").alias("c"))
    return per.agg(F.count("*").alias("entries"), F.count_if(F.col("i") > 1).alias("multi_inst"), F.count_if(F.col("c") > 1).alias("multi_country"), F.count_if(F.col("c") > 0).alias("with_country"))


def boxes(points: DataFrame, by: str) -> DataFrame:
    """AG-36: the bounding box of each group's points."""
    return points.groupBy(by).agg(F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"))


def outside_box(sites: DataFrame, box: DataFrame, by: str, slack: float = 1.0, no_lon: Column | None = None) -> DataFrame:
    """JN-18: sites outside their country's box by more than the slack; an equi-join on the country, the range as its filter.

    no_lon: countries whose longitudes can't be tested (they cross the antimeridian)."""
    lat = F.col("lat").between(F.col("south") - slack, F.col("north") + slack)
    lon = F.col("lon").between(F.col("west") - slack, F.col("east") + slack)
    if no_lon is not None:
        lon = no_lon | lon
    return sites.join(box, by).where(~(lat & lon)).drop("west", "east", "south", "north")


def merged_sites(sites: DataFrame, by: list[str], near: float = 0.3) -> DataFrame:
    """AG-17: sites (lat, lon, weight) of each group, merged greedily in weight order into the first kept one within `near`.

    The order decides (it isn't transitive), so a fold over the group's sorted sites does it: an institution's sites are few.
    """
    site = F.struct((-F.col("weight")).alias("w"), "lat", "lon")
    sorted_sites = F.array_sort(F.collect_list(site))
    kind = "array<struct<w:bigint,lat:double,lon:double>>"

    def step(kept: Column, s: Column) -> Column:
        close = lambda k: (F.abs(k["lat"] - s["lat"]) < near) & (F.abs(k["lon"] - s["lon"]) < near)
        at = F.coalesce(F.get(F.filter(F.transform(kept, lambda k, i: F.when(close(k), i)), lambda i: i.isNotNull()), F.lit(0)), F.lit(-1))
        added = F.transform(kept, lambda k, i: F.when(i == at, F.struct((k["w"] + s["w"]).alias("w"), k["lat"].alias("lat"), k["lon"].alias("lon"))).otherwise(k))
        return F.when(at >= 0, added).otherwise(F.concat(kept, F.array(s)))

    agg = sites.withColumn("weight", F.col("weight").cast("bigint")).groupBy(*by).agg(F.aggregate(sorted_sites.cast(kind), F.array().cast(kind), step).alias("m"))
    return agg.select(*by, F.explode("m").alias("s")).select(*by, (-F.col("s.w")).alias("weight"), "s.lat", "s.lon")


def site_rows(occurrences: DataFrame, institutions: DataFrame) -> DataFrame:
    """AG-18: of each institution the distinct entries and models, those that it leads, and the same of each of its places.

    occurrences: kind (bench or model), key, inst, lead, placed, city, lat, lon (those of the first lead only are marked lead).
    institutions: id, name, site (struct of city, lat, lon: its first place, or null). An occurrence that is unplaced has no place; one
    with coordinates has its own (named, if it is placed so), any other the institution's. A place counts distinct entries, and
    named and defaulted occurrences. Occurrences of unknown institutions don't count.
    """
    known = institutions.select(F.col("id").alias("inst"), "name", "site")
    own = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    rows = occurrences.join(known, "inst")
    site = F.when(F.col("placed").eqNullSafe("unplaced"), None).when(own, F.struct("city", "lat", "lon")).otherwise(F.col("site"))
    named = own & F.col("placed").eqNullSafe("named")
    rows = rows.select("inst", "name", "kind", "key", F.col("lead").alias("lead"), site.alias("at"), named.alias("named"))
    # one row for each entry at a place, then one for each entry
    each = rows.groupBy("inst", "name", "at", "kind", "key").agg(F.bool_or("lead").alias("lead"), F.count_if("named").alias("named"), F.count_if(~F.col("named")).alias("defaulted"))
    is_ = lambda kind, lead=False: F.count_if((F.col("kind") == kind) & (F.col("lead") if lead else F.lit(True)))
    sites = each.where("at is not null").groupBy("inst", "at").agg(is_("bench").alias("bench_all"), is_("bench", True).alias("bench_lead"), is_("model").alias("models_all"), F.sum("named").alias("named"), F.sum("defaulted").alias("defaulted"))
    sites = sites.groupBy("inst").agg(F.array_sort(F.collect_list(F.struct("at.city", "at.lat", "at.lon", "bench_all", "bench_lead", "models_all", "named", "defaulted"))).alias("sites"))
    total = each.groupBy("inst", "name", "kind", "key").agg(F.bool_or("lead").alias("lead")).groupBy("inst", "name")
    total = total.agg(is_("bench").alias("bench_all"), is_("bench", True).alias("bench_lead"), is_("model").alias("models_all"), is_("model", True).alias("models_lead"))
    return total.join(sites, "inst", "left").withColumn("sites", F.coalesce("sites", F.array().cast(sites.schema["sites"].dataType)))


def country_rows(occurrences: DataFrame, institutions: DataFrame) -> DataFrame:
    """AG-19: of each country the distinct entries, entries led, models and institutions.

    occurrences: kind (bench or model), key, inst, lead, country, countries. A bench's countries are the list's, or else its own
    country, or else the institution's; the lead's country is the list's only one, or none of several. A model's is its own or the
    institution's. A country that only a lead or only a model has comes out too.
    """
    known = institutions.select(F.col("id").alias("inst"), F.col("country").alias("home"))
    rows = occurrences.join(known, "inst")
    one = F.coalesce(F.nullif("country", F.lit("")), F.nullif("home", F.lit("")))
    listed = F.coalesce(F.size("countries") > 0, F.lit(False)) & (F.col("kind") == "bench")
    of = F.when(listed, F.col("countries")).otherwise(F.array(one))
    lead = F.when(listed, F.when(F.size("countries") == 1, F.col("countries")[0])).otherwise(one)
    where = rows.select("kind", "key", "inst", F.explode(F.array_distinct(of)).alias("country"))
    led = rows.where(F.col("lead") & (F.col("kind") == "bench")).select(F.lit("lead").alias("kind"), "key", F.lit(None).cast(rows.schema["inst"].dataType).alias("inst"), lead.alias("country"))
    long = where.unionByName(led).where("country is not null")
    entries = long.select("country", "kind", "key").distinct().groupBy("country").agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in (("bench", "bench_all"), ("lead", "bench_lead"), ("model", "models"))])
    insts = long.where("inst is not null").select("country", "inst").distinct().groupBy("country").agg(F.count("*").alias("institutions"))
    return entries.join(insts, "country", "left").withColumn("institutions", F.coalesce("institutions", F.lit(0)))


def model_dispositions(records: DataFrame) -> DataFrame:
    """AG-24: state, n of model records (id, status, publishable, builders, present): no record, composite, incomplete, unknown, attributed."""
    some = F.coalesce(F.size("builders") > 0, F.lit(False))
    state = F.when(~F.col("present"), "no_record").when(F.col("status") == "composite", "composite").when(~F.col("publishable") & some, "incomplete").when(~F.col("publishable"), "unknown").otherwise("attributed")
    return records.groupBy(state.alias("state")).agg(F.count("*").alias("n"))
