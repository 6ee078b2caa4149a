"""Geometry and places as expressions: distances, projection, regions, countries, TopoJSON decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """FN-39: kilometres on the sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def half_up(x: Column, places: int = 1) -> Column:
    """Rounding as floor(x + 0.5)."""
    m = 10.0**places
    return F.floor(x * m + 0.5) / m


def project(lon: Column, lat: Column, width: float = 1000.0, top: float = 84.0, bottom: float = -57.0) -> tuple[Column, Column]:
    """FN-40: equirectangular x and y, to one place, the latitude clamped."""
    height = width * (top - bottom) / 360.0
    inside = F.least(F.greatest(lat, F.lit(bottom)), F.lit(top))
    return half_up((lon + 180) / 360 * width), half_up((top - inside) / (top - bottom) * height)


def region(country: Column, table: list[tuple[str, list[str]]], other: str = "Other") -> Column:
    """FN-27: the first region whose list has the country; Unknown of none."""
    out = F.lit(other)
    for name, countries in reversed(table):
        out = F.when(country.isin(*countries), F.lit(name)).otherwise(out)
    return F.when(F.coalesce(country, F.lit("")) == "", "Unknown").otherwise(out)


def bench_state(status: Column, publishable: Column, complete: Column, present: Column) -> Column:
    """FN-28, PR-05: how far an entry is attributed."""
    return (
        F.when(~present, "not_attributed").when(status == "no_affiliation", "no_affiliation").when(~publishable, "pending")
        .when(complete, "attributed").otherwise("partial")
    )


def decode_arcs(arcs: DataFrame, scale: tuple[float, float], translate: tuple[float, float]) -> DataFrame:
    """SRC-26, WN-10: arc, pos, lon, lat of delta-encoded arcs (arc, deltas array<array<long>>), by running sums."""
    w = Window.partitionBy("arc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    points = arcs.select("arc", F.posexplode("deltas").alias("pos", "d"))
    place = lambda k: F.sum(F.col("d")[k]).over(w) * scale[k] + translate[k]
    return points.select("arc", "pos", place(0).alias("lon"), place(1).alias("lat"))


def unwrap(points: DataFrame, by: str = "ring") -> DataFrame:
    """FN-41: longitudes without jumps over the antimeridian: a running offset of 360 degrees."""
    w = Window.partitionBy(by).orderBy("pos")
    step = F.col("lon") - F.lag("lon").over(w)
    jump = F.when(step > 180, -360).when(step < -180, 360).otherwise(0)
    return points.withColumn("_jump", jump).withColumn("lon", F.col("lon") + F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def ring_path(points: Column) -> Column:
    """PR-07: M x,y L x,y ... Z of an array of struct(x, y)."""
    text = F.transform(points, lambda p, i: F.concat(F.when(i == 0, "M").otherwise("L"), p["x"].cast("string"), F.lit(","), p["y"].cast("string")))
    return F.concat(F.array_join(text, ""), F.lit("Z"))


def map_rings(points: DataFrame, width: float = 1000.0, top: float = 84.0, bottom: float = -57.0) -> DataFrame:
    """PR-07: ring, copy, path: the outlines of rings (ring, pos, lon, lat) on the map, one row for each copy that can be seen.

    A ring that crosses the antimeridian is unwrapped, and drawn as it is and shifted by a whole turn either way where a part of
    the copy lies on the map. A ring's points meet, as its path is one text.
    """
    crossed = F.abs(F.col("lon") - F.lag("lon").over(Window.partitionBy("ring").orderBy("pos"))) > 180
    flat = unwrap(points.withColumn("crossed", F.coalesce(crossed, F.lit(False))))
    rings = flat.groupBy("ring").agg(F.bool_or("crossed").alias("crossed"), F.min("lon").alias("lo"), F.max("lon").alias("hi"), F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("pts"))
    seen = lambda k: (F.col("hi") + k * 360 > -180) & (F.col("lo") + k * 360 < 180)
    copies = F.when(F.col("crossed"), F.filter(F.array(*[F.when(seen(k), F.lit(k)) for k in (0, -1, 1)]), lambda x: x.isNotNull())).otherwise(F.array(F.lit(0)))

    def place(p: Column) -> Column:
        x, y = project(p["lon"] + F.col("copy") * 360, p["lat"], width, top, bottom)
        return F.struct(x.alias("x"), y.alias("y"))

    return rings.select("ring", F.explode(copies).alias("copy"), "pts").select("ring", "copy", ring_path(F.transform("pts", place)).alias("path"))


def norm_city(city: Column) -> Column:
    """FN-26: lower case, without what follows a comma or stands in parentheses."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.substring_index(F.coalesce(city, F.lit("")), ",", 1)), r"\(.*?\)", ""), r"[^\p{L} ]+", " "))


def iso_of(name: Column, codes: DataFrame | dict[str, str]) -> Column:
    """FN-25: a country's code by name, in a small map: the whole name, its last comma part, or a two-letter code as it is.

    What stands in parentheses or behind a semicolon, and points around the name, don't count; full-width and other compatibility
    forms are folded before, by `unicode.normalised`.
    """
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    flat = F.regexp_replace(F.substring_index(F.coalesce(name, F.lit("")), ";", 1), r"\(.*?\)", " ")
    flat = F.lower(F.trim(F.regexp_replace(F.regexp_replace(flat, r"^[\s.]+|[\s.]+$", ""), r"\s+", " ")))
    last = F.trim(F.substring_index(flat, ",", -1))
    return F.coalesce(F.try_element_at(table, flat), F.when(flat.rlike("^[a-z]{2}$"), F.upper(flat)), F.try_element_at(table, last), F.when(last.rlike("^[a-z]{2}$"), F.upper(last)))
