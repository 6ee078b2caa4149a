"""Transactional corrections: patches with the state before and after, folded in order; all apply or none does.

Records and patches are (id, fields map<string,string>): values are compared and kept as JSON text, where null and absent are the
same, so any JSON value is comparable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.gates import GateError

MAP = "map<string,string>"


def _fits(state: Column, want: Column) -> Column:
    """state has every field of want as it is there."""
    return F.forall(F.map_entries(want), lambda e: F.try_element_at(state, e["key"]).eqNullSafe(e["value"]))


def _merged(state: Column, change: Column) -> Column:
    kept = F.map_filter(state, lambda k, v: ~F.array_contains(F.map_keys(change), k))
    return F.map_concat(kept, change)


def fold(records: DataFrame, patches: DataFrame) -> DataFrame:
    """UP-01: id, fields, conflict (the ord of the first patch that doesn't fit, or null) for all ids of records and patches.

    patches: ord, id, before, after. Each patch in order: already as after, nothing happens; before null inserts a record that
    is missing; after null deletes one; else the fields of after replace those of a record that is as before. A null result
    in `fields` is a record that is gone. The patches of one record are few and are folded in its row.
    """
    each = F.collect_list(F.struct("ord", F.col("before").cast(MAP).alias("before"), F.col("after").cast(MAP).alias("after")))
    in_order = F.array_sort(each, lambda a, b: F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0))
    p = patches.groupBy("id").agg(in_order.alias("ps"))
    rows = records.select("id", F.col("fields").cast(MAP).alias("fields")).join(p, "id", "full_outer")
    make = lambda fields, conflict: F.struct(fields.cast(MAP).alias("fields"), conflict.cast("long").alias("conflict"))
    none = F.lit(None)

    def step(acc: Column, x: Column) -> Column:
        now, before, after = acc["fields"], x["before"], x["after"]
        gone = now.isNull()
        done = F.when(after.isNull(), gone).otherwise(~gone & _fits(now, after))
        fits = F.when(before.isNull(), gone).otherwise(~gone & _fits(now, before))
        changed = F.when(after.isNull(), none.cast(MAP)).when(gone, after).otherwise(_merged(now, after))
        return F.when(acc["conflict"].isNotNull() | F.coalesce(done, F.lit(False)), acc).when(F.coalesce(fits, F.lit(False)), make(changed, none)).otherwise(make(now, x["ord"]))

    start = make(F.col("fields"), none)
    patched = F.aggregate(F.coalesce("ps", F.array().cast(f"array<struct<ord:bigint,before:{MAP},after:{MAP}>>")), start, step)
    return rows.select("id", patched.alias("r")).select("id", "r.fields", "r.conflict")


def apply(records: DataFrame, patches: DataFrame) -> DataFrame:
    """The corrected records; raises GateError, and gives none, if any patch doesn't fit."""
    out = fold(records, patches)
    bad = out.where("conflict is not null").orderBy("conflict").limit(25).collect()
    if bad:
        raise GateError("corrections don't fit: " + ", ".join(f"{r['id']} (patch {r['conflict']})" for r in bad))
    return out.where("fields is not null").select("id", "fields")


def diverged(records: DataFrame, patches: DataFrame) -> DataFrame:
    """GT-05: ids whose record isn't as their last patch left it."""
    last = patches.groupBy("id").agg(F.max_by(F.struct(F.col("after").cast(MAP).alias("after")), "ord").alias("p"))
    both = last.join(records.select("id", F.col("fields").cast(MAP).alias("fields")), "id", "left")
    ok = F.when(F.col("p.after").isNull(), F.col("fields").isNull()).otherwise(F.col("fields").isNotNull() & _fits(F.col("fields"), F.col("p.after")))
    return both.where(~F.coalesce(ok, F.lit(False))).select("id")
