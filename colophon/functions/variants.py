"""Values of unknown shape as VARIANT: fields that are plain or wrapped, and equality of whole documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A whole JSON string, matched from its first quote, so that what follows it is never looked for inside a string.
_STRING = r'"(?:[^"\\]|\\.)*+"'


def field(doc: Column, name: str) -> Column:
    """SRC-17: a field of a VARIANT object, unwrapped if it is an object {value: ...}; null of an absent one, and of an object
    without value."""
    v = F.try_variant_get(doc, f"$.{name}", "variant")
    wrapped = F.schema_of_variant(v).startswith("OBJECT<")
    return F.when(wrapped, F.try_variant_get(v, "$.value", "variant")).otherwise(v)


def as_text(v: Column) -> Column:
    """A text as it is, null and JSON's null as the empty text, anything else as JSON."""
    kind = F.schema_of_variant(v)
    return F.when(v.isNull() | (kind == "VOID"), "").when(kind == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def as_names(v: Column) -> Column:
    """The texts of a list, without its other elements; empty of anything that isn't a list."""
    items = F.try_variant_get(v, "$", "array<variant>")
    texts = F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    return F.coalesce(texts, F.array().cast("array<string>"))


def canonical(json: Column) -> Column:
    """FN-55: a JSON text such that two documents are deeply equal, with null as absent in objects, if and only if their texts are.

    VARIANT keeps an object's keys sorted and numbers by value, at every depth; fields that are null are then taken out of the text
    (elements of lists stay). Null of a text that isn't JSON.
    """
    text = F.to_json(F.try_parse_json(json))
    without = F.regexp_replace(text, rf'{_STRING}:null\b,?|({_STRING})', "$1")
    return F.regexp_replace(without, rf"({_STRING})|,(?=\}})", "$1")


def deep_equal(a: Column, b: Column) -> Column:
    """FN-55: whether two JSON texts say the same; a null document equals JSON's null."""
    none = F.lit("null")
    return F.coalesce(canonical(a), none) == F.coalesce(canonical(b), none)


def merged(a: Column, b: Column) -> Column:
    """FN-54: {a, b}: the entries of two maps, those of b over those of a."""
    kept = F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k))
    return F.map_concat(kept, b)
