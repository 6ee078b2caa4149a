"""Predicates over messages: keywords, new threads, unknown senders, and traces of injected instructions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of instructions hidden in a message, in their order.
INJECTION = (
    r"(?i)ignore (all |any |the )?(previous|prior|above)",
    r"(?i)disregard (all |any |the )?(previous|prior|above)",
    r"(?i)you are now",
    r"(?i)system prompt",
    r"(?i)</?(system|instructions?)>",
    r"(?i)(reveal|print|output|send)\b.{0,24}(api[ _-]?key|password|token|credential)",
    r"(?i)run (this|the following) (command|script|code)",
    r"(?i)execute the following",
    r"(?i)forward (this|all).{0,30}(to|at)\s",
    r"(?i)post (this|it) (to|on)\b",
)


def wanted(text: Column, patterns: list[str], unwanted: list[str] = ()) -> Column:
    """FIL-16: any of the patterns fits the lower-cased text, and none of the unwanted ones."""
    low = F.lower(F.coalesce(text, F.lit("")))
    fits = reduce(lambda a, b: a | b, [low.rlike(p) for p in patterns], F.lit(False))
    return fits & ~reduce(lambda a, b: a | b, [low.rlike(p) for p in unwanted], F.lit(False))


def is_new_thread(in_reply_to: Column, references: Column) -> Column:
    """FIL-17: neither header is there."""
    return in_reply_to.isNull() & references.isNull()


def injection_hits(text: Column, patterns: tuple[str, ...] = INJECTION, most: int = 70) -> Column:
    """FIL-18: the first hit of each pattern, at most `most` characters of it."""
    hits = F.array(*[F.substring(F.regexp_extract(F.coalesce(text, F.lit("")), p, 0), 1, most) for p in patterns])
    return F.filter(hits, lambda x: x != "")
