"""Keyword profiles: relevance scores and first failing reasons, as one expression generated from term lists."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """Terms count once if they occur at all. A title hint and a named benchmark in the title add once each."""

    model: tuple[str, ...]
    bench: tuple[str, ...]
    negative: tuple[str, ...]
    hints: tuple[str, ...] = ("benchmark", "eval", "bench")
    name: str = r"\b[A-Z][A-Za-z0-9]*-?Bench\b"
    weights: tuple[int, int, int, int, int] = (6, 3, 12, 15, 5)


#: The profile of the daily crawl.
DAILY = Profile(
    model=(
        "speech language model", "spoken language model", "audio language model", "speech-language model", "audio-language model",
        "large audio language model", "speech llm", "audio llm", "spoken llm", "lalm", "salmonn", "qwen-audio", "qwen2-audio",
        "qwen2.5-omni", "qwen3-omni", "gpt-4o", "moshi", "glm-4-voice", "speechgpt", "kimi-audio", "step-audio", "minicpm-o",
        "audio flamingo", "gemini", "omni", "speechlm", "voxtral", "spoken dialogue model", "voice assistant", "speech-to-speech",
        "full-duplex", "end-to-end speech", "voice agent", "multimodal llm", "phi-4-multimodal",
    ),
    bench=(
        "benchmark", "evaluation suite", "evaluation framework", "test suite", "testbed", "we introduce", "we present", "we propose",
        "evaluation benchmark", "leaderboard", "diagnostic", "probing", "we release", "eval",
    ),
    negative=(
        "speech enhancement", "speech separation", "voice conversion", "speaker verification", "anti-spoofing countermeasure",
        "acoustic echo", "beamforming", "hearing aid",
    ),
)


def present(text: Column, terms: tuple[str, ...]) -> Column:
    """How many of the terms occur in text, by presence."""
    out = F.lit(0)
    for t in terms:
        out = out + F.contains(text, F.lit(t)).cast("int")
    return out


def relevance(title: Column, abstract: Column, p: Profile) -> Column:
    """FN-32."""
    low, text = F.lower(title), F.lower(F.concat_ws(" ", title, abstract))
    model, bench, hint, named, negative = p.weights
    hinted = F.lit(False)
    for h in p.hints:
        hinted = hinted | F.contains(low, F.lit(h))
    return model * present(text, p.model) + bench * present(text, p.bench) + hint * hinted.cast("int") + named * title.rlike(p.name).cast("int") - negative * present(text, p.negative)


def relevance_sql(p: Profile, title: str, abstract: str) -> str:
    """The same in DuckDB's SQL (for patterns that mean the same in both)."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    text = f"lower({title} || ' ' || {abstract})"
    count = lambda terms: " + ".join(f"contains({text}, {quote(t)})::INT" for t in terms) or "0"
    model, bench, hint, named, negative = p.weights
    hinted = " OR ".join(f"contains(lower({title}), {quote(h)})" for h in p.hints)
    return f"{model} * ({count(p.model)}) + {bench} * ({count(p.bench)}) + {hint} * ({hinted})::INT + {named} * regexp_matches({title}, {quote(p.name)})::INT - {negative} * ({count(p.negative)})"


def any_of(terms: list[str]) -> str:
    """A pattern for any of the terms between ASCII word bounds, the same in Java, Python and RE2."""
    return "(^|[^a-z0-9])(" + "|".join(re.escape(t).replace(r"\ ", " ") for t in terms) + ")($|[^a-z0-9])"


def drop_reason(score: Column, text: Column, least: int, modality: str, signal: str, hard: str, general: str) -> Column:
    """FIL-03: the first reason to drop a record, in order; null if it is kept."""
    low = F.lower(text)
    return (
        F.when(score < least, "low_score").when(~low.rlike(modality), "no_modality").when(~low.rlike(signal), "no_signal")
        .when(low.rlike(hard) & ~low.rlike(general), "hard_drop")
    )


def citing_rank(n: Column, reports: Column, survey: Column) -> Column:
    """FN-34: cited benchmarks count 2 each, reported scores 3, and a survey costs 12."""
    return 2 * n + 3 * reports - 12 * survey.cast("int")
