"""Ordered rule tables: the first rule that fits wins. A table becomes one CASE, evaluated on distinct strings only."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import textnorm as T


def first_rule(rules: Sequence[tuple[str, str]], *forms: Column, anchored: bool = False) -> Column:
    """The result of the first (pattern, result) that any of the forms fits; null if none does."""

    def case(*texts: Column) -> Column:
        out = F.lit(None).cast("string")
        for pattern, result in reversed(rules):
            p = f"^(?:{pattern})" if anchored else pattern
            out = F.when(reduce(Column.__or__, [t.rlike(p) for t in texts]), F.lit(result)).otherwise(out)
        return out

    return T.apart(case, *forms)


def any_rule(patterns: Sequence[str], col: Column, anchored: bool = False) -> Column:
    """Whether any pattern fits; all are one pattern of alternatives."""
    if not patterns:
        return F.lit(False)
    either = "|".join(f"(?:{p})" for p in patterns)
    return col.rlike(f"^(?:{either})" if anchored else either)


def on_distinct(df: DataFrame, col: str, name: str, rule) -> DataFrame:
    """df with column `name`: rule(col), evaluated once for each distinct value of col and joined back."""
    values = df.select(col).distinct().select(col, rule(F.col(col)).alias(name))
    return df.join(values, col, "left")


# Names that aren't models, at the start of a string (in the order in which they are tried) and anywhere in it; forms
# of pipelines of two components.
DROP_START = (
    r"^human", r"^random", r"^chance", r"^majority", r"^baseline$", r"^ours$", r"^\+",
    r"^cascade", r"^cascaded", r"^pipeline$", r"^upper ?bound", r"^oracle", r"^gt$",
    r"^ground ?truth", r"^google$", r"^openai$", r"^xai$", r"^meta$", r"^alibaba$",
    r"^average", r"^overall$", r"^all$", r"^-$", r"^n/?a$", r"^\d+$",
    r"^whisper[\s\-]*(large|v\d|small|medium|base|tiny)?$", r"^cosyvoice", r"^seed-?tts",
    r"^f5-?tts", r"^fish-?speech", r"^sensevoice$",
    r"^(sal|qwa|sifl|step-?fun|qwen-?a|bal|ds\d?)$",
    r"clap", r"^wavlm", r"^ssast", r"^ast$", r"^hubert", r"^wav2vec", r"^whisperx",
    r"vad\b", r"^maskgct", r"^e2[- ]?tts", r"^vall-?e", r"^xtts", r"^styletts",
    r"^mmt$", r"^ml-?act$", r"^stela",
    r"^\(?\s*(α|alpha|β|beta|λ|lambda|k|n|temp)\s*=", r"^\(.*\)$",
    r"topline", r"upper[- ]?bound", r"lower[- ]?bound",
    r"^vicuna", r"^llama-?[23](\.\d)?-?\d*b?-?(chat|instruct|ins\.)",
    r"^qwen-?\d*\.?\d*-?\d*b-?(chat|instruct)", r"^gemma-?\d*b?$", r"^qwen$", r"^gemma$",
    r"^qwen\d?$", r"^qwen-?\d+(\.\d+)?-?\d*b$", r"^mistral", r"^chatgpt$", r"^asr-?chatgpt$",
    r"^olmo", r"^llama-?3\.\d+-?\d*b$", r"^granite-?\d", r"^baseline\b",
    r"-vl(-|$)", r"^qwen\d?(\.\d)?-vl", r"^internvl", r"^llava",
    r"^(gpt|kimi|flamingo|flash|pro|glm|mf|af|qw|gem|omni|audio|speech|model|system|ours?|phi|naive|naive-4o|must|qwen2\.5|gemma ?[34]?)$",
    r"^gemma-?[34]", r"^mmduet",
)
DROP_ANYWHERE = (r"(?i)\bclap\b", r"(?i)\bvad\b", r"(?i)topline", r"(?i)upper[- ]?bound", r"(?i)\bhuman\b")
PARTS = r"(?i)^(?:(?:whisper|nova|parakeet|scribe|ink-?whisper|sensevoice|qwen\d?-?asr|asr|captions?)[\w.\- ]*)\s*(?:\+|-|\band\b)\s*\w"
PARTS_HINT = r"(?i)\+|\bcap\.|\bcaption"
PARTS_LLM = r"(?i)^(whisper|asr)[- ]?(llm|llama|gpt)"


def _forms(s: Column) -> list[Column]:
    """A name as written, with separators as hyphens, and without separators."""
    return [s, F.regexp_replace(s, r"[\s_]+", "-"), F.regexp_replace(s, r"[\s_-]+", "")]


def _cascade(s: Column) -> Column:
    """FIL-06: the id of a named pipeline of two components, null of anything else."""
    return F.when((s.rlike(PARTS) & s.rlike(PARTS_HINT)) | s.rlike(PARTS_LLM), F.concat(F.lit("cascade:"), T.slug(s)))


def model_of(raw: Column, registry: Sequence[tuple[str, str]], drop_start: Sequence[str] = (), drop_any: Sequence[str] = DROP_ANYWHERE) -> Column:
    """JN-09: the verdict on a printed model name: null (not a model), an id of the registry, cascade:<slug>, or UNMAPPED.

    registry: ordered (pattern, id); each pattern is tried on all spellings of the name before the next one is.
    """
    s = T.clean_model(raw)
    return (
        F.when((s == "") | any_rule(drop_start, s, anchored=True) | any_rule(drop_any, s), F.lit(None))
        .otherwise(F.coalesce(first_rule(registry, *_forms(s)), _cascade(s), F.lit("UNMAPPED")))
    )


def required(pattern: str) -> list[str]:
    """Runs of three letters, digits or more, in lower case, that every text has which the pattern fits; none for patterns with alternatives.

    Only plain characters outside brackets count, and not those before ?, * or {.
    """
    if "|" in pattern:
        return []
    flat = re.sub(r"\\[bB]|\(\?[a-z]+\)|[\^$]", " ", pattern)
    flat = re.sub(r"\\.|\[[^\]]*\]", ".", flat)
    while "(" in flat:  # a group may be optional as a whole
        inner = re.sub(r"\([^()]*\)", ".", flat)
        if inner == flat:
            return []
        flat = inner
    flat = re.sub(r".[?*{]", " ", flat)
    return [x.lower() for x in re.findall(r"[A-Za-z0-9]{3,}", flat)]


def registry_table(spark: SparkSession, registry: Sequence[tuple[str, str]]) -> DataFrame:
    """ord, pattern, result, gram of an ordered registry: gram is the rarest of three characters that a pattern requires, or null.

    The registry is a parameter of the caller, so of a size that the driver holds.
    """
    grams = [{w[k : k + 3] for w in required(p) for k in range(len(w) - 2)} for p, _ in registry]
    often = Counter(g for x in grams for g in x)
    rows = [(k, f"(?i){p}", result, min(x, key=lambda g: (often[g], g)) if x else None) for k, ((p, result), x) in enumerate(zip(registry, grams, strict=True))]
    return spark.createDataFrame(rows, "ord int, pattern string, result string, gram string")


def models_of(df: DataFrame, col: str, rules: DataFrame, drop_start: Sequence[str] = DROP_START, drop_any: Sequence[str] = DROP_ANYWHERE) -> DataFrame:
    """JN-09, FIL-04..06 for a large registry: df with `model`, the verdict of `model_of` on its column, case ignored.

    rules: from `registry_table`. Distinct names meet, by an equal join, only the rules whose gram one of their spellings has, and the
    rules that require none; the least rule that fits decides.
    """
    names = df.select(F.col(col).alias("_raw")).distinct().withColumn("_s", T.clean_model(F.col("_raw")))
    dropped = (F.col("_s") == "") | any_rule([f"(?i){p}" for p in drop_start], F.col("_s"), anchored=True) | any_rule(drop_any, F.col("_s"))
    names = names.select("_raw", "_s", dropped.alias("_dropped"), F.array(*_forms(F.col("_s"))).alias("_forms"))
    grams = lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 2, F.lit(1))), lambda k: F.substr(F.lower(x), k, F.lit(3)))
    each = names.where("not _dropped").select("_raw", "_forms", F.explode(F.array_distinct(F.flatten(F.transform("_forms", grams)))).alias("gram"))
    every = F.broadcast(rules.where("gram is null"))  # of a parameter's size
    met = each.join(rules, "gram").select("_raw", "_forms", "ord", "pattern", "result")
    met = met.unionByName(names.where("not _dropped").join(every, F.lit(True)).select("_raw", "_forms", "ord", "pattern", "result"))
    fits = met.where(F.exists("_forms", lambda x: F.regexp_like(x, F.col("pattern"))))
    first = fits.groupBy("_raw").agg(F.min_by("result", "ord").alias("_first"))
    verdict = F.when(~F.col("_dropped"), F.coalesce("_first", _cascade(F.col("_s")), F.lit("UNMAPPED")))
    named = names.join(first, "_raw", "left").select("_raw", verdict.alias("model"))
    return df.join(named, df[col].eqNullSafe(named["_raw"]), "left").drop("_raw")
