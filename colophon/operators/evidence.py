"""Venue evidence: which hits may decide, the best of a source, and the promotion of weak matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.operators.match import decision, measured, prepared
from colophon.sources.tables import scratch

# Crossref's types of publication records; the prefix of preprint DOIs.
PUBLISHED_TYPES = ("proceedings-article", "journal-article", "book-chapter")
PREPRINT_DOI = "10.48550"


def usable(hits: DataFrame, promoted: DataFrame) -> DataFrame:
    """FIL-10: hits that may decide: exact and fuzzy ones, and weak ones whose address, or whose DOI's, was promoted for the entry.

    hits: id, match (null: exact), url, doi, ...; promoted: id, url. Adds `promoted`. Promoted addresses are few for each entry.
    """
    p = promoted.select(F.col("id").alias("p_id"), F.col("url").alias("p_url")).distinct()
    weak = hits.where("match = 'weak'")
    by_doi = F.when(T.or_empty(F.col("doi")) != "", F.concat(F.lit("https://doi.org/"), F.col("doi")))
    same = (F.col("id") == F.col("p_id")) & ((F.col("url") == F.col("p_url")) | (by_doi == F.col("p_url")))
    sure = hits.where(F.coalesce(F.col("match"), F.lit("exact")).isin("exact", "fuzzy")).withColumn("promoted", F.lit(False))
    return sure.unionByName(weak.join(p, same, "left_semi").withColumn("promoted", F.lit(True)))


def not_preprint(doi: Column) -> Column:
    """FIL-12: whether a DOI isn't that of the preprint."""
    return ~T.or_empty(doi).startswith(PREPRINT_DOI)


def same_title(a: Column, b: Column, most: int = 60) -> Column:
    """FIL-13: normalised titles that are equal, or of which one begins with the first 60 characters of the other."""
    x, y = T.norm(a), T.norm(b)
    return (x == y) | F.startswith(y, F.substring(x, 1, most)) | F.startswith(x, F.substring(y, 1, most))


def long_enough(title: Column, least: int = 4) -> Column:
    """FIL-19: titles of so many words may be matched by title."""
    return F.size(F.filter(F.split(T.or_empty(title), r"\s+"), lambda x: x != "")) >= least


def candidates(hits: DataFrame, most: int = 6) -> DataFrame:
    """JN-12: of the first `most` results of each title search, those that match and aren't preprints.

    hits: id, ord (their place in the search), title, found (the result's title), doi. Adds `match`: exact or fuzzy.
    """
    first = hits.where(F.col("ord") < most).where(long_enough(F.col("title")))
    exact = T.norm(F.col("title")) == T.norm(F.col("found"))
    kind = F.when(exact, "exact").when(same_title(F.col("title"), F.col("found")), "fuzzy")
    return first.withColumn("match", kind).where(F.col("match").isNotNull() & not_preprint(F.col("doi")))


def tree_candidates(hits: DataFrame, most: int = 6) -> DataFrame:
    """JN-12, FN-10: of the first `most` results of each title search, those that the title match accepts and that aren't preprints.

    hits: id, ord, title, authors, found, found_authors (arrays of names), doi. Adds kind (exact, fuzzy, weak) and score, for each
    result by itself.
    """
    first = hits.where(F.col("ord") < most).where(long_enough(F.col("title")) & not_preprint(F.col("doi")))
    both = measured(prepared(prepared(first, "title", "authors", "a_"), "found", "found_authors", "b_"))
    return both.select(*hits.columns, decision().alias("_m")).where("_m.kind is not null").select(*hits.columns, "_m.kind", "_m.score")


def preferred(hits: DataFrame, rank: Column, order: str = "ord") -> DataFrame:
    """WN-11: of each entry the hit of the least rank, the first of equals; hits of null rank never decide."""
    ranked = hits.withColumn("_rank", rank).where("_rank is not null")
    return ranked.groupBy("id").agg(F.min_by(F.struct(*hits.columns), F.struct("_rank", order)).alias("h")).select("h.*")


def openreview_rank() -> Column:
    """WN-11: a decided venue; submissions, preprint servers, mirrors and empty venues never decide."""
    venue = T.or_empty(F.col("venue"))
    out = (venue == "") | F.coalesce(F.col("mirror"), F.lit(False)) | venue.rlike(r"(?i)^\s*(corr|arxiv)\b") | venue.rlike("(?i)^submitted to")
    return F.when(~out, 0)


def accepted_history(previous: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """SE-07: all decisions made so far; a new one replaces that of its id."""
    return new.unionByName(previous.join(new.select(key).distinct(), key, "left_anti"))


def promotion_fixpoint(hits: DataFrame, adjudicate, history: DataFrame, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """GR-05: resolve, adjudicate the weak hits that are left, and resolve again until nothing new is promoted.

    adjudicate(weak hits) gives the rows (id, url) that are confirmed. Returns the usable hits and the history. Each turn decides
    entries that had no usable hit before, so two turns are the rule.
    """
    for _ in range(most):
        decided = usable(hits, history)
        open_ = hits.where("match = 'weak'").join(decided.select("id").distinct(), "id", "left_anti")
        fresh = adjudicate(open_).select("id", "url").distinct().join(history, ["id", "url"], "left_anti")
        if fresh.isEmpty():
            return decided, history
        path = scratch(history.sparkSession, "promoted")
        history.select("id", "url").unionByName(fresh).write.parquet(path)  # so that a turn doesn't evaluate those before it again
        history = history.sparkSession.read.schema(fresh.schema).parquet(path)
    raise RuntimeError("promotion did not settle")
