"""Assembly of catalogue entries: which mentions and classified entries get in, with the reasons of those that don't; harvest filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import textnorm as T

# Names that aren't benchmarks; words of aggregate metrics; words of papers that report results and of benchmarks.
NOT_A_BENCHMARK = ("gpt-4o", "qwen2-audio", "qwen2.5-omni", "moshi", "salmonn", "whisper", "llm", "lalm", "slm", "n/a", "none", "unknown", "various")
AGGREGATE = r"(?i)(overall|average|\bavg\b|\bmean\b|\btotal\b|composite|aggregate|macro)"
REPORTS = (
    r"(?i)\b(we evaluate|we benchmark|we compare|evaluated on|results on|outperform|achiev\w+|state-of-the-art|technical report|we present .{0,40}model|our model"
    r"|we introduce .{0,40}model|experiments? on|we report|baseline|leaderboard|zero-shot|fine-tun)"
)
BENCHY = r"(?i)\b(benchmark|evaluation|eval|suite|testbed|survey)\b"
# Harvested subject categories, the core ones, and the words that a title or abstract must have.
KEEP_CATS = ("eess.AS", "cs.SD", "cs.CL", "cs.MM", "cs.AI", "cs.LG", "cs.HC", "cs.CR", "cs.CV")
CORE_CATS = ("eess.AS", "cs.SD", "cs.CL", "cs.MM")
MODALITY = r"(?i)\b(speech|spoken|audio|voice|acoustic|auditory|paralinguistic|prosod|utterance|dialogue|dialog|conversation|sound|music|speaker|listen)\w*"
SIGNAL = r"(?i)\b(benchmark|evaluat|assess|testbed|suite|leaderboard|probe|probing|diagnos|llm|language model|gpt|multimodal|omni|lalm|slm|instruction|agent)\w*"
#: Days that a crawl looks back at least.
LOOK_BACK = 10


def own_paper(source_url: Column, arxiv_id: Column) -> Column:
    """FN-44: whether a cell's source is the benchmark's own paper: its address ends with the benchmark's paper number."""
    return F.coalesce((T.or_empty(arxiv_id) != "") & F.endswith(T.or_empty(source_url), arxiv_id), F.lit(False))


def is_aggregate(metric: Column) -> Column:
    """FN-45."""
    return T.or_empty(metric).rlike(AGGREGATE)


def reports_score(title: Column, abstract: Column) -> Column:
    """FN-33: 2 for a paper that reports results, 1 for one about benchmarks, 3 for both."""
    text = F.concat_ws(" ", T.or_empty(title), T.or_empty(abstract))
    return 2 * text.rlike(REPORTS).cast("int") + text.rlike(BENCHY).cast("int")


def citation_edges(cites: DataFrame) -> DataFrame:
    """FIL-14: edges (benchmark, citing, title, abstract, ...) whose citing paper has a paper number, with reports_score."""
    return cites.where(T.or_empty(F.col("citing")) != "").withColumn("reports_score", reports_score(F.col("title"), F.col("abstract")))


def citation_impact(edges: DataFrame) -> DataFrame:
    """AG-35: benchmarks, pairs and different citing papers of all edges."""
    return edges.agg(F.count_distinct("benchmark").alias("benchmarks"), F.count("*").alias("pairs"), F.count_distinct("citing").alias("citing"))


def harvested(categories: Column, title: Column, abstract: Column) -> Column:
    """FIL-02: a kept category and a word of speech; outside the core categories a word of evaluation too."""
    has = lambda names: F.arrays_overlap(F.coalesce(categories, F.array().cast("array<string>")), F.array(*[F.lit(n) for n in names]))
    text = F.concat_ws(" ", T.or_empty(title), T.or_empty(abstract))
    return has(KEEP_CATS) & text.rlike(MODALITY) & (has(CORE_CATS) | text.rlike(SIGNAL))


def crawl_window(days: Column, until: Column, as_of: Column) -> Column:
    """FN-49: struct(since, until): the look-back is never shorter than LOOK_BACK days, the end never after yesterday."""
    last = F.least(until, F.date_sub(as_of, 1))
    return F.struct(F.date_sub(as_of, F.greatest(days, F.lit(LOOK_BACK))).alias("since"), F.coalesce(last, F.date_sub(as_of, 1)).alias("until"))


def benchmark_mentions(mentions: DataFrame, stop: tuple[str, ...] = NOT_A_BENCHMARK) -> DataFrame:
    """FIL-07: mentions with a name that isn't on the stop list; names are compared by their key, which is added."""
    key = T.mention_key(F.col("name"))
    keys = [T.mention_key(F.lit(s)) for s in stop]
    return mentions.withColumn("key", key).where((F.col("key") != "") & ~F.col("key").isin(*keys))


def assembled(classified: DataFrame, meta: DataFrame, roster: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """FIL-08, JN-07: classified entries with their metadata and roster row, valid categories, and the reason if they are dropped.

    classified: key, name, in_scope, paper, categories; meta: paper, title, date (one row for each paper); roster: key, mentions;
    taxonomy: id. The reason is null of entries that get in. Facts (title, date) come from the metadata alone.
    """
    valid = taxonomy.agg(F.collect_set("id").alias("valid"))  # one row, of a curated list
    rows = classified.join(meta, "paper", "left").join(roster, "key", "left").crossJoin(F.broadcast(valid))
    cats = F.array_intersect(F.coalesce("categories", F.array().cast("array<string>")), "valid")
    why = F.when(~F.coalesce("in_scope", F.lit(False)), "out of scope").when(F.col("title").isNull(), "no metadata").when(F.size("valid_categories") == 0, "no valid category")
    return rows.withColumn("valid_categories", cats).withColumn("reason", why).drop("valid")


def unknown_categories(entries: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """JN-02: id, category of categories that the taxonomy doesn't have."""
    each = entries.select("id", F.explode("categories").alias("category")).distinct()
    return each.join(taxonomy.select(F.col("id").alias("category")).distinct(), "category", "left_anti").select("id", "category")


def slots(entries: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """JN-02, AG-04: entry-category pairs of each group of the taxonomy."""
    groups = taxonomy.select(F.col("id").alias("category"), "group_name").distinct()
    return entries.select(F.explode("categories").alias("category")).join(groups, "category").groupBy("group_name").agg(F.count("*").alias("slots"))


def site_of(status: Column, city: Column, lat: Column, lon: Column, placed: Column, sites: Column) -> Column:
    """FN-29: where an occurrence is shown: nowhere if unplaced; its own coordinates; else its institution's first site; null of none."""
    first = F.get(sites, 0)
    return F.when(status == "unplaced", None).when(lat.isNotNull() & lon.isNotNull(), F.struct(city.alias("city"), lat.alias("lat"), lon.alias("lon"), F.coalesce(placed, F.lit("default")).alias("placed"))).when(
        first.isNotNull(), F.struct(first["city"].alias("city"), first["lat"].alias("lat"), first["lon"].alias("lon"), F.lit("default").alias("placed"))
    )


def answered(asked: DataFrame, response: DataFrame) -> DataFrame:
    """JN-24: what was asked for (batch, ord, id) with what came at its place (batch, ord, found); found is false of empty places."""
    rows = asked.join(response, ["batch", "ord"], "left")
    return rows.withColumn("hit", F.col("found").isNotNull())


def missing_by_batch(asked: DataFrame, got: DataFrame, size: int = 100) -> DataFrame:
    """SRC-09: of ids asked for in batches (ord from 0 on), those of each batch and those without metadata."""
    rows = asked.withColumn("batch", F.floor(F.col("ord") / size)).join(got.select("id").distinct().withColumn("_there", F.lit(True)), "id", "left")
    return rows.groupBy("batch").agg(F.count("*").alias("asked"), F.count_if(F.col("_there").isNull()).alias("missing"))


def with_failures(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ST-06: rows of queries that worked, the first of each id, and a warning for each query that failed; the run goes on.

    results: query, ord, id, error (null if it worked).
    """
    good = results.where("error is null").groupBy("id").agg(F.min_by("query", F.struct("ord", "query")).alias("query"))
    warnings = results.where("error is not null").select("query", F.concat(F.lit("query failed: "), F.substring("error", 1, 90)).alias("warning")).distinct()
    return good, warnings


def run_log(at: Column, scanned: Column, flagged: Column, shown: Column, warnings: Column) -> Column:
    """SNK-11: the line that a run appends to its log."""
    status = F.when(F.size(warnings) > 0, F.concat(F.lit("WARN("), F.array_join(warnings, "; "), F.lit(")"))).otherwise("OK")
    return F.concat(at, F.lit(" scanned="), scanned.cast("string"), F.lit(" flagged="), flagged.cast("string"), F.lit(" shown="), shown.cast("string"), F.lit(" "), status)


def shown_rows(rows: DataFrame, query: str = "", kind: str = "all", state: str = "all") -> DataFrame:
    """FIL-20: rows (text, kind, state) that a reader's filter shows: the text has the query without case, kind and state are chosen."""
    return rows.where(F.contains(F.lower(T.or_empty(F.col("text"))), F.lit(query.lower())) & ((F.lit(kind) == "all") | (F.col("kind") == kind)) & ((F.lit(state) == "all") | (F.col("state") == state)))


def bucketed(issues: DataFrame) -> DataFrame:
    """UP-04: issues (bucket, id) in long form: the count of each bucket and its least id; their lists stay rows."""
    return issues.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
