"""Pools of candidate records: first-seen merge, coverage, mention merge, alias chains, batches and feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.sources.tables import scratch


def first_seen(tagged: DataFrame, by: str, source: str, order: list[Column | str]) -> DataFrame:
    """WN-02: one row for each id: the first source, all sources in order (found_in, may repeat) and the distinct ones (found_by)."""
    place = F.struct(*order)
    agg = tagged.groupBy(by).agg(F.min_by(source, place).alias("first_source"), F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col(source).alias("s")))).alias("all"))
    seen = F.transform("all", lambda x: x["s"])
    return agg.select(by, "first_source", seen.alias("found_in"), F.array_distinct(seen).alias("found_by"))


def sources_of(tagged: DataFrame, by: str, source: str, order: list[Column | str]) -> DataFrame:
    """WN-02 with bounded rows: one row for each id: the first source, and of each source its first place and its rows, by that place.

    Rows are counted for each id and source before they meet, so an id that is found very often is no long list.
    """
    each = tagged.groupBy(by, source).agg(F.min(F.struct(*order)).alias("place"), F.count("*").alias("n"))
    found = F.array_sort(F.collect_list(F.struct("place", F.col(source).alias("source"), "n")))
    return each.groupBy(by).agg(F.min_by(source, "place").alias("first_source"), found.alias("found"))


def coverage(pool: DataFrame, score: str | None = None) -> DataFrame:
    """AG-14: of each first source its ids, and those that several sources have; with a score also the ids of 20 or more, of 8 to
    below 20, and below 8.

    pool: one row for each id, with first_source and an array `found_by` or `found` of its sources.
    """
    several = F.size("found_by" if "found_by" in pool.columns else "found") > 1
    bands = [] if score is None else [F.count_if(F.col(score) >= 20).alias("score_ge_20"), F.count_if((F.col(score) >= 8) & (F.col(score) < 20)).alias("score_8_19"), F.count_if(F.col(score) < 8).alias("score_lt_8")]
    return pool.groupBy("first_source").agg(F.count("*").alias("ids"), F.count_if(several).alias("several"), *bands)


def per_source(pool: DataFrame) -> DataFrame:
    """AG-14: records and ids of each source, from `sources_of`."""
    return pool.select(F.explode("found").alias("f")).groupBy(F.col("f.source").alias("source")).agg(F.sum("f.n").alias("records"), F.count("*").alias("ids"))


def batches(df: DataFrame, size: int, order: list[Column | str], partitions: int | None = None) -> DataFrame:
    """WN-07, SNK-04: batch numbers of `size` rows in a global order.

    The rows are range-partitioned and sorted by the order, and written once to the shared folder with their partition and their
    place in it; a row's place is that and the rows of the partitions before, which are counted in what was written. (Planned
    twice, the ranges could be cut differently on the two sides.) Only the partitions' counts meet in one task. Rows that are
    equal in the order are numbered as they come.
    """
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    path = scratch(df.sparkSession, "ranked")
    # the lower 33 bits number the rows of a partition
    ranked = spread.sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_rank": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    ranked.write.parquet(path)
    ranked = df.sparkSession.read.schema(ranked.schema).parquet(path)
    counts = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranked.join(counts.select("_part", before.alias("_before")), "_part")
    return placed.withColumn("batch", F.floor((F.col("_before") + F.col("_rank")) / size) + 1).drop("_part", "_rank", "_before")


def numbered_in(df: DataFrame, key: str, order: list[Column | str], name: str) -> DataFrame:
    """FN-17: df with the number of each row among those of its key, from 1 on, in the order.

    Rows are numbered over all keys by ranges, and count from their key's first place, so a frequent key isn't sorted in one task.
    """
    placed = batches(df, 1, [F.col(key), *order])
    first = placed.groupBy(key).agg(F.min("batch").alias("_first"))
    rows = placed.join(first.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")))
    return rows.withColumn(name, F.col("batch") - F.col("_first") + 1).drop("batch", "_first", "_key")


def single_hop_aliases(mentions: DataFrame) -> DataFrame:
    """GR-02: key, target: keys that share a paper with an earlier key become it, in one hop; the last such paper decides.

    mentions: ord, key, paper. A paper belongs to the key that named it first; a key's own papers don't alias it. Keys are
    visited in the order of their first mention, and their mentions in order.
    """
    first_of_key = mentions.groupBy("key").agg(F.min("ord").alias("key_ord"))
    named = mentions.where(F.col("paper").isNotNull()).join(first_of_key, "key")
    owner = named.groupBy("paper").agg(F.min_by("key", F.struct("key_ord", "ord")).alias("owner"))
    other = named.join(owner, "paper").where("owner <> key")
    return other.groupBy("key").agg(F.max_by("owner", "ord").alias("target"))


def mode_first_seen(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """AG-13: the most frequent value of each group; of equally frequent ones the first seen. Null and empty ones don't count."""
    counts = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", (-F.col("at")).alias("first"))).alias(value))


def merged_mentions(mentions: DataFrame, lines: int = 4, sources: int = 5) -> DataFrame:
    """AG-13: one record for each key of the mentions: ord, key, name, full_title, paper, url, year, category, one_line, evidence.

    name, full_title, paper, url and year are the most frequent values, the first seen of equals; aliases are the other names, by
    name; conflicts the other papers and categories all categories, most frequent first; one_lines the first `lines` of these;
    sources the least `sources` distinct evidence texts (110 characters of each; a missing one is the empty text). Null and empty
    values don't count but as evidence. mention_count counts the rows.

    Values are taken apart into (field, value) rows, counted before they meet, and only a field's distinct values are ranked:
    no list of a key's mentions is made. The lists of names, papers and categories hold distinct values.
    """
    filled = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    fields = {"name": filled("name"), "title": filled("full_title"), "paper": filled("paper"), "url": filled("url"), "year": filled("year"), "category": filled("category"), "source": F.substring(F.coalesce(F.col("evidence"), F.lit("")), 1, 110)}
    # a one_line counts in its place, not as a value, so equal ones stay apart
    cells = [F.struct(F.lit(k).alias("field"), v.alias("value"), F.lit(None).cast("long").alias("line")) for k, v in fields.items()]
    cells += [F.struct(F.lit("line").alias("field"), filled("one_line").alias("value"), F.col("ord").cast("long").alias("line")), F.struct(F.lit("rows").alias("field"), F.lit("").alias("value"), F.lit(None).cast("long").alias("line"))]
    long = mentions.select("key", F.col("ord").cast("long").alias("ord"), F.explode(F.array(*cells)).alias("c")).select("key", "ord", "c.*").where("value is not null")
    counted = long.where("field <> 'line'").groupBy("key", "field", "value").agg(F.count("*").alias("n"), F.min("ord").alias("at"))
    by_count = Window.partitionBy("key", "field").orderBy(F.desc("n"), "at")
    by_value = Window.partitionBy("key", "field").orderBy("value")
    # of lines and sources only the first ones are kept; the window keeps so many of each task before rows are dealt
    ranked = counted.where("field <> 'source'").withColumn("r", F.row_number().over(by_count))
    least = counted.where("field = 'source'").withColumn("r", F.row_number().over(by_value)).where(F.col("r") <= sources)
    first = long.where("field = 'line'").withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("line"))).where(F.col("r") <= lines)
    first = first.select("key", "field", "value", F.lit(1).cast("long").alias("n"), F.col("line").alias("at"), "r")
    rows = ranked.unionByName(least).unionByName(first)
    mode = lambda f: F.max(F.when((F.col("field") == f) & (F.col("r") == 1), F.col("value")))
    listed = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("r", "value")))), lambda x: x["value"])
    is_ = lambda f: F.col("field") == f
    return rows.groupBy("key").agg(
        mode("name").alias("name"), F.array_sort(F.collect_list(F.when(is_("name") & (F.col("r") > 1), F.col("value")))).alias("aliases"), mode("title").alias("full_title"), mode("paper").alias("paper"),
        listed(is_("paper") & (F.col("r") > 1)).alias("conflicts"), mode("url").alias("url"), mode("year").alias("year"), listed(is_("category")).alias("categories"), listed(is_("line")).alias("one_lines"),
        F.sum(F.when(is_("rows"), F.col("n"))).alias("mention_count"), listed(is_("source")).alias("sources"),
    )


def feed(fresh: DataFrame, previous: DataFrame, size: int = 60) -> DataFrame:
    """SO-01, SE-02, ST-04: fresh entries by score and date, then the previous ones that aren't among them, at most `size`."""
    old = previous.join(fresh.select("id"), "id", "left_anti").withColumn("fresh", F.lit(False))
    both = fresh.withColumn("fresh", F.lit(True)).withColumn("place", F.lit(0).cast("long")).unionByName(old)
    return both.orderBy(F.desc("fresh"), F.when(F.col("fresh"), F.col("score")).desc(), F.when(F.col("fresh"), F.col("published")), "place", "id").limit(size)
