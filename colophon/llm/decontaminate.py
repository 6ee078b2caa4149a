"""Benchmark items inside documents: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are partitioned by their number of shingles (powers of two). An item's sketch is the bottom of its shingles in the order
of a hash (a bottom-k MinHash); k depends on the partition and is more than the shingles that a match may lack, so any document
that contains enough of an item's shingles shares a value with its sketch, however long the document is: the search loses
nothing. Documents that share enough sketch values are then compared by the shingles' texts.

Documents are not shuffled for the search while the sketches are small enough to be broadcast (their bytes are counted); beyond that
they are joined by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import BROADCAST, materialise, small

SIZE, CONTAINED = 5, 0.8


def words_of(text: Column) -> Column:
    """The lower-case runs of letters and digits of a text; an empty array of null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingles(size: int, each: str) -> Column:
    """Of array column w: `each` (SQL over x, the words) of each shingle of `size` words; none of fewer words."""
    parts = ", ".join(f"w[i + {k}]" for k in range(size))
    return F.expr(f"case when size(w) >= {size} then transform(sequence(0, size(w) - {size}), i -> {each.format(parts)}) else array() end")


def _hashed(size: int) -> Column:
    return F.array_distinct(_shingles(size, "xxhash64({})").cast("array<bigint>"))


def _spelled(size: int) -> Column:
    return F.array_distinct(_shingles(size, "concat_ws(' ', {})").cast("array<string>"))


def _by_size(shingles, sizes: list[int]) -> Column:
    """shingles(k) of an item whose column k is one of the sizes."""
    out = shingles(sizes[-1])
    for k in sizes[:-1]:
        out = F.when(F.col("k") == k, shingles(k)).otherwise(out)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, contained: float = CONTAINED, most: int = BROADCAST) -> DataFrame:
    """Pairs of a document (doc_id, text) and a benchmark item (item_id, text) that it contains.

    doc_id, item_id, n_shingles (distinct shingles of the item), n_shared (of these, in the document), containment (their
    quotient, `contained` or more). Words are runs of letters and digits in lower case; shingles have `size` words. An item of
    fewer words is one shingle, and is found where its words follow each other; an item without words is never found, nor is
    anything in a null or empty text. Rows that repeat an id count as one: the most contained text gives the pair. Null ids
    are ids like others. Other columns are ignored; texts are read whole, and an empty table gives no pairs.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where("size(w) > 0").withColumn("k", F.least(F.size("w"), F.lit(size)))
    items = materialise(items, "items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect()) or [size]  # at most `size` rows

    # sketches: of each size partition (up to 2**p shingles), one more value than a match may lack
    own = items.select("item_id", _by_size(_hashed, sizes).alias("hs"), F.md5(F.concat_ws(" ", "w")).alias("version")).withColumn("n", F.size("hs"))
    upper = F.expr("cast(pow(2, ceil(log2(n))) as int)")
    may_lack = lambda n: n - F.ceil(n * F.lit(contained) - 1e-9).cast("int")
    ordered = F.transform(F.array_sort(F.transform("hs", lambda h: F.struct(F.xxhash64(h, F.lit(17)).alias("o"), h.alias("h")))), lambda x: x["h"])
    sketch = own.withColumn("sketch", F.slice(ordered, 1, may_lack(upper) + 1))
    need = F.greatest(F.lit(1), F.size("sketch") - may_lack(F.col("n")))
    sketch = sketch.select(F.xxhash64("item_id", "version").alias("item"), need.alias("need"), F.explode("sketch").alias("h"))
    sketch = small(materialise(sketch, "sketch"), most)

    # a document's shingles of all the items' sizes, from one split into words
    every = lambda f: F.concat(*[f(k) for k in sizes])
    texts = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    hits = texts.select("doc_id", F.explode(every(_hashed)).alias("h")).join(sketch, "h")
    candidates = hits.groupBy("doc_id", "item").agg(F.count("*").alias("c"), F.min("need").alias("need")).where("c >= need")
    candidates = small(materialise(candidates.select(F.col("doc_id").alias("_id")).distinct(), "candidates"), most)

    near = docs.join(candidates, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    near = near.select("doc_id", F.md5("text").alias("row"), words_of(F.col("text")).alias("w")).select("doc_id", "row", F.explode(every(_spelled)).alias("s"))
    # a shingle's text has its number of words, so shingles of different sizes never meet
    spelled = items.select("item_id", F.md5(F.concat_ws(" ", "w")).alias("version"), _by_size(_spelled, sizes).alias("ss")).withColumn("n_shingles", F.size("ss"))
    spelled = small(materialise(spelled.select("item_id", "version", "n_shingles", F.explode("ss").alias("s")).distinct(), "spelled"), most)
    shared = near.join(spelled, "s").select("doc_id", "row", "item_id", "version", "n_shingles", "s").distinct()
    counted = shared.groupBy("doc_id", "row", "item_id", "version", "n_shingles").agg(F.count("*").alias("n_shared"))
    counted = counted.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    found = counted.where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(contained) - 1e-9))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_shingles")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_shingles", "m.n_shared", "m.containment")
