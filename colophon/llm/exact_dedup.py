"""Exact duplicates by deterministic block naming.

Each text, without white space, is cut into blocks of fixed size. The distinct blocks of the corpus are sorted and numbered;
then adjacent pairs of numbers are sorted and numbered, level by level, until one number is left of each text. Two texts
have the same number on the same level exactly if they are equal, whatever any hash function does.

Only one shuffle carries text (the distinct blocks, combined on the map side first, so copies cost nothing there); all others
carry integers. A block is addressed by a 64-bit hash as long as all blocks with that hash are equal, which is tested; blocks
whose hash is shared by different blocks are joined by their bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import materialise, no_spaces

BLOCK_BYTES = 4096
KEY = ["doc_id", "n_points", "text_sha256"]


def _hash64(block: Column) -> Column:
    return F.xxhash64(block)


def _blocks(size: int) -> Column:
    """Of column t (binary): its blocks; one empty block of an empty text."""
    return F.expr(f"transform(sequence(0L, greatest(octet_length(t) - 1, 0) div {size}L), i -> substring(t, cast(i * {size} + 1 as int), {size}))")


def _named(keys: DataFrame, cols: list[str], name: str) -> DataFrame:
    """The rows of keys, sorted by cols and numbered in that order; written once, so a number never changes."""
    return materialise(keys.orderBy(*cols).withColumn("name", F.monotonically_increasing_id()), name)


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash64=_hash64) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so without the characters of [\\x20\\x09-\\x0D]; null counts as empty, and all empty texts are
    equal. Of equal texts the row with the most code points stays, then the one with the smallest doc_id (null last). Of rows
    that repeat both, one stays. Other columns of docs, whatever their names, are ignored; an empty table gives no rows.
    Texts of any length are compared whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.char_length(text).alias("n_points"), no_spaces(text).cast("binary").alias("t"))
    base = base.select("doc_id", "n_points", "t", F.sha2("t", 256).alias("text_sha256"))
    cut = base.select(*KEY, _blocks(block_bytes).alias("blocks"))

    # Rows that repeat id, length and text count once from here on.
    hashed = cut.select(*KEY, F.transform("blocks", hash64).alias("hs"))
    rows = materialise(hashed.groupBy(*KEY, "hs").agg(F.count("*").alias("copies")), "rows")

    # Level 0: the distinct blocks. A hash whose smallest and largest block differ is shared by different blocks.
    blocks = cut.select(F.explode("blocks").alias("block")).select(hash64(F.col("block")).alias("h"), "block")
    by_hash = materialise(blocks.groupBy("h").agg((F.min("block") != F.max("block")).alias("shared")), "hashes")
    names = by_hash.where(~F.col("shared")).select("h", F.lit(None).cast("binary").alias("block"))
    shared = by_hash.where("shared").select("h")
    any_shared = shared.limit(1).count() > 0
    if any_shared:
        names = names.unionByName(blocks.join(shared, "h", "left_semi").distinct())
    names = _named(names, ["h", "block"], "level0")

    leaves = rows.select(*KEY, "copies", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
    level = leaves.join(names.where("block is null").select("h", "name"), "h").drop("h")
    if any_shared:
        texts = cut.select(*KEY, F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block")).withColumn("h", hash64(F.col("block")))
        texts = texts.join(shared, "h", "left_semi").distinct()
        texts = texts.join(names.where("block is not null"), ["h", "block"]).select(*KEY, "n", "pos", "name")
        copies = rows.select(*[F.col(k).alias(f"_{k}") for k in KEY], "copies")
        texts = texts.join(copies, F.expr(" and ".join(f"{k} <=> _{k}" for k in KEY)))
        level = level.unionByName(texts.select(*level.columns))
    level = materialise(level, "names0")

    # Levels above: adjacent pairs; -1 stands for no right neighbour.
    most = rows.agg(F.max(F.size("hs"))).first()[0] or 1
    done = [level.where("n = 1").withColumn("level", F.lit(0))]
    for k in range(1, math.ceil(math.log2(most)) + 1):
        pairs = level.where("n > 1").groupBy(*KEY, F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max("copies").alias("copies"), F.ceil(F.max("n") / 2).cast("int").alias("n"),
            F.max(F.expr("case when pos % 2 = 0 then name end")).alias("a"), F.coalesce(F.max(F.expr("case when pos % 2 = 1 then name end")), F.lit(-1)).alias("b"),
        )
        pairs = materialise(pairs, f"pairs{k}")
        names = _named(pairs.select("a", "b").distinct(), ["a", "b"], f"level{k}")
        level = materialise(pairs.join(names, ["a", "b"]).drop("a", "b"), f"names{k}")
        done.append(level.where("n = 1").withColumn("level", F.lit(k)))

    identity = done[0].select(*KEY, "copies", "level", "name")
    for more in done[1:]:
        identity = identity.unionByName(more.select(*identity.columns))
    best = F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    groups = identity.groupBy("level", "name").agg(F.sum("copies").alias("group_size"), F.min(best).alias("best"))
    out = identity.join(groups, ["level", "name"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    stays = (F.col("copy") == 1) & (F.col("n_points") == -F.col("best.p")) & F.col("doc_id").eqNullSafe(F.col("best.id"))
    return out.select("doc_id", F.col("best.id").alias("keep_id"), "group_size", stays.alias("kept"), "text_sha256")
