"""Hard negatives by a two-dimensional block matrix product.

Rows and anchors are dealt into blocks and their vectors into chunks of dimensions; a shard is a block's chunk. Every row shard
meets every anchor shard of its chunk once: shards are named by (group, row block, anchor block, chunk) and joined on that name,
so a task never holds more than two shards and their partial score tile (int64). Partial tiles are shuffled by (group, row block,
anchor block) and added; each sum is reduced at once to the tile's best rows for each anchor, or for each window of scores, and
the best of all tiles are chosen by rank. No tile is written, and nothing larger than a tile is held.

The product runs twice: anchors against rows of their own label, grouped by label, for the positives; then anchors, with their
positives, against all rows for the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.llm._common import materialise, small
from colophon.llm._vectors import integers, usable

#: Positives of an anchor, negatives of a window, the window's bounds in per cent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Rows and anchors of a block, dimensions of a chunk.
ROWS, ANCHORS, CHUNK = 1024, 256, 32
NONE = -(1 << 62)


def _shards(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, block, vec_id, label, vector, positives) sorted by block and id; gives the block's shards, one for each chunk."""
    key, held = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        ids, labels, vectors, positives = (pa.concat_arrays([h[k] for h in held]) for k in range(4))
        x = integers(vectors, dims)
        chunks = range(0, dims, CHUNK)
        # names, labels and positives go with the first chunk only
        only = lambda a: pa.ListArray.from_arrays(pa.array([0] + [len(a)] * len(chunks), pa.int32()), a)
        cells = [np.ascontiguousarray(x[:, c : c + CHUNK]).astype("<i4").tobytes() for c in chunks]
        n = len(chunks)
        yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([len(ids)] * n, pa.int32()), pa.array(cells, pa.binary()), only(ids), only(labels), only(positives)], ["group", "block", "chunk", "n", "cells", "ids", "labels", "positives"])

    for batch in batches:
        groups, blocks = batch.column("group").to_pylist(), batch.column("block").to_pylist()
        cuts = [0, *[k for k in range(1, len(groups)) if (groups[k], blocks[k]) != (groups[k - 1], blocks[k - 1])], len(groups)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                if (groups[a], blocks[a]) != key:
                    yield from flush()
                    key, held = (groups[a], blocks[a]), []
                held.append([batch.column(c).slice(a, b - a) for c in ("vec_id", "label", "vector", "positives")])
    yield from flush()


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, as int64. By floats where every partial sum fits 53 bits, else by integers."""
    if len(a) and len(b) and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of shards; gives each pair's partial tile, anchors by rows."""
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            n, m = one.column("n")[0].as_py(), one.column("a_n")[0].as_py()
            rows = np.frombuffer(one.column("cells")[0].as_buffer(), "<i4").reshape(n, -1)
            anchors = np.frombuffer(one.column("a_cells")[0].as_buffer(), "<i4").reshape(m, -1)
            tile = product(anchors, rows).tobytes()
            keep = ["group", "row_block", "anchor_block", "chunk", "ids", "labels", "a_ids", "a_labels", "a_positives"]
            yield pa.RecordBatch.from_arrays([*[one.column(c) for c in keep], pa.array([tile], pa.binary())], [*keep, "tile"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The summed tiles of rows sorted by tile and chunk, with the row of the first chunk."""
    key, total, head = None, None, None
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            name = tuple(one.column(c)[0].as_py() for c in ("group", "row_block", "anchor_block"))
            part = np.frombuffer(one.column("tile")[0].as_buffer(), "<i8")
            if name != key:
                if head is not None:
                    yield total, head
                key, total, head = name, part.copy(), one
            else:
                total += part
    if head is not None:
        yield total, head


def _codes(*labels: pa.Array) -> list[np.ndarray]:
    """Labels (text) as numbers that are equal where the labels are."""
    both = pa.concat_arrays([x.cast(pa.string()) for x in labels]).dictionary_encode().indices.to_numpy()
    return np.split(both, np.cumsum([len(x) for x in labels])[:-1])


def _best_positives(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of each summed tile the best k other rows of each anchor's label."""
    for total, head in _added(batches):
        ids, anchors = (head.column(c)[0].values.to_numpy() for c in ("ids", "a_ids"))
        own, of = _codes(head.column("labels")[0].values, head.column("a_labels")[0].values)
        score = np.where((own[None, :] == of[:, None]) & (ids[None, :] != anchors[:, None]), total.reshape(len(anchors), len(ids)), NONE)
        order = np.argsort(-score, axis=1, kind="stable")[:, :k]  # rows are in the order of ids, so ties go to the lesser
        best = np.take_along_axis(score, order, axis=1)
        row, at = np.nonzero(best > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(anchors[row]), pa.array(ids[order[row, at]]), pa.array(best[row, at])], ["anchor_id", "positive_id", "positive_score"])


def _best_negatives(batches: Iterator[pa.RecordBatch], k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Of each summed tile the best k rows of other labels in the window of each anchor and positive."""
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    for total, head in _added(batches):
        ids, anchors = (head.column(c)[0].values.to_numpy() for c in ("ids", "a_ids"))
        own, of = _codes(head.column("labels")[0].values, head.column("a_labels")[0].values)
        score = np.where(own[None, :] != of[:, None], total.reshape(len(anchors), len(ids)), NONE)
        order = np.argsort(-score, axis=1, kind="stable")
        falling = -np.take_along_axis(score, order, axis=1)  # ascending
        out: list[tuple] = []
        for a, positives in enumerate(head.column("a_positives")[0].as_py()):
            for p in positives or ():
                s = p["score"]
                # low * s <= 100 * score <= high * s, in whole numbers
                start = np.searchsorted(falling[a], -(high * s // 100), "left")
                stop = np.searchsorted(falling[a], (-low * s) // 100, "right")
                for j in range(start, min(stop, start + k)):
                    out.append((anchors[a], p["id"], ids[order[a, j]], s, -falling[a, j]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*out, strict=True)], names)


def _tiles(rows: DataFrame, anchors: DataFrame, dims: int) -> DataFrame:
    """Partial tiles of the product of rows and anchors of each group, dealt and sorted for `_added`."""
    sizes = rows.groupBy("group").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("row_blocks")).join(anchors.groupBy("group").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("anchor_blocks")), "group")
    sizes = materialise(sizes, "grid")

    def shards(df: DataFrame, n: str, others: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
        dealt = df.join(small(sizes), "group").select("group", block.alias("block"), "vec_id", "label", "vector", "positives")
        kinds = "group string, block int, chunk int, n int, cells binary, ids array<long>, labels array<string>, positives array<array<struct<id:long,score:long>>>"
        made = dealt.repartition("group", "block").sortWithinPartitions("group", "block", "vec_id").mapInArrow(partial(_shards, dims=dims), kinds)
        return made.join(small(sizes.select("group", F.col(others).alias("others"))), "group").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).drop("others")

    left = shards(rows, "row_blocks", "anchor_blocks").select("group", F.col("block").alias("row_block"), F.col("other").alias("anchor_block"), "chunk", "n", "cells", "ids", "labels")
    right = shards(anchors, "anchor_blocks", "row_blocks").select("group", F.col("other").alias("row_block"), F.col("block").alias("anchor_block"), "chunk", F.col("n").alias("a_n"), F.col("cells").alias("a_cells"), F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("positives").alias("a_positives"))
    kinds = "group string, row_block int, anchor_block int, chunk int, ids array<long>, labels array<string>, a_ids array<long>, a_labels array<string>, a_positives array<array<struct<id:long,score:long>>>, tile binary"
    name = ["group", "row_block", "anchor_block"]
    return left.join(right, [*name, "chunk"]).mapInArrow(_partial, kinds).repartition(*name).sortWithinPartitions(*name, "chunk")


def _first(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with their rank; tasks leave out what is behind their own first k before rows are dealt."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, anchors: Column, vector: str = "vector", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors among the rows of df (vec_id,
    label, and a column of vectors).

    A score is the inner product of floor(256 * x) of both rows' components. An anchor's positives are its best `positives`
    other rows of the same label; for each, the best `negatives` rows of another label are returned whose score is between
    `low` and `high` per cent of the positive's. Ties go to the lesser vec_id. A positive with a negative score has no window.
    anchors: a condition on vec_id.

    Rows take no part if the id or the label is null, or the vector is null, empty, or has a null or infinite component or
    NaN. vec_id is a whole number and names a row: of rows with the same id the one with the least label (as text), then the
    least vector, counts. Shorter vectors count as if they ended in zeros. Integers beyond 2**24 count as that. An empty table,
    or one without anchors, gives no rows; other columns are ignored.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col(vector).alias("vector"))
    rows = rows.where(usable("vector") & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")
    rows = materialise(rows, "rows")
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    kind = "array<struct<id:long,score:long>>"
    chosen = materialise(rows.where(anchors), "anchors")

    own = rows.select("vec_id", "label", "vector", F.lit(None).cast(kind).alias("positives"), F.col("label").alias("group"))
    asked = chosen.select("vec_id", "label", "vector", F.lit(None).cast(kind).alias("positives"), F.col("label").alias("group"))
    best = _tiles(own, asked, dims).mapInArrow(partial(_best_positives, k=positives), "anchor_id long, positive_id long, positive_score long")
    best = _first(best, ["anchor_id"], [F.desc("positive_score"), F.col("positive_id")], positives)
    best = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    best = materialise(best, "positives")  # at most `positives` in each list

    rest = own.withColumn("group", F.lit(""))
    asked = chosen.join(best, "vec_id").select("vec_id", "label", "vector", "positives", F.lit("").alias("group"))
    found = _tiles(rest, asked, dims).mapInArrow(partial(_best_negatives, k=negatives, low=low, high=high), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    found = _first(found, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.col("negative_id")], negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
