"""Vectors as codes: a product quantiser on integers, with nearest entries found by segment-mean lower bounds.

A vector is cut into equal parts; each part position has a codebook, fitted by rounds of assignment and floored means. To find
an entry nearest to a part, both are summarised coarse to fine: over blocks (the whole part, then halves, down to two
components), by their means and the norm of what the means leave. For a block of b components the squared distance is
b * (difference of means)**2 plus the squared distance of the residuals, and that is at least the squared difference of their
norms; the sum over blocks is a lower bound. Entries whose bound, less a margin for rounding, is over the exact distance to the
entry with the least coarse bound are dropped, level by level; the others get exact integer distances.

Each round reads the vectors once: tasks add up their parts by entry, and the sums of a task (parts x entries rows) are
combined before they meet. The driver holds the codebooks only (parts x entries x components of a part).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import materialise, small
from colophon.llm._vectors import integers, usable

#: Parts of a vector, entries of a codebook, rounds of fitting.
PARTS, ENTRIES, ROUNDS = 16, 64, 2


def _levels(width: int) -> list[list[slice]]:
    """Blocks of a part, from the whole to blocks of two components (or the whole only)."""
    out, blocks = [], [slice(0, width)]
    while True:
        out.append(blocks)
        if all(b.stop - b.start < 4 for b in blocks):
            return out
        blocks = [h for b in blocks for h in (slice(b.start, (b.start + b.stop) // 2), slice((b.start + b.stop) // 2, b.stop))]


def _summary(x: np.ndarray, blocks: list[slice]) -> np.ndarray:
    """For each block the mean, times the root of its size, and the norm of the residual: rows x blocks x 2."""
    out = np.empty((len(x), len(blocks), 2))
    for k, b in enumerate(blocks):
        own = x[:, b].astype(np.float64)
        mean = own.mean(axis=1)
        out[:, k, 0] = mean * np.sqrt(b.stop - b.start)
        out[:, k, 1] = np.sqrt(((own - mean[:, None]) ** 2).sum(axis=1))
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x (integers) the nearest entry by squared Euclidean distance, the least index of ties, and that distance."""
    n = len(x)
    levels = _levels(x.shape[1])
    own, of = [_summary(x, b) for b in levels], [_summary(entries, b) for b in levels]
    # the coarsest bound for all pairs: one block
    bound = (own[0][:, 0, 0, None] - of[0][None, :, 0, 0]) ** 2 + (own[0][:, 0, 1, None] - of[0][None, :, 0, 1]) ** 2
    first = bound.argmin(axis=1)
    most = ((x - entries[first]) ** 2).sum(axis=1)
    margin = lambda b: b * (1 - 1e-9) - 1e-6  # noqa: E731  floats may be off by some units in the last place
    row, entry = np.nonzero(margin(bound) <= most[:, None])
    for k in range(1, len(levels)):
        fine = ((own[k][row] - of[k][entry]) ** 2).sum(axis=(1, 2))
        stays = margin(fine) <= most[row]
        row, entry = row[stays], entry[stays]
    exact = ((x[row] - entries[entry]) ** 2).sum(axis=1)
    starts = np.searchsorted(row, np.arange(n))  # each row keeps its nearest entry, so none is without
    least = np.minimum.reduceat(exact, starts) if n else np.empty(0, np.int64)
    hit = np.flatnonzero(exact == least[row])
    return entry[hit[np.searchsorted(row[hit], np.arange(n))]], least


def _assigned(vectors: pa.Array, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of a column of vectors: first row, integers (rows x parts x width), indexes and distances (rows x parts)."""
    parts, _, width = books.shape
    for at in range(0, len(vectors), 2048):
        x = integers(vectors.slice(at, 2048), parts * width).reshape(-1, parts, width)
        got = [nearest(x[:, p], books[p]) for p in range(parts)]
        yield at, x, np.stack([g[0] for g in got], axis=1), np.stack([g[1] for g in got], axis=1)


def _fitted(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: each entry becomes the floored mean of the parts that are nearest to it."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            for _, x, index, _ in _assigned(batch.column("vector"), books):
                slot = (index + np.arange(parts) * entries).ravel()
                flat = x.reshape(-1, width)
                for k in range(width):  # exact: sums of fewer than 2**29 components stay below 2**53
                    total[:, k] += np.bincount(slot, flat[:, k], minlength=parts * entries).astype(np.int64)
                count += np.bincount(slot, minlength=parts * entries)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used]), *[pa.array(total[used, k]) for k in range(width)]], ["slot", "n", *[f"s{k}" for k in range(width)]])

    columns = ["n", *[f"s{k}" for k in range(width)]]
    sums = rows.mapInArrow(run, f"slot long, {', '.join(f'{c} long' for c in columns)}").groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns])
    new = books.reshape(parts * entries, width).copy()
    for row in sums.collect():  # parts x entries rows at most
        new[row["slot"]] = [row[c] // row["n"] for c in columns[1:]]
    return new.reshape(books.shape)


def vector_codes(df: DataFrame, vector: str = "vector", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for each usable row of df (vec_id, label, and a column of vectors).

    Components become floor(256 * x). Each part position's codebook starts as that part of the `entries` least vec_ids; each of
    the rounds assigns every part to its nearest entry (ties: the lower index) and replaces each entry by the floored mean of
    its parts; an entry without parts stays. code: two hexadecimal digits for each part; error: the squared distances, summed
    over the parts; label_error: error summed over rows with the same label, nulls together (null if it is over 64 bits).

    Rows whose vector is null, empty, or has a null or infinite component or NaN are left out. A null vec_id comes after all
    others. Rows with equal ids start one entry, that of the least vector. The vector of the least id has the length that counts:
    shorter ones end in zeros, longer ones are cut, and it is filled up with zeros to a multiple of `parts`. Integers beyond
    2**24 count as that (so distances of up to 4096 components fit 64 bits). With fewer ids than entries the codebooks are
    smaller. Repeated rows come out as often as they go in; an empty table gives no rows; other columns are ignored.
    """
    assert 0 < entries <= 256
    rows = df.select("vec_id", "label", F.col(vector).alias("vector")).where(usable("vector"))
    order = F.asc_nulls_last("vec_id")
    # the least rows, of equal ids one: at most `entries` rows
    first = rows.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(order).limit(entries).collect()
    first.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] if r["vec_id"] is not None else 0))
    width = -(-(len(first[0]["vector"]) if first else 1) // parts)
    start = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), parts * width)
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    if first:
        for _ in range(rounds):
            books = _fitted(rows.select("vector"), books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    digits = np.array([f"{k:02x}" for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, index, distance in _assigned(batch.column("vector"), books):
                n = len(index)
                codes = ["".join(row) for row in digits[index]]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").slice(at, n), batch.column("label").slice(at, n), pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    coded = materialise(rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    total = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("label_error"))
    total = materialise(total.select(F.col("label").alias("_label"), "label_error"), "label_errors")
    out = coded.join(small(total), coded["label"].eqNullSafe(total["_label"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
