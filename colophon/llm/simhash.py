"""Near-duplicates by SimHash fingerprints and a bit-sliced search.

Fingerprints are made in Arrow batches. Links are searched among distinct fingerprints, so copies cost nothing. A fingerprint
is cut into four parts of 16 bits; two fingerprints that differ in at most two bits agree in at least two of the parts, so each
is put under six keys of 32 bits (the search is exact). Fingerprints are dealt by key and compared block by block: bit planes
are stored vertically, as words of 64 fingerprints, and a carry-save counter with planes for 1, 2 and "over" is updated for all
distances of the block at once; a block is abandoned as soon as all its distances are over the radius. Any pair in a block may
be a link, so keys with few fingerprints share a block. A key with more fingerprints than LIMIT is split further by its free
bits, again without loss, before it reaches a task.

A block gives, for each fingerprint with links, one edge to the least of its local component: no pairs of a group are listed.
Components are then found by alternating large-star and small-star steps, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import discard, materialise

RADIUS = 2
#: Most fingerprints under one key before it is split, and fingerprints in a block.
LIMIT, LANES = 4096, 1024
ALL = (1 << 64) - 1
#: Words of 64 bits in a wide fingerprint, for radii that keys can't serve.
WIDE = 4


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """The SimHash of text's word shingles of the given size, as an unsigned integer; 0 of no words."""
    words = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not words:
        return 0
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(words)]))
    if len(starts) > size:
        starts, ends = starts[: -size + 1 or None], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(words[i:j], seed) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # long texts in parts
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0])


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of WIDE words (unsigned) of a set of 64-bit hashes, each stretched by a multiplication and a shift; zeros of none."""
    counts = np.zeros((WIDE, 64), np.int64)
    for at in range(0, len(hashes), 1 << 14):  # large sets in parts
        part = hashes[at : at + (1 << 14)]
        for k in range(WIDE):
            x = part * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & ALL)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
            counts[k] += np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row of docs."""
    kind = docs.select("doc_id").schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, fp long")


def _masks(fixed: int, parts: int, keep: int) -> list[int]:
    """Masks that fix, besides `fixed`, `keep` of the `parts` parts of the free bits."""
    from itertools import combinations

    free = [b for b in range(64) if not fixed >> b & 1]
    cut = [sum(1 << b for b in p) for p in np.array_split(np.array(free, dtype=object), parts)]
    return [fixed | sum(c) for c in combinations(cut, keep)]


def linked(block: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of the block's fingerprints (unsigned) that differ in at most `radius` bits (0 to 2).

    All distances are counted at once: rows are fingerprints, columns words of 64 lanes.
    """
    n = len(block)
    width = -(-n // 64)
    bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    lanes = np.zeros((64, width * 64), np.uint8)
    lanes[:, :n] = bits.T
    planes = np.packbits(lanes, axis=1, bitorder="little").view("<u8")  # 64 planes of `width` words
    own = np.where(bits.T[:, :, None] == 1, np.uint64(ALL), np.uint64(0))  # 64 x n x 1
    ones = np.zeros((n, width), np.uint64)
    twos, over = np.zeros_like(ones), np.zeros_like(ones)
    carry = np.empty_like(ones)
    diff = np.empty_like(ones)
    unused = _unused(n, width)
    for k in range(64):
        np.bitwise_xor(planes[k][None, :], own[k], out=diff)
        np.bitwise_and(ones, diff, out=carry)
        ones ^= diff
        over |= twos & carry
        twos ^= carry
        if k % 8 == 7:
            far = over | ((twos & ones) if radius == 2 else twos if radius == 1 else twos | ones) | unused
            if far.min() == ALL:  # every distance is over the radius
                return np.empty(0, int), np.empty(0, int)
    near = ~far
    rows = np.flatnonzero(near.any(axis=1))
    i, j = np.nonzero(np.unpackbits(near[rows].view(np.uint8), axis=1, bitorder="little"))
    return rows[i], j


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes (bits x words of 64 lanes) of fingerprints (lanes x words)."""
    n = len(prints)
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
    lanes = np.zeros((bits.shape[1], -(-n // 64) * 64), np.uint8)
    lanes[:, :n] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view("<u8")


def near_lanes(planes: np.ndarray, rows: np.ndarray, radius: int) -> np.ndarray:
    """Of fingerprints `rows` (each of several words), whether each lane of the planes is within the radius: rows x words of 64 lanes.

    The counters of all distances are bit-sliced too: a difference plane is added to counter planes by carries, and a plane keeps
    what has overflowed. The block is abandoned once all its distances are over the radius.
    """
    own = np.unpackbits(rows.astype("<u8").view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little").astype(bool)
    shape = (len(rows), planes.shape[1])
    counter = [np.zeros(shape, np.uint64) for _ in range(radius.bit_length())]
    over, carry, kept = np.zeros(shape, np.uint64), np.empty(shape, np.uint64), np.empty(shape, np.uint64)

    def far() -> np.ndarray:
        more, equal = over.copy(), np.full(shape, ALL, np.uint64)
        for b in range(len(counter) - 1, -1, -1):
            if radius >> b & 1:
                equal &= counter[b]
            else:
                more |= equal & counter[b]
                equal &= ~counter[b]
        return more

    flip = np.where(own.T[:, :, None], np.uint64(ALL), np.uint64(0))
    for k in range(len(planes)):
        np.bitwise_xor(planes[k][None, :], flip[k], out=carry)
        for c in counter:
            np.bitwise_and(c, carry, out=kept)
            np.bitwise_xor(c, carry, out=c)
            carry, kept = kept, carry
        over |= carry
        if k % 64 == 63 and far().min() == ALL:
            return np.zeros(shape, np.uint64)
    return ~far()


def _unused(n: int, width: int) -> np.ndarray:
    """Lanes that don't count: those past the end, and each fingerprint's own and earlier ones (distances are symmetric)."""
    lane = np.arange(width * 64)[None, :]
    skip = (lane >= n) | (lane <= np.arange(n)[:, None])
    return np.packbits(skip, axis=1, bitorder="little").view("<u8")


def _stars(prints: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """For each linked fingerprint but the least of its component in the block, an edge to that least one."""
    parent = np.arange(len(prints))
    while True:  # pointer jumping over minima
        low = np.minimum(parent[i], parent[j])
        new = parent.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, parent[i], low)
        np.minimum.at(new, parent[j], low)
        new = new[new]
        if (new == parent).all():
            break
        parent = new
    at = np.flatnonzero(parent != np.arange(len(prints)))
    return list(zip(prints[at].tolist(), prints[parent[at]].tolist(), strict=True))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; gives edges (a, b). Keys stay whole; blocks of few lanes are filled with several keys."""
    held: list[np.ndarray] = []
    count = 0
    last_keys = None
    tail: np.ndarray | None = None

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        prints = np.unique(np.concatenate(parts))
        edges: list[tuple[int, int]] = []
        step = LANES if len(prints) > 2 * LANES else 2 * LANES
        tiles = [prints[k : k + step] for k in range(0, len(prints), step)]
        if len(tiles) == 1:
            edges = _stars(prints.view(np.int64), *linked(prints))
        else:  # a large key: each tile with itself and with each later one
            for x in range(len(tiles)):
                for y in range(x, len(tiles)):
                    both = tiles[x] if x == y else np.concatenate((tiles[x], tiles[y]))
                    edges += _stars(both.view(np.int64), *linked(both))
        if edges:
            a, b = zip(*set(edges), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        masks, values, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "value", "fp"))
        prints = prints.view(np.uint64)
        new = np.empty(len(prints), bool)
        new[0] = last_keys != (masks[0], values[0])
        new[1:] = (masks[1:] != masks[:-1]) | (values[1:] != values[:-1])
        last_keys = (masks[-1], values[-1])
        bounds = np.flatnonzero(new)
        lead = prints[: bounds[0]] if len(bounds) else prints
        tail = lead if tail is None else np.concatenate((tail, lead))
        for k, at in enumerate(bounds):
            if len(tail) > 1:  # a key with one fingerprint has no links
                if count + len(tail) > LANES and held:
                    yield from flush(held)
                    held, count = [], 0
                held.append(tail)
                count += len(tail)
            tail = prints[at : bounds[k + 1] if k + 1 < len(bounds) else None]
    if tail is not None and len(tail) > 1:
        held.append(tail)
    if held:
        yield from flush(held)


def _keyed(prints: DataFrame, limit: int) -> DataFrame:
    """mask, value, fp: each fingerprint under keys such that any two within the radius share one; no key over the limit, but for
    the last level, on which a key has at most 2**14 possible fingerprints."""
    levels = [[_signed(m) for m in _masks(0, 4, 2)]]
    under = {}
    for _ in range(2):
        for m in levels[-1]:
            under[m] = [_signed(x) for x in _masks(m & ALL, 3, 1)]
        levels.append(sorted({x for m in levels[-1] for x in under[m]}))
    narrower = F.create_map(*[F.lit(y) if k == 0 else F.array(*[F.lit(z) for z in y]) for m, xs in under.items() for k, y in enumerate((m, xs))])
    rows = prints.select("fp", F.explode(F.array(*[F.lit(m) for m in levels[0]])).alias("mask"))
    rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    out = None
    for level in range(len(levels)):
        if level + 1 == len(levels):
            out = rows if out is None else out.unionByName(rows)
            break
        counts = rows.groupBy("mask", "value").count()
        hot = materialise(counts.where(F.col("count") > limit).select("mask", "value"), f"hot{level}")
        if hot.limit(1).count() == 0:
            out = rows if out is None else out.unionByName(rows)
            break
        cold = rows.join(hot, ["mask", "value"], "left_anti")
        out = cold if out is None else out.unionByName(cold)
        split = rows.join(hot, ["mask", "value"], "left_semi").select("fp", F.explode(narrower[F.col("mask")]).alias("mask"))
        rows = split.withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
    return out.select("mask", "value", "fp")


def links(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp), a > b as signed longs or not, that connect all within the radius."""
    # a key with a single fingerprint has no links and needn't be dealt; the count is combined before its shuffle
    rows = _keyed(prints, limit)
    return rows.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(_search, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of the edges (a, b) the least node of its component, by alternating large-star and small-star.

    Each step writes its edges, so a lost executor costs at most the step. Minima are combined before their shuffle, and the
    joins are plain, so that a node with very many neighbours is split by adaptive execution.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    for step in range(60):
        # large-star: all neighbours above a node go to the least of the node and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: a node and its neighbours below go to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, now = now, materialise(small, f"stars{step}")
        discard(last)
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == tuple(got):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(got)
    raise RuntimeError("components did not settle")


def simhash_components(docs: DataFrame, size: int = 3, limit: int = LIMIT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, fingerprint (16 hexadecimal digits), component_id.

    component_id is the least doc_id that can be reached over links of fingerprints with at most two differing bits, the row's
    own included (null ids come last). Null and empty texts have no words and the fingerprint zero, which is linked like any
    other. A text with fewer words than a shingle is one shingle. Repeated rows come out as often as they go in; an empty table
    gives no rows; other columns are ignored. Texts are read whole.
    """
    rows = materialise(fingerprints(docs, size), "prints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    prints = materialise(prints, "distinct")
    roots = components(links(prints.select("fp"), limit))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
