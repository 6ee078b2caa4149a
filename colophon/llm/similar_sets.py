"""Texts with alike sets of word shingles: candidates from MinHash bands, a packed sketch as a filter, confirmation on whole sets.

Everything after the first pass works on distinct sets ("nodes"), so copies cost nothing. Nodes under a common band form a group;
`linked` finds a group's connections without listing its pairs: each node is compared with the group's least one first, and only
nodes that aren't linked to it are compared with the group's others, dealt in tiles of BLOCK by BLOCK nodes, so that no group
meets in one task, whatever its size. Bands with sketches name candidates; the components of these are the groups that are
confirmed by their sets, which are read again for candidates only. Every step's table is written to the shared folder.

Two sets with a similarity of s share no band with a probability of (1 - s**ROWS)**BANDS: 8e-7 at 0.85, 7e-5 at 0.8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import discard, materialise, small
from colophon.llm.simhash import components

#: Bands, MinHash rows in each, minima in all, nodes in one side of a tile, shingles in one side of a tile.
BANDS, ROWS, MINIMA, BLOCK, WEIGHT = 24, 5, 128, 128, 1 << 18
_ODD = np.random.default_rng(42).integers(0, 2**32, (2, MINIMA), dtype=np.uint32) | np.uint32(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Sketch:
    """What is kept of a set besides its bands, and the pairs that it doesn't rule out.

    of: bytes of a set and its minima, as many for each set, in whole words of 64 bits. pairs: of two aligned tables of sketches
    (sets x words) with the sets' sizes, whether each pair may be alike. tile: the same for each row of the first with each of
    the second.
    """

    of: Callable[[np.ndarray, np.ndarray], bytes]
    pairs: Callable[..., np.ndarray]
    tile: Callable[..., np.ndarray]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of `size` words; a text of fewer words is one shingle, one of no words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = max(len(h) - size + 1, 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        out = _mixed(out * _MIX + h[k : k + n])
    return np.unique(out)


def minima(s: np.ndarray) -> np.ndarray:
    """MINIMA least values of a set, each under a function of its own."""
    low = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    least = np.full(MINIMA, ~np.uint32(0))
    for k in range(0, len(s), 2048):
        part = low[k : k + 2048, None] * _ODD[0]
        part ^= part >> np.uint32(15)
        part *= _ODD[1]
        part ^= part >> np.uint32(13)
        least = np.minimum(least, part.min(axis=0))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One hash for each band, different between bands."""
    rows = least[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        out = _mixed(out * _MIX + rows[:, k])
    return out.view(np.int64)


def node_of(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes())


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def signatures(docs: DataFrame, size: int, sketch: Sketch) -> DataFrame:
    """doc_id, key, node (a hash of the row's set), n (its size), sketch and bands of each row of docs (doc_id, key, text)."""
    kind = docs.select("doc_id").schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                nodes, n, kept, cells = [], [], [], []
                for text in batch.column("text").to_pylist():
                    s = shingles(text, size)
                    least = minima(s)
                    nodes.append(node_of(s))
                    n.append(len(s))
                    kept.append(sketch.of(s, least))
                    cells.append(bands(least) if len(s) else np.empty(0, np.int64))  # an empty set is like none
                cols = [batch.column("doc_id"), batch.column("key"), _signed(nodes), pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(cells, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "key", "node", "n", "sketch", "bands"])

    return docs.select("doc_id", "key", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, key long, node long, n long, sketch binary, bands array<long>")


def sets_of(docs: DataFrame, size: int, sketch: Sketch) -> DataFrame:
    """node, n, sketch, items (the set's hashes as bytes) of each row of docs (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                sets = [shingles(t, size) for t in whole.slice(at, 100).column("text").to_pylist()]
                cols = [_signed([node_of(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch.of(s, minima(s)) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["node", "n", "sketch", "items"])

    return docs.select("text").mapInArrow(run, "node long, n long, sketch binary, items binary")


def _words(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<u8").reshape(len(cells), -1)


def _alike(shared: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | bool:
    return 100 * shared >= percent * (a + b - shared)


def _against_first(batches: Iterator[pa.RecordBatch], sketch: Sketch, percent: int | None) -> Iterator[pa.RecordBatch]:
    """Rows of a node (node, n, sketch, items) and its group's first one (first_...); adds whether they are alike."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            get = lambda c: batch.column(c).to_pylist()  # noqa: E731, B023
            n, m = batch.column("n").to_numpy(), batch.column("first_n").to_numpy()
            ok = sketch.pairs(_words(get("sketch")), n, _words(get("first_sketch")), m)
            if percent is not None:
                a, b = batch.column("items"), batch.column("first_items")
                for k in np.flatnonzero(ok):
                    shared = len(np.intersect1d(np.frombuffer(a[k].as_py(), "<u8"), np.frombuffer(b[k].as_py(), "<u8"), assume_unique=True))
                    ok[k] = _alike(shared, n[k], m[k], percent)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("group", "node", "first")] + [pa.array(ok)], ["group", "node", "first", "alike"])


def tile_links(sketch: Sketch, percent: int | None, left: list[tuple], right: list[tuple]) -> list[tuple[int, int]]:
    """Edges that connect the left nodes with all that they are linked to among the right ones and each other.

    Nodes are (node, n, sketch, items, settled); settled ones on the right are connected already. Only pairs that the sketch
    allows and that aren't connected yet are compared; percent None: the sketch alone decides.
    """
    names = np.array([x[0] for x in left] + [x[0] for x in right], np.int64)
    u, m = len(left), len(right)
    sizes_l, sizes_r = np.array([x[1] for x in left]), np.array([x[1] for x in right])
    may = sketch.tile(_words([x[2] for x in left]), sizes_l, _words([x[2] for x in right]), sizes_r)
    root = np.arange(u + m)
    done = np.array([x[4] for x in right], bool)
    if done.any():
        root[u:][done] = u + int(np.flatnonzero(done)[0])
    place = {x: k for k, x in enumerate(names[:u].tolist())}
    for k, x in enumerate(names[u:].tolist()):  # a node on both sides is one
        if x in place:
            root[u + k] = place[x]
    start = root.copy()
    if percent is not None:
        items = np.concatenate([np.frombuffer(x[3], "<u8") for x in right])
        owner = np.repeat(np.arange(m), sizes_r)
    for i in range(u):
        open_ = may[i] & (root[u:] != root[i])
        if not open_.any():
            continue
        if percent is not None:
            own = np.frombuffer(left[i][3], "<u8")
            at = np.minimum(np.searchsorted(own, items), len(own) - 1)
            shared = np.bincount(owner[own[at] == items], minlength=m)
            open_ &= _alike(shared, sizes_l[i], sizes_r, percent)
        groups = np.unique(np.append(root[u:][open_], root[i]))
        if len(groups) > 1:
            root[np.isin(root, groups)] = groups[0]
    moved = np.flatnonzero((root != start) & (start == np.arange(u + m)))
    return [(int(names[k]), int(names[root[k]])) for k in moved]


def _tiles(batches: Iterator[pa.RecordBatch], sketch: Sketch, percent: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (group, ub, mb, left, node, n, sketch, items, settled) sorted by tile; gives edges (a, b)."""
    key, left, right = None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if left and right and (edges := tile_links(sketch, percent, left, right)):
            a, b = zip(*edges, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        cells = [batch.column(c).to_pylist() for c in ("group", "ub", "mb", "left", "node", "n", "sketch", "items", "settled")]
        for g, ub, mb, is_left, *rest in zip(*cells, strict=True):
            if (g, ub, mb) != key:
                yield from flush()
                key, left, right = (g, ub, mb), [], []
            (left if is_left else right).append(tuple(rest))
    yield from flush()


def linked(members: DataFrame, sketch: Sketch, percent: int | None = None) -> DataFrame:
    """Edges (a, b) that connect the nodes of each group that are alike. members: a written table of distinct (group, node), with
    n, sketch and, unless percent is None, items.

    percent: least similarity in per cent of the whole sets; None: pairs that the sketch allows. A group's tiles hold BLOCK nodes
    and, but for the largest sets, WEIGHT shingles on each side.
    """
    whole = ["n", "sketch", *(["items"] if percent is not None else [])]
    groups = members.groupBy("group").agg(F.min("node").alias("first"), F.count("*").alias("nodes"), F.sum("n").alias("weight")).where("nodes > 1")
    groups = materialise(groups, "groups")
    # a table of its own for the first nodes, as both sides of the join hold whole sets
    first = members.join(small(groups.select("group", "first")), "group").where("node = first").select("group", "first", *[F.col(c).alias(f"first_{c}") for c in whole])
    first = materialise(first, "firsts")
    met = members.join(small(first), "group").where("node <> first")
    met = materialise(met.mapInArrow(partial(_against_first, sketch=sketch, percent=percent), "group long, node long, first long, alike boolean"), "met")
    edges = met.where("alike").select(F.col("node").alias("a"), F.col("first").alias("b"))
    loose = met.where(~F.col("alike")).groupBy("group").agg(F.count("*").alias("loose"))
    side = lambda n, weight: F.greatest(F.ceil(n / BLOCK), F.ceil(weight / WEIGHT) if percent is not None else F.lit(1)).cast("int")
    split = groups.where("nodes > 2").join(loose, "group").select("group", "first", side(F.col("loose"), F.col("weight") * F.col("loose") / F.col("nodes")).alias("us"), side(F.col("nodes"), F.col("weight")).alias("ms"))
    split = materialise(split, "split")
    if split.isEmpty():
        links = materialise(edges.distinct(), "links")
        discard(groups, first, met, split)
        return links
    rows = members.join(small(split), "group").where("node <> first").join(met.select("group", "node", "alike"), ["group", "node"])
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    items = F.col("items") if percent is not None else F.lit(None).cast("binary")
    out = lambda df, ub, mb, left: df.select("group", ub.alias("ub"), mb.alias("mb"), F.lit(left).alias("left"), "node", "n", "sketch", items.alias("items"), F.col("alike").alias("settled"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    tiles = out(rows.where(~F.col("alike")).withColumn("mb", every("ms")), block("us"), F.col("mb"), True).unionByName(out(rows.withColumn("ub", every("us")), F.col("ub"), block("ms"), False))
    more = tiles.repartition("group", "ub", "mb").sortWithinPartitions("group", "ub", "mb").mapInArrow(partial(_tiles, sketch=sketch, percent=percent), "a long, b long")
    links = materialise(edges.unionByName(more).distinct(), "links")
    discard(groups, first, met, split)
    return links


def similar_sets(docs: DataFrame, size: int, percent: int, sketch: Sketch) -> tuple[DataFrame, DataFrame]:
    """(rows, roots) for docs (doc_id, text): rows has doc_id, key (xxhash64 of the text), node and n of each row; roots has node and
    root for each node that is linked to another; both are written tables.

    Two nodes have the same root if they can be reached over links of sets whose intersection has `percent` per cent of the
    union or more. Words end at ASCII white space; ASCII letters count without case; a text of fewer words than a shingle is
    one shingle; null texts and texts without words have the empty set, which is linked with none.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    signed = materialise(signatures(docs, size, sketch), "signatures")
    name = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")
    nodes = signed.where("n > 0").groupBy("node").agg(F.min(name).alias("f"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value("bands").alias("bands"))
    nodes = materialise(nodes, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("group"))
    shared = materialise(banded.groupBy("group").agg(F.count("*").alias("nodes")).where("nodes > 1").select("group"), "bands")
    members = nodes.select("node", "n", "sketch", F.explode("bands").alias("group")).join(small(shared), "group")
    members = materialise(members, "banded")
    candidates = linked(members, sketch)
    groups = components(candidates)
    discard(candidates, members)
    groups = materialise(groups.unionByName(groups.select(F.col("root").alias("node"), "root")).distinct().withColumnRenamed("root", "group"), "candidates")

    # one row of each candidate set is read again
    first = materialise(nodes.join(small(groups.select("node")), "node", "left_semi").select(F.col("f.doc_id").alias("_id"), F.col("f.key").alias("_key")), "texts")
    texts = docs.join(small(first), docs["doc_id"].eqNullSafe(first["_id"]) & (docs["key"] == first["_key"]), "left_semi")
    sets = sets_of(texts, size, sketch).dropDuplicates(["node"])  # rows may repeat
    sets = materialise(sets.join(groups, "node"), "sets")
    links = linked(sets, sketch, percent)
    roots = components(links)
    roots = materialise(roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct(), "all_roots")
    rows = materialise(signed.select("doc_id", "key", "node", "n"), "rows")
    discard(signed, nodes, shared, groups, first, sets, links)
    return rows, roots

