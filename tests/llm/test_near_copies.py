"""Near-copies of the pipeline against all pairs' similarity."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline as P
from colophon.llm import near_copies as N
from colophon.llm import similar_sets as G
from colophon.llm import simhash as S


def plain_near(rows, size=5, alike=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set())
    group = list(range(len(rows)))
    pairs = 0
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x == y or len(x & y) >= alike * len(x | y):
            pairs += x != y
            low, high = sorted((group[a], group[b]))
            group = [low if g == high else g for g in group]
    return group, pairs


def edited():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    base = [[word() for _ in range(rng.randint(60, 300))] for _ in range(25)]
    rows = [(k, " ".join(w)) for k, w in enumerate(base)]
    for k in range(120):  # copies with one to eight words changed, on both sides of 0.8
        w = list(rng.choice(base))
        for _ in range(rng.randint(1, 8)):
            w[rng.randrange(len(w))] = word()
        rows.append((100 + k, " ".join(w)))
    return rows + [(300, None), (301, ""), (302, "two words"), (303, "Two  words"), (304, rows[0][1]), (None, rows[1][1]), (None, None), (2, rows[3][1])]


def partition(names, groups):
    out = {}
    for name, g in zip(names, groups, strict=True):
        out.setdefault(g, []).append(str(name))
    return sorted(sorted(x) for x in out.values())


@pytest.mark.parametrize("block", [128, 3])
def test_near_copies(spark, block, monkeypatch):
    """The same groups whether a group fits one tile or is dealt in many."""
    monkeypatch.setattr(G, "BLOCK", block)
    rows = edited()
    want, pairs = plain_near(rows)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, key int, node int").repartition(3)
    assert pairs > 50
    key = {r["t"]: r["k"] for r in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) as k").collect()}
    got = N.near_copies(docs).collect()
    assert partition([(r["doc_id"], r["key"]) for r in got], [r["component"] for r in got]) == partition([(i, key[t]) for i, t in rows], want)
    if block == 3:
        assert N.near_copies(docs.limit(0)).count() == 0


def test_recall_on_the_tables(spark, small):
    """Against all pairs that share a shingle, by exact similarity."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, pairs = plain_near(rows)
    got = {r["doc_id"]: r["component"] for r in N.near_copies(docs).collect()}
    assert partition(got, got.values()) == partition([i for i, _ in rows], want) and len(set(want)) < len(rows)


def test_stage_drops_edited_copies(spark, small):
    rows = edited()
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, component string, _key int")
    group, _ = plain_near(rows)
    least = {}
    for g, (i, t) in zip(group, rows, strict=True):
        least[g] = min(least.get(g, (True, 0, "")), (i is None, i or 0, t or ""))
    got = P.no_near_copies(spark, docs, small)
    assert got.columns == docs.columns
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect())
    assert kept == sorted(x[:2] for x in least.values())


def test_rows_of_one_id_are_told_apart(spark, small):
    long = [" ".join(f"{w}{k}" for k in range(60)) for w in "abc"]
    rows = [(3, long[0]), (7, long[0]), (7, long[1]), (8, long[2]), (8, long[2])]
    got = P.no_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), small)
    assert sorted(tuple(r) for r in got.collect()) == [(3, long[0]), (7, long[1]), (8, long[2])]


@pytest.mark.parametrize("radius", [0, 5, 62])
def test_wide_bit_sliced_distances_are_exact(radius):
    rng = np.random.default_rng(radius)
    x = rng.integers(0, 2**63, (200, 4), dtype=np.int64).astype(np.uint64)
    x[100:] = x[:100]
    for k in range(100, 200):
        for b in rng.choice(256, rng.integers(0, 90), replace=False):
            x[k, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    got = np.unpackbits(S.near_lanes(S.planes_of(x), x[50:150], radius).view(np.uint8), axis=1, count=200, bitorder="little")
    want = np.unpackbits((x[50:150, None] ^ x[None]).view(np.uint8), axis=2).sum(axis=2) <= radius
    assert (got == want).all() and want.sum() > 100


def test_tiles_connect_all_pairs():
    """Left nodes are connected with all that they are alike to; settled right ones are connected already."""
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(20, 60))).astype(np.uint64) for _ in range(60)]
    any_pair = G.Sketch(lambda s, least: b"\0" * 8, None, lambda a, n, b, m: np.ones((len(a), len(b)), bool))
    node = lambda k, settled=False: (k, len(sets[k]), b"\0" * 8, sets[k].tobytes(), settled)
    alike = {(a, b) for a, b in itertools.combinations(range(60), 2) if 2 * len(np.intersect1d(sets[a], sets[b])) >= len(np.union1d(sets[a], sets[b]))}

    def groups(edges):
        group = list(range(60))
        for a, b in edges:
            low, high = sorted((group[a], group[b]))
            group = [low if g == high else g for g in group]
        return {(a, b) for a, b in itertools.combinations(range(60), 2) if group[a] == group[b]}

    got = G.tile_links(any_pair, 50, [node(k) for k in range(60)], [node(k) for k in range(60)])
    assert groups(got) == groups(alike) and len(got) < 60 and len(alike) >= 20
    settled = {(40, k) for k in range(41, 60)}
    left, right = range(10), [*range(10), *range(40, 60)]
    got = G.tile_links(any_pair, 50, [node(k) for k in left], [node(k, k >= 40) for k in right])
    assert groups(settled | set(got)) == groups(settled | {(a, b) for a, b in alike if a < 10 and b in right})


def test_prints_keep_pairs_at_the_bound():
    """Random pairs of sets at exactly 0.8: those of FEW shingles and more lie within the radius."""
    rng, lost = np.random.default_rng(5), 0
    for k in range(3000):
        n = 9 * (3 + k % 8)  # sets of 27 shingles and more that share 8 of 9
        x = rng.integers(0, 2**63, n + n // 9, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(x[:n]), np.unique(x[n // 9 :])
        pair = [np.frombuffer(N.WIDE_PRINT.of(s, G.minima(s)), "<u8")[None] for s in (a, b)]
        lost += not N.WIDE_PRINT.pairs(pair[0], np.array([n]), pair[1], np.array([n]))[0]
    assert lost <= 1
