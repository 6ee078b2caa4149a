"""b-bit MinHash near-duplicates against all pairs' exact similarity."""

import itertools
import random

import numpy as np
import pytest

from colophon.llm import minhash as M
from colophon.llm import similar_sets as G


def sets_of(rows, size=3):
    out = []
    for _, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        out.append({tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set())
    return out


def plain(rows):
    """doc_id, n_shingles, component_id, kept of each row, by comparing all pairs."""
    sets, group = sets_of(rows), list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            low, high = sorted((group[a], group[b]))
            group = [low if g == high else g for g in group]
    ids = {}
    for g, (i, _) in zip(group, rows, strict=True):
        ids.setdefault(g, []).append(i)
    least = {g: min((x for x in i if x is not None), default=None) for g, i in ids.items()}
    return [(i, len(s), least[g], i == least[g]) for (i, _), s, g in zip(rows, sets, group, strict=True)]


def edited(n=40, copies=200):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    base = [[word() for _ in range(rng.choice([4, 9, 15, 30, 80, 250]))] for _ in range(n)]
    rows = [(1000 + k, " ".join(w)) for k, w in enumerate(base)]
    for k in range(copies):  # copies with up to six words changed or added at an end, on both sides of 0.85
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = word()
            else:
                w.append(word())
        rows.append((k, " ".join(w)))
    return rows + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "two words"), (5004, "Two\x0bWORDS"), (5005, "Ä ä"), (5006, "ä Ä"), (None, rows[1][1]), (None, None), (2, rows[3][1]), (2, rows[3][1])]


@pytest.mark.parametrize("block", [128, 4])
def test_components(spark, block, monkeypatch):
    monkeypatch.setattr(G, "BLOCK", block)
    rows = edited()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node int, n string").repartition(3)
    got = sorted((tuple(r) for r in M.minhash_components(docs).collect()), key=str)
    want = plain(rows)
    assert got == sorted(want, key=str)
    assert sum(i is not None and i != c for i, _, c, _ in want) > 60
    if block == 4:
        assert M.minhash_components(docs.limit(0)).count() == 0


def test_one_group_of_many_edits(spark):
    """A group whose members are alike in chains: most aren't alike to the least one."""
    words = [f"w{k}" for k in range(700)]
    rows = [(k, " ".join(words[k : k + 60])) for k in range(600)] + [(900, "quite another text of some words")]
    got = {r["doc_id"]: r["component_id"] for r in M.minhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: 0 for k in range(600)} | {900: 900}


def test_estimate_and_what_it_loses():
    """The corrected estimate is unbiased, and pairs at the bound, small sets too, pass bands and filter."""
    rng = np.random.default_rng(1)
    lost, found = 0, {0.3: [], 0.85: [], 0.95: []}
    for k in range(4000):
        s = [0.3, 0.85, 0.95][k % 3]
        n = int(rng.choice([7, 20, 40, 200]))
        x = rng.integers(0, 2**63, 2 * n, dtype=np.int64).astype(np.uint64)
        shared = -(-int(2 * n * s / (1 + s) * 1e6) // 10**6)
        shared += (100 * shared < 85 * (2 * n - shared)) if s == 0.85 else 0
        a, b = x[:n], np.concatenate((x[:shared], x[n : 2 * n - shared]))
        la, lb = G.minima(a), G.minima(b)
        sig = [np.frombuffer(M.packed(y, least), "<u8") for y, least in ((a, la), (b, lb))]
        got = float(M.estimate(*sig))
        if n == 200:
            found[s].append(got - shared / (2 * n - shared))
        if s >= 0.85 and 100 * shared >= 85 * (2 * n - shared):
            lost += got < M.floor_of() or not np.intersect1d(G.bands(la), G.bands(lb)).size
    assert all(abs(np.mean(v)) < 0.02 for v in found.values()) and lost <= 1
    assert not np.isnan(M.estimate(sig[0][None, None], sig[1][None, None])).any()
