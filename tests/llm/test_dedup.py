"""Exact, near and line deduplication, and decontamination, against plain versions."""

import hashlib
import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.llm import line_dedup as L
from colophon.llm import simhash as S
from colophon.llm.decontaminate import contaminated
from colophon.llm.exact_dedup import exact_dedup

# the extra columns' names clash with those the operators use inside
KIND = "doc_id long, text string, name string, level int, fp long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], KIND).repartition(3)


def texts(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6)))
    base = [" ".join(word() for _ in range(rng.randint(8, 120))) for _ in range(25)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k in range(20):
        w = rng.choice(base).split()
        w[rng.randrange(len(w))] = word()
        rows.append((100 + k, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(200 + k, base[0]) for k in range(12)] + [(300, None), (301, ""), (302, " \n\x0b"), (303, "a"), (304, "A"), (305, "x " * 30_000), (306, "x" * 30_000), (3, base[3]), (3, base[3]), (None, base[3])]
    return rows


def plain_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((i, t or ""))
    out = []
    for n, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        kept = False
        for r in g:
            stays = r == best and not kept
            kept |= stays
            out.append((r[0], best[0], len(g), stays, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(spark, collide):
    rows = texts()
    few = (lambda b: F.pmod(F.xxhash64(b), F.lit(3))) if collide else None
    got = exact_dedup(docs_of(spark, rows), 16, *([few] if few else [])) if collide else exact_dedup(docs_of(spark, rows), 64)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_exact(rows)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup(docs_of(spark, [])).count() == 0


def plain_components(rows, size=3):
    def bits(t):
        import xxhash

        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        if not w:
            return 0
        s = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    f = [bits(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (f[a] ^ f[b]).bit_count() <= 2:
            group[top(b)] = top(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        ids = [x for x in (least.get(top(k)), i) if x is not None]
        least[top(k)] = min(ids) if ids else None
    return sorted(str((i, f"{f[k]:016x}", least[top(k)])) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("limit", [4096, 2])
def test_simhash_components(spark, limit):
    rows = texts()
    got = S.simhash_components(docs_of(spark, rows), limit=limit)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_components(rows)
    if limit == 2:
        assert S.simhash_components(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 300])
def test_bit_sliced_search_is_exact(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    block = np.unique(np.concatenate((base, near)))
    want = {(a, b) for a in range(len(block)) for b in range(a + 1, len(block)) if int(block[a] ^ block[b]).bit_count() <= 2}
    assert set(zip(*(x.tolist() for x in S.linked(block)), strict=True)) == want


def test_any_close_pair_shares_a_key():
    masks = S._masks(0, 4, 2)
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any(a & m == b & m for m in masks)
        for m in masks:
            if a & m == b & m:
                assert any(a & x == b & x for x in S._masks(m, 3, 1))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert {got.get(k, k) for k in range(61)} == {0} and {got.get(k, k) for k in range(100, 140)} == {100}


def plain_lines(rows, depth=3, alike=0.8):
    """The operator's rule, row by row."""
    squeeze = lambda x: re.sub(r"[ \t\n\x0b\f\r]+", " ", x).strip(" ")
    need = lambda n: math.ceil(n * alike - 1e-9)
    tokens = lambda m: m.count(" ") + 1

    def mask(x):
        x = squeeze(x)
        return re.sub(r"[^ ]*[0-9][^ ]*", "<*>", x) if need(tokens(x)) < tokens(x) else x

    use = [(i, m) for i, t in rows if t is not None for m in map(mask, t.split("\n")) if m]
    leaves = {}
    for i, m in use:
        leaves.setdefault((tokens(m), tuple(m.split(" ")[:depth])), []).append((i, m))
    template, number = {}, itertools.count()
    for (n, _), ms in leaves.items():
        groups = [[m.split(" ") for m in sorted({m for _, m in ms})]]
        if len({i for i, _ in ms}) < 2 or need(n) == n:
            continue
        while groups:
            group, name, rest = groups.pop(), next(number), {}
            if len(group) < 2:
                continue
            tokens_at = [Counter(x[p] for x in group) for p in range(n)]
            at = -max((c, -p) for p, t in enumerate(tokens_at) for c in t.values() if 2 * c <= len(group))[1]
            for x in group:
                if sum(2 * t[y] > len(group) for t, y in zip(tokens_at, x, strict=True)) >= need(n):
                    template[" ".join(x)] = name
                else:
                    rest.setdefault(x[at], []).append(x)
            groups += rest.values()
    where = {}
    for i, m in use:
        where.setdefault(template.get(m, m), set()).add(i)
    first = {t: min((i for i in s if i is not None), default=None) for t, s in where.items()}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        ls = t.split("\n")
        names = [template.get(mask(x), mask(x)) for x in ls]
        left = [x for x, k in zip(ls, names, strict=True) if k == "" or len(where[k]) < 2 or first[k] == i]
        out.append((i, "\n".join(left), len(ls), len(ls) - len(left)))
    return sorted(map(str, out))


def test_line_dedup(spark):
    rng = random.Random(9)
    line = lambda: " ".join(rng.choice(["red", "blue", "go", "to", "sea", "sky"]) for _ in range(rng.randint(3, 12)))
    shared = [line() for _ in range(12)]
    near = "the quick report of day one two three four five six seven eight"
    rows = []
    for k in range(40):
        own = [rng.choice(shared) if rng.random() < 0.4 else line() for _ in range(rng.randint(1, 6))]
        if k % 5 == 0:
            own.append(near.replace("seven", rng.choice(["seven", "nine", "ten"])))
        if k % 7 == 0:
            own.append(f"printed on 2024-0{k % 9 + 1} by printer {k} at  home")
        rows.append((k, "\n".join(own)))
    for k in range(30):  # two templates and unrelated lines in one leaf, neither with half of its lines
        name = rng.choice(["ann", "bob", "cy", "dan"])
        rows.append((100 + k, [f"please send the letter of last week to {name} at our office", f"please send the forms for your visit before {name} goes home", "please send the " + " ".join(rng.choice("pqrstuv") * 2 for _ in range(9))][k % 3]))
    rows += [(80, "Les.\n这是一个没有空格的长行"), (81, "Les.\n这是一个没有空格的长行\npage 7"), (82, "page 8\n \npage 7")]
    rows += [(50, None), (51, ""), (52, "\n\n"), (None, shared[0]), (None, "only here are these five words"), (3, rows[3][1]), (60, "a b c d e " * 4000)]
    got = sorted(str(tuple(r)) for r in L.line_dedup(docs_of(spark, rows)).collect())
    assert got == plain_lines(rows)
    assert any("printed" in x for x in got) and sum("printed on" in x for x in got) == 1
    assert sum("of last week" in x for x in got) == sum("before" in x for x in got) == 1
    assert L.line_dedup(docs_of(spark, [])).count() == 0


def test_lines_of_long_texts_take_linear_time(spark):
    text = "\n".join(f"line {'abcdefghij'[k % 10]}{chr(97 + k // 10 % 26)} of a long text {k % 997} x" + chr(97 + k % 26) * (k % 50) for k in range(40_000))
    began = time.time()
    got = {r["doc_id"]: r for r in L.line_dedup(docs_of(spark, [(1, text), (2, text), (2, text)])).collect()}
    assert got[1]["text"] == text and got[2]["text"] == "" and got[2]["n_dropped"] == 40_000
    assert time.time() - began < 60


def test_clashing_names(spark):
    names = ["_text", "_gone", "_k1", "_r1", "_keep0", "k1", "m", "n", "w", "pos", "first", "n_dropped", "n_lines"]
    docs = spark.createDataFrame([(1, "a b c d e f", *range(len(names)))], "doc_id long, text string, " + ", ".join(f"`{x}` int" for x in names))
    assert L.line_dedup(docs, keep=["doc_id", *names[:-2]]).first()["_gone"] == 1


def plain_contained(rows, items, size=5):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    sh = lambda w, k: {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    out = {}
    for item, t in items:
        w = words(t)
        if not w:
            continue
        k = min(size, len(w))
        own = sh(w, k)
        for i, d in rows:
            n = len(own & sh(words(d), k))
            if n >= 0.8 * len(own) - 1e-9:
                out[i, item] = max(out.get((i, item), (0,)), (n / len(own), n, len(own)))
    return sorted(str((i, item, n, m, c)) for (i, item), (c, m, n) in out.items())


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_contamination(spark, most):
    rng = random.Random(4)
    say = lambda n: [rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa mu nu xi pi rho".split()) + str(rng.randint(0, 30)) for _ in range(n)]
    items = [(k, " ".join(say(rng.randint(1, 60)))) for k in range(20)] + [(30, None), (31, ""), (32, "Two, Words!"), (None, "a null id of an item here")]
    rows = []
    for k in range(40):
        w = say(rng.randint(0, 200))
        if k % 2:
            passage = rng.choice(items[:20])[1].split()
            for _ in range(rng.randint(0, 3)):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() + "," for x in passage]
        rows.append((k, "\n".join(w)))
    rows += [(50, None), (51, ""), (52, "two words"), (53, "so: TWO words."), (None, "x a null id of an item here"), (5, rows[5][1]), (60, "pad " * 20000 + items[0][1])]
    got = contaminated(docs_of(spark, rows), spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int"), most=most)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_contained(rows, items)
    if most:
        none = spark.createDataFrame([], "item_id long, text string")
        assert contaminated(docs_of(spark, rows), none).count() == 0 and contaminated(docs_of(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
