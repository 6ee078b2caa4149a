"""Vector codes and hard negatives against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from colophon.llm import hard_negatives as H
from colophon.llm import vector_codes as C

SCHEMA = "vec_id long, label int, vector array<float>, code int, `group` string"


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def whole(v, dims):
    top = 1 << 24
    out = [max(-top, min(top, math.floor(256 * float(np.float32(x))))) for x in v][:dims]
    return out + [0] * (dims - len(out))


def rows_of(n=300, dims=32, seed=4):
    rng = random.Random(seed)
    rows = [(k, rng.choice([0, 1, 2, 3, None]), [rng.gauss(0, 0.3) for _ in range(dims)]) for k in range(n)]
    rows += [(n + k, 1, list(rows[5][2])) for k in range(30)]  # ties
    rows += [(900, 1, None), (901, 1, [None] * dims), (902, 2, [math.nan] * dims), (903, 2, [math.inf] + [0.0] * (dims - 1)), (904, 3, [])]
    return rows + [(7, rows[7][1], list(rows[7][2])), (905, 2, [0.5] * 9), (906, 2, [0.1] * (dims + 3)), (None, 2, [0.2] * dims)]


def plain_codes(rows, parts=16, entries=64, rounds=2):
    rows = [r for r in rows if usable(r[2])]
    if not rows:
        return [], ""
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    first = {}
    for r in sorted(rows, key=key):
        first.setdefault(r[0], r)
    start = list(first.values())[:entries]
    width = -(-len(start[0][2]) // parts)
    cut = lambda v: [whole(v, width * parts)[p * width : (p + 1) * width] for p in range(parts)]
    x = [cut(r[2]) for r in rows]
    books = [[cut(r[2])[p] for r in start] for p in range(parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for v in x:
                own.setdefault(near(v[p], p)[1], []).append(v[p])
            new.append([[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(books[p])])
        books = new
    out = []
    for r, v in zip(rows, x, strict=True):
        got = [near(v[p], p) for p in range(parts)]
        out.append((r[0], r[1], "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got)))
    total = {}
    for _, label, _, e in out:
        total[label] = total.get(label, 0) + e
    text = ",".join(str(c) for b in books for e in b for c in e)
    return [(i, code, e, total[label]) for i, label, code, e in out], hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "g") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize(("n", "dims"), [(300, 32), (20, 64), (80, 21)])
def test_codes(spark, n, dims):
    rows = rows_of(n, dims)
    want, digest = plain_codes(rows)
    got = C.vector_codes(frame(spark, rows)).collect()
    assert {r["codebooks_sha256"] for r in got} == {digest}
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(want, key=str)


def test_codes_of_nothing_and_of_large_numbers(spark):
    assert C.vector_codes(frame(spark, [(1, 1, None), (2, None, [math.nan])], 1)).collect() == []
    assert C.vector_codes(frame(spark, rows_of()).limit(0)).collect() == []
    rows = [(k, None, [3e38 if k % 2 else -3e38] * 16) for k in range(4)]
    got = C.vector_codes(frame(spark, rows, 1), entries=2, rounds=0).collect()
    assert {r["code"] for r in got} == {"00" * 16, "01" * 16} and {(r["error"], r["label_error"]) for r in got} == {(0, 0)}


def test_nearest_drops_no_nearest_entry():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 4, 7, 16):
        x, entries = rng.integers(-300, 300, (500, width)), rng.integers(-300, 300, (64, width))
        x[:100], entries[40:] = entries[rng.integers(0, 40, 100)], entries[:24]  # ties and zeros
        all_of = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        index, distance = C.nearest(x, entries)
        assert (index == all_of.argmin(axis=1)).all() and (distance == all_of.min(axis=1)).all()


def plain_negatives(rows, anchor):
    by_id = {}
    for r in sorted((r for r in rows if usable(r[2]) and None not in r[:2]), key=lambda r: (r[0], str(r[1]), r[2])):
        by_id.setdefault(r[0], r)
    rows = list(by_id.values())
    dims = max((len(r[2]) for r in rows), default=1)
    x = np.array([whole(r[2], dims) for r in rows], object).reshape(len(rows), dims)
    out = []
    for a in (k for k, r in enumerate(rows) if anchor(r[0])):
        scored = sorted((-int((x[k] * x[a]).sum()), r[0], r[1]) for k, r in enumerate(rows) if k != a)
        for ps, pid, _ in [s for s in scored if s[2] == rows[a][1]][:5]:
            inside = [s for s in scored if s[2] != rows[a][1] and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:10]
            out += [(rows[a][0], pid, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 256, 32), (50, 4, 5)])
def test_hard_negatives(spark, blocks, monkeypatch):
    for name, value in zip(("ROWS", "ANCHORS", "CHUNK"), blocks, strict=True):
        monkeypatch.setattr(H, name, value)
    from pyspark.sql import functions as F

    rows = rows_of(400)
    got = sorted(tuple(r) for r in H.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())
    want = plain_negatives(rows, lambda i: i % 20 == 0)
    assert got == want and len(want) > 200


def test_hard_negatives_of_few_rows(spark):
    from pyspark.sql import functions as F

    every = F.col("vec_id") >= 0
    assert H.hard_negatives(frame(spark, [], 1), every).collect() == []
    assert H.hard_negatives(frame(spark, rows_of()), F.col("vec_id") < 0).collect() == []
    rows = [(0, 1, [3e38, 1.0]), (1, 1, [3e38, -1.0]), (2, 2, [2.0**15, 0.0]), (3, 2, [-1.0, 0.0]), (4, None, [1.0, 1.0]), (5, 9, [1.0])]
    got = sorted(tuple(r) for r in H.hard_negatives(frame(spark, rows, 1), every).collect())
    assert got == plain_negatives(rows, lambda i: True) and len(got) == 2


def test_product_is_exact():
    rng = np.random.default_rng(0)
    small, large = rng.integers(-300, 300, (40, 64)), rng.integers(-(1 << 24), 1 << 24, (30, 64))
    for a, b in ((small, small), (small, large), (large, large)):
        assert (H.product(a, b) == (a.astype(object) @ b.T.astype(object))).all()
