"""Near-copies by SimHash at a wide radius: texts with a similarity of 0.8 or more of their five-word shingles.

At that similarity two fingerprints differ in about 15 % of their bits, more than any keys over bits can search, so fingerprints
have 256 bits and are compared, bit-sliced, only among candidates, which MinHash bands name (similar_sets.py). Nodes within the
radius are confirmed by their whole sets. Fingerprints of sets with few shingles scatter too much for a radius, so pairs with a
set of fewer than FEW shingles are never ruled out by them.

Two texts with a similarity of 0.8 share no band with a probability of 7e-5. Measured on random pairs of exactly that similarity,
none of those with FEW shingles or more lies beyond the radius in 20,000 (a test draws them).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm.similar_sets import Sketch, similar_sets
from colophon.llm.simhash import near_lanes, planes_of, wide_fingerprint

#: Words of a shingle, least similarity in per cent, radius of the fingerprints, shingles from which they count.
SIZE, PERCENT, RADIUS, FEW = 5, 80, 62, 24


def _print(items: np.ndarray, least: np.ndarray) -> bytes:
    return wide_fingerprint(items).astype("<u8").tobytes()


def _pairs(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= RADIUS) | (np.minimum(n, m) < FEW)


def _tile(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    near = near_lanes(planes_of(b), a, RADIUS)
    lanes = np.unpackbits(near.view(np.uint8), axis=1, count=len(b), bitorder="little").astype(bool)
    return lanes | (n[:, None] < FEW) | (m[None, :] < FEW)


WIDE_PRINT = Sketch(_print, _pairs, _tile)


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, key, component for each row of docs (doc_id, text), without regard to its other columns.

    key is the xxhash64 of the text. Rows have the same component if their texts can be reached from each other over links of
    texts with a Jaccard similarity of 0.8 or more of their distinct shingles of five words. Words end at ASCII white space;
    ASCII letters count without case; a text of fewer words is one shingle. Null texts and texts without words have no shingles
    and are alike. Texts are read whole. Repeated rows come out as often as they go in; an empty table gives no rows.
    """
    rows, roots = similar_sets(docs, SIZE, PERCENT, WIDE_PRINT)
    return rows.join(roots, "node", "left").select("doc_id", "key", F.coalesce("root", "node").alias("component"))
