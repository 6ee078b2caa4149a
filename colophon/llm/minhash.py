"""Near-duplicates by b-bit MinHash.

Each text's distinct shingles have 128 minima. Bands of whole minima name candidates; of each minimum only the low BITS bits are
kept, packed as bit planes (64 bytes a text). Of two signatures, the share of minima whose kept bits are all equal is found by
XOR, OR over the planes and a count of bits. Unequal minima agree in b bits with a probability of 2**-b, so the share m estimates
the similarity by (m - 2**-b) / (1 - 2**-b). Candidates whose estimate is more than DEVIATIONS standard deviations below the
wanted similarity are left out; the others are confirmed on their whole sets (see similar_sets.py for how groups are dealt).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import materialise
from colophon.llm.similar_sets import MINIMA, Sketch, similar_sets

#: Words of a shingle, least similarity in per cent, bits kept of a minimum, deviations below which a pair is left out.
SIZE, PERCENT, BITS, DEVIATIONS = 3, 85, 4, 5
CHANCE = 2.0**-BITS


def packed(items: np.ndarray, least: np.ndarray) -> bytes:
    """The low BITS bits of the minima, one plane for each bit."""
    return b"".join(np.packbits((least >> np.uint32(k) & np.uint32(1)).astype(np.uint8)).tobytes() for k in range(BITS))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The estimated similarity of signatures (... x words of all planes), corrected for equal bits by chance."""
    differ = a ^ b
    planes = differ.reshape(*differ.shape[:-1], BITS, -1)
    unequal = np.bitwise_count(np.bitwise_or.reduce(planes, axis=-2)).sum(axis=-1, dtype=np.int64)
    return ((MINIMA - unequal) / MINIMA - CHANCE) / (1 - CHANCE)


def floor_of(percent: int = PERCENT) -> float:
    """The least estimate of pairs that are confirmed."""
    share = CHANCE + (1 - CHANCE) * percent / 100
    return percent / 100 - DEVIATIONS * (share * (1 - share) / MINIMA) ** 0.5 / (1 - CHANCE)


def _pairs(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    return estimate(a, b) >= floor_of()


def _tile(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    return estimate(a[:, None, :], b[None, :, :]) >= floor_of()


B_BIT = Sketch(packed, _pairs, _tile)


def minhash_components(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    A text's set has its distinct shingles of three words; words end at ASCII white space, ASCII letters count without case; a
    text of fewer words is one shingle. Two texts are linked if the intersection of their sets has 85 per cent of the union or
    more; component_id is the least doc_id that can be reached, the row's own included (null ids come last). Null texts and
    texts without words have no shingles, and are linked with nothing, not even each other. kept: the row has the component's
    least id. Repeated rows come out as often as they go in; an empty table gives no rows; other columns are ignored. Texts are
    read whole. A pair at exactly 85 per cent is missed by the bands with a probability of 8e-7 and by the estimate with one of
    about 1e-5 (the test measures both on short texts).
    """
    rows, roots = similar_sets(docs, SIZE, PERCENT, B_BIT)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = materialise(named, "named")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(named.join(lowest, "root").select("node", "component_id"), "components")
    out = rows.join(named, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
