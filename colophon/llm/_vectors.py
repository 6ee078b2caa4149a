"""What the operators on vectors share: which rows take part, and integer components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components are multiplied by this before the floor; larger integers than MOST (either sign) count as MOST, so that sums fit 64 bits.
SCALE, MOST = 256, 1 << 24


def usable(vector: str) -> Column:
    """Whether a vector is there, isn't empty and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def integers(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(256 * x) of vectors (rows x dims, int64). Shorter vectors end in zeros, longer ones are cut."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return x.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = at < dims
    out[row[inside], at[inside]] = x[inside]
    return out
