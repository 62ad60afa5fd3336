"""Vectors in tables: which can be used, and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows with an id and finite components only, none of them null."""
    infinite = F.lit(float("inf"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))
    return vectors.select(F.col("vec_id").cast("long"), "embedding").where(
        F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0)
    )


def length() -> Column:
    """The number of components; vectors are compared with those of their own length only.

    A table holds few lengths: L of them take L * (L + 1) / 2 components at least, so a row per
    length may be broadcast, being at most the square root of twice the components.
    """
    return F.size("embedding")


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The lists, all of one length, as rows of doubles."""
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))
