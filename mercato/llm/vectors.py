"""Columns of vectors: which take part, and their entries as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """No null vector, and none with a null or non-finite entry."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def scaled(vector: Column, scale: int, most: int) -> Column:
    """floor(scale * c) of each entry, in double precision, as long; raises where it would be ``most`` or more in size."""
    def entry(c: Column) -> Column:
        x = F.lit(float(scale)) * c.cast("double")
        too_big = F.raise_error(F.concat(F.lit("vector entry out of range: "), c.cast("string"))).cast("bigint")
        return F.when(F.abs(x) < most, F.floor(x)).otherwise(too_big)

    return F.transform(vector, entry)


def matrix(lists: pa.Array, wide: int | None = None) -> np.ndarray:
    """Lists of longs as rows, filled up with zeros to the longest, or to ``wide``."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(sizes.max(initial=0)) if wide is None else wide), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out
