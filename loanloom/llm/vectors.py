"""Vectors of a table: which rows hold one, and batches of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components; a null vector
    is not usable, one without components is."""
    limit = F.lit(float("inf"))
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.coalesce(whole, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list array whose lists all hold ``width`` numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, width)
