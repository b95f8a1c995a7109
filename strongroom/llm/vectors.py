"""Vectors of doubles as exact integers, shared by the operators on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """The vector is there and none of its components is null, NaN or infinite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vector: Column, scale: int, limit: float) -> Column:
    """floor(scale * component) of every component as long, the component taken
    as double.  A magnitude of ``limit`` or more, beyond which the callers'
    integer arithmetic would not be exact, is an error."""

    def whole(c: Column) -> Column:
        y = c.cast("double") * F.lit(float(scale))
        big = F.raise_error(F.concat(F.lit("vector component too large for exact arithmetic: "), c.cast("string"))).cast("long")
        return F.when(F.abs(y) < limit, F.floor(y)).otherwise(big)

    return F.transform(vector, whole)


def int_matrix(column, width: int):
    """Rows of an Arrow column of lists of longs as a matrix of 64-bit integers."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)
