"""Vectors as integers: the components that the integer searches and codebooks work on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
MOST = 1 << 24  # larger components count as this, so that sums of squares stay inside 64 bits


def finite(vector: Column) -> Column:
    """True where neither the vector nor a component is null, infinite or not a number."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of each component, as double, within +-MOST."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x.cast("double") * SCALE))).cast("int"))


def exact(*arrays: np.ndarray, terms: int) -> list[np.ndarray]:
    """The arrays in a type in which sums of `terms` products of their values are exact: doubles
    where they suffice, since those multiply faster, else 64-bit integers."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    kind = np.float64 if 4 * terms * most * most < 1 << 53 else np.int64
    return [a.astype(kind) for a in arrays]
