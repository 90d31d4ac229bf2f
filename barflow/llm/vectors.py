"""Integer vectors for the embedding operators: which rows take part, and their packing for numpy tasks."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1024
MOST = 2.0**61


def is_usable(vector: str) -> Column:
    """Not null, and no component is null, infinite or not a number."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def integer_components(vector: str, offset: int = 0) -> Column:
    """floor(1024 * x) + offset of every component, as longs; the floor is held within 2**61 of zero."""
    def whole(x: Column) -> Column:
        held = F.least(F.greatest(x.cast("double") * SCALE, F.lit(-MOST)), F.lit(MOST))
        return F.floor(held) + F.lit(offset).cast("bigint")

    return F.transform(vector, whole).cast("array<bigint>")


def integer_vectors(df: DataFrame, id_column: str, vector: str, offset: int = 0) -> DataFrame:
    """vec_id and components of the rows that take part."""
    components = integer_components(vector, offset)
    return df.where(is_usable(vector)).select(F.col(id_column).cast("bigint").alias("vec_id"), components.alias("components"))


def matrix(components: pa.Array, width: int | None = None) -> np.ndarray:
    """The lists as rows; shorter vectors end in zeros."""
    offsets = components.offsets.to_numpy()
    values = components.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    most = int(sizes.max(initial=0)) if width is None else width
    if (sizes == most).all():
        return values[offsets[0] : offsets[-1]].reshape(len(components), most)
    out = np.zeros((len(components), most), dtype=np.int64)
    row = np.repeat(np.arange(len(components)), sizes)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values[offsets[0] : offsets[-1]]
    return out
