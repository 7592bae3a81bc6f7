"""Vector expressions over ``array<float>`` columns, always accumulated in double."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x)


def sum_squares(v: Column) -> Column:
    return F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x)


def norm(v: Column) -> Column:
    return F.sqrt(sum_squares(v))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(v: Column, length: Column | None = None) -> Column:
    """Scale to length one; an all-zero vector stays as it is.

    Pass ``length`` when the norm is already a column, so it is not computed per use.
    """
    size = norm(v) if length is None else length
    return F.transform(as_double(v), lambda x: F.when(size > 0, x / size).otherwise(x))


def count_nan(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: F.isnan(x))).cast("bigint")


def count_infinite(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: F.abs(x) == F.lit(float("inf")))).cast("bigint")


def identity_key(v: Column) -> Column:
    """Equal exactly when two vectors are element-wise the same floats.

    The text form of a float is its shortest exact form, so -0.0 and 0.0 stay apart (grouping on the
    array itself would merge them). The digest keeps shuffled keys at 32 bytes whatever the width is.
    """
    return F.unhex(F.sha2(v.cast("string"), 256))


def to_matrix(column: pa.Array) -> np.ndarray:
    """Arrow list column to an ``n x d`` double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


def from_matrix(matrix: np.ndarray) -> pa.Array:
    """``n x d`` matrix to an Arrow list-of-float32 column."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


def pairwise_squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances as one matrix product, of vectors centred on the centres' mean, so that an offset does not cancel digits."""
    origin = centers.mean(0)
    points, centers = points - origin, centers - origin
    cross = points @ centers.T
    gaps = (points * points).sum(1)[:, None] - 2.0 * cross + (centers * centers).sum(1)[None, :]
    return np.maximum(gaps, 0.0)


def nearest_center(v: Column, centers: np.ndarray, ids: np.ndarray | None = None) -> Column:
    """Label of the closest centre, first wins on ties.

    ``centers`` is a k x d matrix shipped with the function, so no join and no shuffle is needed.
    """
    table = np.asarray(centers, dtype=np.float64)
    labels = np.arange(len(table)) if ids is None else np.asarray(ids)

    @arrow_udf("int")
    def pick(column: pa.Array) -> pa.Array:
        if len(column) == 0:
            return pa.array([], pa.int32())
        found = pairwise_squared(to_matrix(column), table).argmin(1)
        return pa.array(labels[found].astype(np.int32))

    return pick.asNondeterministic()(v)  # a join on the label must not compute it twice
