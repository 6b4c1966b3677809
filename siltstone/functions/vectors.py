"""Vector column functions, in double precision inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where a length differs or a vector is null or zero."""
    size = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size)


def literal(vector: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def of_size(vector: Column, size: int) -> Column:
    """Whether a vector has `size` values, none of them missing."""
    return F.coalesce((F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull()), F.lit(False))
