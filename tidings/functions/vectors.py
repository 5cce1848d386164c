"""Column functions on ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.binding import let


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def normalise(vector: Column) -> Column:
    """Scale to length 1; a zero vector has no direction and becomes NULL elements."""
    return let(
        F.nullif(norm(vector), F.lit(0.0)), lambda length: F.transform(vector, lambda x: x / length)
    )


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)


def into_box(unit: Column, low: Column, high: Column) -> Column:
    """Move a point of the unit cube into the box between ``low`` and ``high``."""
    width = F.zip_with(high, low, lambda b, a: b - a)
    scaled = F.zip_with(unit, width, lambda u, w: u * w)
    return F.zip_with(scaled, low, lambda s, a: s + a)


def log_or_minus_infinity(x: Column) -> Column:
    """Natural logarithm with the logarithm of zero kept as minus infinity."""
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(F.ln(x))


# Element-wise aggregates. The summarizer folds whole vectors in the JVM with map-side partial
# results, so no row per dimension is ever made. It suits few groups; for many, plain sums of
# up to SUM_COLUMNS elements aggregate by hash where the summarizer would sort its input.
SUM_COLUMNS = 100


def sum_vectors(vector: Column, dims: int | None = None) -> Column:
    if dims is not None and dims <= SUM_COLUMNS:
        return F.array(*[F.sum(F.get(vector, F.lit(i))) for i in range(dims)])
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def min_vectors(vector: Column) -> Column:
    return vector_to_array(Summarizer.min(array_to_vector(vector)))


def max_vectors(vector: Column) -> Column:
    return vector_to_array(Summarizer.max(array_to_vector(vector)))
