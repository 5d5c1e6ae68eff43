"""Metric formulas as aggregate Column expressions (one pass, partial + final)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(label: str = "rating", prediction: str = "prediction") -> Column:
    """sqrt(mean((label - prediction)^2)); NULL over zero rows."""
    d = F.col(label).cast("double") - F.col(prediction).cast("double")
    return F.sqrt(F.avg(d * d))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equal-length numeric arrays, JVM-side."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)
