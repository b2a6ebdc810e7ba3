"""Distances between feature arrays as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two ``ARRAY<DOUBLE>`` columns."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)


def distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two ``ARRAY<DOUBLE>`` columns."""
    return F.sqrt(squared_distance(a, b))


def is_usable_point(features: Column | str, dimension: int) -> Column:
    """True for a point to keep, false for one with a NaN coordinate.

    Raises for a point of another dimension and for an infinite or missing
    coordinate. ``array_max`` ranks NaN highest and skips NULL, so scans of the
    array in generated code decide, with no lambda.
    """
    features = F.col(features) if isinstance(features, str) else features
    low, high = F.array_min(features), F.array_max(features)
    missing = F.size(F.array_compact(features)) != F.size(features)
    infinite = missing | (low == float("-inf")) | (high == float("inf"))
    return (
        F.when(
            F.coalesce(F.size(features), F.lit(-1)) != dimension,
            F.raise_error(F.lit(f"a point does not have {dimension} coordinates")).cast("boolean"),
        )
        .when(
            F.coalesce(infinite & (missing | ~F.isnan(high)), F.lit(dimension > 0)),
            F.raise_error(F.lit("a point has an infinite or missing coordinate")).cast("boolean"),
        )
        .otherwise(F.coalesce(~F.isnan(high), F.lit(True)))
    )
