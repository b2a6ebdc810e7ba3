"""Point tables: ``(point_id BIGINT, features ARRAY<DOUBLE>)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.text import split_tokens
from tallyspan.functions.vectors import is_usable_point
from tallyspan.sources.lines import numbered_lines
from tallyspan.sources.pairs import DROPMALFORMED, FAILFAST, check_mode

_DIMENSION = "dimension"


def dimension_of(points: DataFrame) -> int:
    """Number of coordinates of a point table, 0 when it has no rows."""
    known = points.schema["features"].metadata.get(_DIMENSION)
    if known is not None:
        return known
    row = points.select(F.size("features")).first()
    return row[0] if row else 0


def with_dimension(points: DataFrame, dimension: int) -> DataFrame:
    """Note the number of coordinates in the schema, to save looking it up."""
    return points.withMetadata("features", {_DIMENSION: dimension})


def checked_points(points: DataFrame) -> DataFrame:
    """A table as a point table: rows that never passed :func:`points_from_table` pass its checks now.

    Other columns stay. A point table carries its dimension in its schema and
    comes back as it is.
    """
    if _DIMENSION in points.schema["features"].metadata:
        return points
    return _usable(points, dimension_of(points))


def _usable(points: DataFrame, dimension: int) -> DataFrame:
    usable = points.filter(is_usable_point("features", dimension))
    return with_dimension(usable.withColumn("features", F.col("features").cast("array<double>")), dimension)


def points_from_table(
    df: DataFrame,
    id_col: str = "point_id",
    features_col: str = "features",
    dimension: int | None = None,
) -> DataFrame:
    """A point table from an id column (unique) and an array column.

    All points must have the dimension given, or else that of the first row;
    other rows and infinite coordinates raise an error in the pass that meets
    them, before any distance. Points with a NaN coordinate are left out: no
    comparison could ever choose them.
    """
    raw = df.select(
        F.col(id_col).cast("bigint").alias("point_id"), F.col(features_col).alias("features")
    )
    if dimension is None:
        dimension = dimension_of(raw)
    return _usable(raw, dimension)


def _coordinates(value: str, mode: str) -> Column:
    parsed = split_tokens(value, ",").try_cast("array<double>")
    bad = parsed.isNull() | (F.size(parsed) == 0) | F.exists(parsed, lambda x: x.isNull())
    if mode == DROPMALFORMED:
        return F.when(~bad, parsed)
    error = F.raise_error(F.concat(F.lit("not a point line: "), F.col(value)))
    return F.when(bad, error.cast("array<double>")).otherwise(parsed)


def decode_points(
    source: SparkSession | DataFrame,
    path: str | None = None,
    mode: str = FAILFAST,
    value: str = "value",
    dimension: int | None = None,
) -> DataFrame:
    """``(point_id, features)`` from lines of comma-separated numbers.

    From a session and a path, the point id is the line's position in the file
    order. From a DataFrame of lines that already has a ``position``, that one
    is used. The rows pass the checks of :func:`points_from_table`: lines with
    a NaN are left out, others of another dimension than the given one or the
    first line's, or with an infinite number, raise an error.
    """
    check_mode(mode)
    lines = numbered_lines(source, path) if isinstance(source, SparkSession) else source
    decoded = lines.select(
        F.col("position").cast("bigint").alias("point_id"),
        _coordinates(value, mode).alias("features"),
    )
    if mode == DROPMALFORMED:
        decoded = decoded.filter(F.col("features").isNotNull())
    return _usable(decoded, dimension_of(decoded) if dimension is None else dimension)


def encode_points(features: Column | str) -> Column:
    """The line of a point, the inverse of :func:`decode_points`."""
    features = F.col(features) if isinstance(features, str) else features
    return F.concat_ws(",", features.cast("array<string>"))
