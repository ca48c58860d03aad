"""Nearest-neighbour sampling of rasters onto cells, and which raster owns a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import pixel


def sample(cells: DataFrame, pixels: DataFrame, affine: tuple, rows: int, cols: int, x: str = "x", y: str = "y", nodata=None) -> DataFrame:
    """cells with the value of the pixel (row, col, value) that they fall in; others go."""
    row, col = pixel(x, y, affine, rows, cols)
    at = cells.withColumns({"row": row, "col": col}).where("row is not null and col is not null")
    good = pixels.where(F.col("value") != nodata) if nodata is not None else pixels
    return at.join(good, ["row", "col"])


def squared_chord(lat, lon, lat0, lon0) -> Column:
    """Squared distance through the unit sphere of points in degrees."""
    lat, lon, lat0, lon0 = (F.radians(c) for c in (lat, lon, lat0, lon0))
    x = F.cos(lat) * F.cos(lon) - F.cos(lat0) * F.cos(lon0)
    y = F.cos(lat) * F.sin(lon) - F.cos(lat0) * F.sin(lon0)
    z = F.sin(lat) - F.sin(lat0)
    return x * x + y * y + z * z


def owned(samples: DataFrame, keys: list[str], value: str, distance: str, item: str) -> DataFrame:
    """For each key the value of the valid item whose centre is nearest; the first item wins ties."""
    rank = F.struct(F.col(distance), F.col(item))
    return samples.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, rank).alias(value), F.min_by(item, rank).alias(item))


def time_steps(items: DataFrame, when: str = "datetime", key: str = "time_key") -> DataFrame:
    """key, first time and index of each acquisition: items of one key (else of one time) are one step, in order of their earliest time."""
    own = F.coalesce(F.col(key), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"))
    steps = items.groupBy(own.alias(key)).agg(F.min(when).alias(when))
    return steps.withColumn("t_index", F.row_number().over(Window.orderBy(when, key)) - 1)
