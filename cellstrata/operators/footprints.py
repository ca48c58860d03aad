"""Footprints of granules: cells they cover, exact polygon tests, corridors of swaths, and the pairs of granules and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import RectGrid, coarsen, with_center
from ..functions.times import overlaps


def rect_cells(grid: RectGrid, xmin, ymin, xmax, ymax) -> Column:
    """Cells of a grid that a closed box meets, in order; an empty array outside the grid. The index column of a catalog."""
    xmin, ymin, xmax, ymax = (F.col(c) if isinstance(c, str) else c for c in (xmin, ymin, xmax, ymax))
    left, right = (F.floor((x - grid.xmin) / grid.rx) for x in (xmin, xmax))
    top, bottom = (F.floor((grid.ymax - y) / grid.ry) for y in (ymax, ymin))
    left, top = F.greatest(left, F.lit(0)), F.greatest(top, F.lit(0))
    right, bottom = F.least(right, F.lit(grid.width - 1)), F.least(bottom, F.lit(grid.height - 1))
    rows = F.transform(F.sequence(top, bottom), lambda r: F.transform(F.sequence(left, right), lambda c: (r * grid.width + c).cast("long")))
    return F.when((left <= right) & (top <= bottom), F.flatten(rows)).otherwise(F.array().cast("array<long>"))


def cover(spark, box: tuple[float, float, float, float], order: int) -> DataFrame:
    """Nested cells of an order that may meet a box in degrees (xmin, ymin, xmax, ymax): descends from the base cells and drops what is too far off at each order.

    A cell's points are at most 59 degrees, halved with each order, from its centre.
    """
    xmin, ymin, xmax, ymax = box
    level = spark.range(12).select(F.col("id").alias("cell"))
    for o in range(order + 1):
        if o:
            level = level.select(F.explode(F.sequence(F.col("cell") * 4, F.col("cell") * 4 + 3)).alias("cell"))
        reach = 59.0 / (1 << o)
        placed = with_center(level, "cell", o, "__lat", "__lon")
        near_lat = F.col("__lat").between(ymin - reach, ymax + reach)
        # Meridians close up towards the poles: within reach of one every longitude is near.
        wide = F.lit(reach) / F.greatest(F.cos(F.radians(F.least(F.abs("__lat") + reach, F.lit(90.0)))), F.lit(1e-6))
        east = F.pmod(F.col("__lon") - xmin, F.lit(360.0))
        near_lon = (wide >= 180) | (east <= (xmax - xmin) + wide) | (east >= 360 - wide)
        level = placed.where(near_lat & near_lon).select("cell")
    return level


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is in a plane polygon given as an array of structs (x, y), by the parity of the edges that a ray crosses."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def crosses(a: Column, b: Column) -> Column:
        spans = (y >= F.least(a["y"], b["y"])) & (y < F.greatest(a["y"], b["y"]))
        at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.when(a["y"] != b["y"], b["y"] - a["y"])
        return F.coalesce(spans & (x < at), F.lit(False)).cast("int")

    return F.aggregate(F.zip_with(ring, following, crosses), F.lit(0), lambda n, one: n + one) % 2 == 1


def indexed_pairs(catalog: DataFrame, shards: DataFrame, levels: int, item: str = "id", index: str = "cells", shard: str = "shard") -> DataFrame:
    """item and shard of each pair, from an index column of covering cells: no geometry, an equality join on the coarsened cell."""
    each = catalog.select(item, F.explode(F.array_distinct(F.transform(index, lambda c: coarsen(c, levels)))).alias("__shard"))
    wanted = shards.select(shard).distinct()
    return each.join(wanted, F.col("__shard") == F.col(shard)).select(item, shard)


def refined(pairs: DataFrame, x: str, y: str, ring: str) -> DataFrame:
    """Candidate pairs whose point is truly in the granule's polygon."""
    return pairs.where(in_ring(F.col(x), F.col(y), F.col(ring)))


def map_of(pairs: DataFrame, item: str = "id", shard: str = "shard", ordinal: str | None = None) -> DataFrame:
    """shard and its granules, each once: sorted, or in the order in which `ordinal` first has them."""
    if ordinal is None:
        return pairs.groupBy(shard).agg(F.array_sort(F.collect_set(item)).alias("granules"))
    first = pairs.groupBy(shard, item).agg(F.min(ordinal).alias("__first"))
    rows = first.groupBy(shard).agg(F.array_sort(F.collect_list(F.struct("__first", item))).alias("__rows"))
    return rows.select(shard, F.transform("__rows", lambda r: r[item]).alias("granules"))


def corridors(ring: str, beams: int) -> Column:
    """A swath given by its corners (left start, left end, right end, right start) as an array of `beams` corridors of equal width, corners likewise."""
    r = F.col(ring)

    def between(a: int, b: int, share: float) -> Column:
        return F.struct(*[(r[a][c] + (r[b][c] - r[a][c]) * share).alias(c) for c in ("x", "y")])

    parts = [F.array(between(0, 3, k / beams), between(1, 2, k / beams), between(1, 2, (k + 1) / beams), between(0, 3, (k + 1) / beams)) for k in range(beams)]
    return F.array(*parts)


def in_windows(items: DataFrame, start: str, end: str, windows: list[tuple[str, object, object]]) -> DataFrame:
    """items with the label of each declared half-open window that their closed span meets; an unknown span meets all. windows: label, start, end, a declared list."""
    declared = F.array(*[F.struct(F.lit(name).alias("label"), F.lit(low).alias("low"), F.lit(high).alias("high")) for name, low, high in windows])
    met = F.filter(declared, lambda w: overlaps(F.col(start), F.col(end), w["low"], w["high"]))
    return items.withColumn("__w", F.explode(met)).withColumn("label", F.col("__w.label")).drop("__w")


def geojson(rows, ring: str = "ring", crs: str = "EPSG:4326") -> dict:
    """Outlines as GeoJSON for display, of rows that were collected for it; rings that cross the antimeridian are split there."""
    features = []
    for row in rows:
        points = [(p["x"], p["y"]) for p in row[ring]]
        wide = max(x for x, _ in points) - min(x for x, _ in points) > 180
        parts = [points]
        if wide:
            east = [((x if x >= 0 else x + 360), y) for x, y in points]
            parts = [[(min(x, 180.0), y) for x, y in east], [(max(x, 180.0) - 360, y) for x, y in east]]
        shapes = [[[*map(list, part), list(part[0])]] for part in parts]
        geometry = {"type": "Polygon", "coordinates": shapes[0]} if len(shapes) == 1 else {"type": "MultiPolygon", "coordinates": shapes}
        properties = {k: v for k, v in row.asDict().items() if k != ring}
        features.append({"type": "Feature", "properties": properties, "geometry": geometry})
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": crs}}, "features": features}
