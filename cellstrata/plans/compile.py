"""From a spec to DataFrame plans; Catalyst chooses how they run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.cells import HealpixGrid
from ..functions.expressions import per_row
from ..operators import aggregate, filters, pyramid, sketch
from .spec import PipelineSpec


@dataclass(frozen=True)
class Result:
    """Native cells and, by order, the levels above."""

    cells: DataFrame
    levels: dict[int, DataFrame]


def observations(spec: PipelineSpec, source: DataFrame) -> DataFrame:
    """Declared variables of the rows that the filters keep, with cell, shard (and chunk, window)."""
    columns = {n: F.col(c) if isinstance(c, str) else F.get(F.col(c["path"]), F.lit(c["column"])) for n, c in spec.variables.items()}
    df = source.select(F.col(spec.latitude).alias("__lat"), F.col(spec.longitude).alias("__lon"), *[c.alias(n) for n, c in columns.items()])
    df = filters.apply(df, list(spec.filters), spec.expression, spec.quality_filter)
    df = spec.grid.with_cell(df, "__lat", "__lon").where("cell is not null and cell >= 0").drop("__lat", "__lon")
    df = df.withColumn("shard", spec.grid.shard("cell"))
    if spec.chunk_scalars:
        df = df.withColumn("chunk", spec.grid.chunk("cell") if isinstance(spec.grid, HealpixGrid) else F.col("shard"))
    return df.withColumn("window", times.label(spec.time_field, spec.schedule)) if spec.schedule else df


def run(spec: PipelineSpec, source: DataFrame) -> Result:
    df = observations(spec, source)
    keys = ["cell", "shard"] + (["window"] if spec.schedule else [])
    if spec.chunk_scalars:
        joined = aggregate.with_chunk_scalars(df, "chunk", spec.chunk_scalars)
        known = {n: F.first(n) for n in spec.chunk_scalars}
        cells = joined.groupBy(*keys).agg(*[f.column(df.columns, known) for f in spec.fields])
    else:
        cells = aggregate.by_cell(df, list(spec.fields), keys)
    if spec.digests or spec.pyramid:
        cells = cells.persist(StorageLevel.DISK_ONLY)  # read again by each level and digest
    for d in spec.digests:
        where = per_row(d.where, df.columns) if d.where else None
        cells = cells.join(sketch.build(df, keys, d.source, d.delta, d.weight, where, d.name), keys, "left")
    levels = {}
    if spec.pyramid:
        laws = spec.foldable()
        fills = {f.name: f.fill for f in spec.fields}
        keep = [k for k in keys if k == "window"]
        for order in spec.pyramid:
            up = spec.grid.child_order - order
            levels[order] = pyramid.fold(cells, "cell", up, laws, fills, keep)
            for d in spec.digests:
                levels[order] = levels[order].join(pyramid.digests(cells, "cell", up, d.name, d.delta, keep), ["cell", *keep], "left")
    return Result(cells, levels)
