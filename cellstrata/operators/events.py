"""Event pipelines: spatial functions of each timestep, then reducers over an event's timesteps.

Level one groups masked grid cells by (event, t); level two groups its values by
event. Values of level one are a pair of sums (ws, w) where the reducer pools
weights, else one number v.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import NAN, present

EARTH_KM = 6378.0


def _masked(value: str, mask: str) -> Column:
    return F.when(F.col(mask) > 0, present(F.col(value)))


#: Spatial functions by name: aggregates over the cells of a timestep.
SPATIAL: dict[str, Callable[..., dict[str, Column]]] = {
    "max": lambda v, m, a: {"v": F.max(_masked(v, m))},
    "min": lambda v, m, a: {"v": F.min(_masked(v, m))},
    "weighted_sum": lambda v, m, a: {"v": F.coalesce(F.sum(present(F.col(v)) * F.col(m) * F.col(a)), F.lit(0.0))},
    "weighted_mean": lambda v, m, a: {"ws": F.coalesce(F.sum(present(F.col(v)) * F.col(m) * F.col(a)), F.lit(0.0)), "w": F.sum(F.col(m) * F.col(a))},
}

_NEEDS_AREA = {"weighted_sum", "weighted_mean"}

#: Reducers by name: aggregates over timesteps; nothing seen gives NaN.
REDUCERS: dict[str, Callable[[], Column]] = {
    "max": lambda: F.max(present(F.col("v"))),
    "min": lambda: F.min(present(F.col("v"))),
    "sum": lambda: F.sum(present(F.col("v"))),
    "weighted_mean": lambda: F.when(F.sum("w") > 0, F.sum("ws") / F.sum("w")),
    "mean_of_ratios": lambda: F.avg(F.when(F.col("w") > 0, F.col("ws") / F.col("w"))),
    "first_landfall": lambda: F.min_by("v", F.when(F.col("v").isNotNull(), F.col("t"))),
}


def timesteps(cells: DataFrame, function: str, value: str, mask: str = "mask", area: str | None = None, keys: tuple[str, ...] = ("event", "t")) -> DataFrame:
    """One value, or pair of sums, for each event and timestep."""
    if function not in SPATIAL:
        raise ValueError(f"unknown spatial function {function!r}")
    if function in _NEEDS_AREA and area is None:
        raise ValueError(f"{function} needs the cells' areas")
    return cells.groupBy(*keys).agg(*[c.alias(n) for n, c in SPATIAL[function](value, mask, area).items()])


def reduced(steps: DataFrame, reducer: str, name: str, event: str = "event") -> DataFrame:
    if reducer not in REDUCERS:
        raise ValueError(f"unknown reducer {reducer!r}")
    return steps.groupBy(event).agg(F.coalesce(REDUCERS[reducer](), F.lit(NAN)).alias(name))


def gradient(cells: DataFrame, value: str, lat: str = "lat", lon: str = "lon", keys: tuple[str, ...] = ("event", "t"), name: str = "gradient") -> DataFrame:
    """Size of the central-difference gradient on a regular grid in degrees, per km; edges are one-sided, the equator is masked (its metric is 1 / sin of the latitude)."""

    def slope(along: str, across: str) -> Column:
        w = Window.partitionBy(*keys, across).orderBy(along)
        before, after = F.lag(value).over(w), F.lead(value).over(w)
        low, high = F.lag(along).over(w), F.lead(along).over(w)
        rise = F.coalesce(after, F.col(value)) - F.coalesce(before, F.col(value))
        run = F.radians(F.coalesce(high, F.col(along)) - F.coalesce(low, F.col(along)))
        return F.when(run != 0, rise / run)

    dy = slope(lat, lon) / EARTH_KM
    dx = slope(lon, lat) / EARTH_KM / F.sin(F.radians(lat))
    size = F.sqrt(dx * dx + dy * dy)
    return cells.withColumn(name, F.when(F.col(lat) != 0, size))


def max_gradient(cells: DataFrame, value: str, mask: str = "mask", **names) -> DataFrame:
    sloped = gradient(cells, value, **names)
    return timesteps(sloped, "max", "gradient", mask)


def min_over_levels(cells: DataFrame, value: str, keys: tuple[str, ...] = ("event", "t", "lat", "lon"), others: tuple[str, ...] = ("mask", "area")) -> DataFrame:
    """The least value of a column of levels at each place."""
    return cells.groupBy(*keys).agg(F.min(present(F.col(value))).alias(value), *[F.first(o).alias(o) for o in others])


def triggered(cells: DataFrame, static: str, mask: str = "mask", event: str = "event", t: str = "t") -> DataFrame:
    """Cells of the first timestep at which the event's mask meets a static mask."""
    first = cells.where((F.col(mask) > 0) & (F.col(static) > 0)).groupBy(event).agg(F.min(t).alias("__first"))
    return cells.join(first, event).where(F.col(t) == F.col("__first")).drop("__first")


def prepared(df: DataFrame, ts: str = "t", round_to: int | None = None, shift: str | None = None, scale: dict[str, float] | None = None, resample: tuple[str, str] | None = None, keys: tuple[str, ...] = ("lat", "lon"), values: tuple[str, ...] = ()) -> DataFrame:
    """A collection made ready, in this order: coordinates rounded, variables chosen, times shifted, scaled and resampled (interval, sum or mean)."""
    if round_to is not None:
        df = df.withColumns({k: F.round(k, round_to) for k in keys})
    df = df.select(*keys, ts, *values)
    if shift:
        df = df.withColumn(ts, F.col(ts) + F.expr(f"INTERVAL {shift}"))
    for name, factor in (scale or {}).items():
        df = df.withColumn(name, F.col(name) * factor)
    if resample:
        every, how = resample
        agg = {"sum": F.sum, "mean": F.avg}[how]
        df = df.groupBy(*keys, F.window(ts, every).alias("__w")).agg(*[agg(v).alias(v) for v in values]).withColumn(ts, F.col("__w.start")).drop("__w")
    return df


def table(events: DataFrame, results: list[DataFrame], event: str = "event") -> DataFrame:
    """One row for each event with all results; missing ones are NaN."""
    out = events.select(event).distinct()
    for r in results:
        names = [c for c in r.columns if c != event]
        out = out.join(r, event, "left").fillna(NAN, names)
    return out
