"""Named capabilities: users add their own under a kind; duplicates are refused."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from importlib.metadata import entry_points

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.expressions import REDUCTIONS, SCALARS
from ..operators.events import REDUCERS, SPATIAL, triggered
from ..operators.filters import event_mask
from ..operators.joins import monthly_anomaly
from ..sources.catalog import from_items

KINDS: dict[str, dict[str, Callable]] = {"reduction": REDUCTIONS, "scalar": SCALARS, "spatial": SPATIAL, "reducer": REDUCERS, "mask": {k: partial(event_mask, k) for k in ("full", "ais", "ocean")}, "transform": {"monthly_anomaly": monthly_anomaly}, "trigger": {"first_intersection": triggered, "first_landfall": triggered}, "source": {"items": from_items}}


def register(kind: str, name: str, function: Callable, replace: bool = False) -> Callable:
    known = KINDS[kind]
    if name in known and not replace:
        raise ValueError(f"{kind} {name!r} is there already")
    known[name] = function
    return function


def describe(kind: str) -> dict[str, str]:
    return {n: (f.__doc__ or "").strip().split("\n")[0] for n, f in sorted(KINDS[kind].items())}


def discover(group: str = "cellstrata.plugins") -> list[str]:
    """Loads installed plugins; each registers itself when called."""
    found = []
    for point in entry_points(group=group):
        point.load()()
        found.append(point.name)
    return found


def register_sql(spark) -> None:
    """SQL names for what has no built-in of its own."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION rect_cell(x DOUBLE, y DOUBLE, xmin DOUBLE, ymax DOUBLE, size DOUBLE, width BIGINT) RETURNS BIGINT RETURN CAST(floor((ymax - y) / size) * width + floor((x - xmin) / size) AS BIGINT)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION parent_cell(cell BIGINT, levels INT) RETURNS BIGINT RETURN shiftright(cell, 2 * levels)")


def user_aggregate(df: DataFrame, keys: list[str], columns: list[str], made: type, result: str, name: str = "value") -> DataFrame:
    """A user's aggregate with __init__, update(**arrays) and finalize(): update gets the group's rows in Arrow batches, one after the other."""
    schema = df.select(*keys).withColumn(name, F.lit(None).cast(result)).schema

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = made()
        for batch in batches:
            state.update(**{c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns})
        value = pa.array([state.finalize()], to_arrow_type(schema[name].dataType))
        yield pa.RecordBatch.from_arrays([*[pa.array([k.as_py()], k.type) for k in key], value], [*keys, name])

    return df.select(*keys, *columns).groupBy(*keys).applyInArrow(run, schema)


def companion_aggregate(df: DataFrame, keys: list[str], value: str, function: Callable, payload: str, location: str | None = None, time: str | None = None, **params) -> DataFrame:
    """A user's reducer fn(values, locations=, temporal=, **params) of each group, which gives the payload and, for each companion asked for, a word."""
    asked = {k: c for k, c in (("locations", location), ("temporal", time)) if c}
    schema = df.select(*keys).withColumn("payload", F.lit(None).cast(payload)).withColumns({k: F.lit(0).cast("long") for k in asked}).schema

    def run(key: tuple, table: pa.Table) -> pa.Table:
        given = {k: table.column(c).to_numpy() for k, c in asked.items()}
        found = function(table.column(value).to_numpy(), **given, **params)
        first, *words = found if asked else (found,)
        if len(words) != len(asked):
            raise ValueError("one word for each companion")
        values = [pa.array([first], to_arrow_type(schema["payload"].dataType)), *[pa.array([w], pa.int64()) for w in words]]
        return pa.Table.from_arrays([*[pa.array([k.as_py()], k.type) for k in key], *values], schema.names)

    return df.select(*keys, value, *asked.values()).groupBy(*keys).applyInArrow(run, schema)
