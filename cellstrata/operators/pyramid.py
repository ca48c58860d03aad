"""Folding cells up a hierarchy under declared merge laws."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import NAN, present
from . import sketch

#: Exact laws by function. Everything else but digests has none and stays at the native level.
LAWS = {"len": "sum", "count": "sum", "sum": "sum", "nansum": "sum", "min": "min", "nanmin": "min", "max": "max", "nanmax": "max"}


def law_class(function: str | None) -> str:
    return "exact" if (function or "") in LAWS else "approximate" if function == "tdigest" else "none"


def law(name: str, function: str, fill=None) -> Column:
    """Aggregate over children: missing ones (NaN or the fill) don't count; all missing gives the fill."""
    x = F.col(name)
    seen = present(x)
    if fill is not None and fill == fill:
        seen = F.when(x != fill, seen)
    value = {"sum": F.sum, "min": F.min, "max": F.max}[LAWS[function]](seen)
    return F.coalesce(value, F.lit(NAN if fill is None else fill))


def fold(cells: DataFrame, cell: str, levels: int, laws: dict[str, str], fills: dict | None = None, keep: list[str] = ()) -> DataFrame:
    """Cells so many levels up; keep: further keys, such as the window (leave it out to fold over all time)."""
    parent = F.shiftright(cell, 2 * levels).alias(cell)
    kinds = dict(cells.dtypes)
    return cells.groupBy(parent, *keep).agg(*[law(n, f, (fills or {}).get(n)).cast(kinds[n] if LAWS[f] != "sum" else "long" if kinds[n] in ("int", "bigint") else kinds[n]).alias(n) for n, f in laws.items()])


def column(cells: DataFrame, cell: str, order: int, orders: list[int], laws: dict[str, str], fills: dict | None = None) -> DataFrame:
    """All given orders in one pass: (order, cell, fields), each folded straight from the cells by grouping sets over their ancestors."""
    if any(a <= b for a, b in zip(orders, orders[1:], strict=False)) or any(o >= order for o in orders):
        raise ValueError("orders must fall, below the cells' own")
    each = F.explode(F.array(*[F.struct(F.lit(o).alias("order"), F.shiftright(cell, 2 * (order - o)).alias("up")) for o in orders]))
    rows = cells.withColumn("__up", each)
    kinds = dict(cells.dtypes)
    return rows.groupBy(F.col("__up.order").alias("order"), F.col("__up.up").alias(cell)).agg(*[law(n, f, (fills or {}).get(n)).cast(kinds[n]).alias(n) for n, f in laws.items()])


def ladder(parent_order: int, declared: list[int]) -> list[tuple[int, list[int]]]:
    """Overview levels: the shard's own, then one for each coarser order at the same depth."""
    depth = min(declared) - parent_order
    return [(parent_order, declared)] + [(k, [k + depth]) for k in range(parent_order - 1, -1, -1)]


def digests(cells: DataFrame, cell: str, levels: int, digest: str = "digest", delta: float = 512, keep: list[str] = ()) -> DataFrame:
    """Digests of ancestors, each merged at once from the cells' own, never from merged ones."""
    up = cells.withColumn(cell, F.shiftright(cell, 2 * levels))
    return sketch.fold(up, [cell, *keep], digest, delta)


def dirty_ancestors(changed: DataFrame, cell: str, levels: int) -> DataFrame:
    return changed.select(F.shiftright(cell, 2 * levels).alias(cell)).distinct()


def refreshed(previous: DataFrame, cells: DataFrame, changed: DataFrame, cell: str, levels: int, laws: dict[str, str], fills: dict | None = None) -> DataFrame:
    """The coarse level with only the ancestors of changed cells folded anew."""
    dirty = dirty_ancestors(changed, cell, levels).withColumnRenamed(cell, "__dirty")
    own = cells.join(dirty, F.shiftright(cell, 2 * levels) == F.col("__dirty"), "left_semi")
    kept = previous.join(dirty, F.col(cell) == F.col("__dirty"), "left_anti")
    return kept.unionByName(fold(own, cell, levels, laws, fills))


def merged_partials(parts: list[DataFrame], keys: list[str], laws: dict[str, str], fills: dict | None = None) -> DataFrame:
    """Partial results of the same cells, as from blocks or micro-batches, as one."""
    every = reduce(DataFrame.unionByName, parts)
    kinds = dict(every.dtypes)
    return every.groupBy(*keys).agg(*[law(n, f, (fills or {}).get(n)).cast(kinds[n]).alias(n) for n, f in laws.items()])


def subtrees(cell: str, order: int, split_order: int) -> Column:
    """Number of the subtree at split_order under which a cell lies, to deal a sweep out."""
    return F.shiftright(cell, 2 * (order - split_order))
