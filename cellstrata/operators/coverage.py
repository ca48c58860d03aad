"""Sets of cells as half-open ranges of numbers at the finest order, and coverage of shards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import MAX_ORDER


def ranges(cells: DataFrame, cell: str, order) -> DataFrame:
    """lo, hi of each cell; order: a number or a column."""
    up = 2 * (MAX_ORDER - (F.lit(order) if isinstance(order, int) else F.col(order)))
    power = F.pow(F.lit(2.0), up).cast("long")
    return cells.select((F.col(cell) * power).alias("lo"), ((F.col(cell) + 1) * power).alias("hi"))


#: Order of the cells by which set operations are dealt out; ranges are cut at their edges and joined again.
DEAL_ORDER = 5


def _dealt(ranges_: DataFrame, order: int) -> DataFrame:
    """__bucket, lo, hi: ranges cut at the edges of the cells of an order.

    A range over very many cells is cut in two steps, so that no task expands it
    alone.
    """
    shift = 2 * (MAX_ORDER - order)
    for step in (2 * (MAX_ORDER - order // 2), shift):
        first, last = F.shiftright("lo", step), F.shiftright(F.col("hi") - 1, step)
        cut = ranges_.select("lo", "hi", F.explode(F.sequence(first, last)).alias("__bucket"))
        low, high = F.greatest("lo", F.shiftleft("__bucket", step)), F.least(F.col("hi"), F.shiftleft(F.col("__bucket") + 1, step))
        ranges_ = cut.select("__bucket", low.alias("lo"), high.alias("hi"))
    return ranges_


def union(*sets: DataFrame, deal_order: int = DEAL_ORDER) -> DataFrame:
    """Ranges that touch or overlap become one.

    Gaps and islands within each coarse cell; then islands that end where a
    cell ends meet those that start there. That second pass has at most two
    rows for each coarse cell, so its windows are small whatever the sets hold.
    """
    every = sets[0].select("lo", "hi")
    for s in sets[1:]:
        every = every.unionByName(s.select("lo", "hi"))
    inner = _islands(_dealt(every.distinct(), deal_order), ["__bucket"])
    shift = 2 * (MAX_ORDER - deal_order)
    mask = (1 << shift) - 1
    at_edge = (F.col("lo").bitwiseAND(F.lit(mask)) == 0) | (F.col("hi").bitwiseAND(F.lit(mask)) == 0)
    edges = inner.where(at_edge).withColumn("__face", F.shiftright("lo", 2 * MAX_ORDER))
    return inner.where(~at_edge).select("lo", "hi").unionByName(_islands(edges.drop("__bucket"), ["__face"]).select("lo", "hi"))


def _islands(ranges_: DataFrame, keys: list[str]) -> DataFrame:
    """keys, lo, hi: ranges of a group that touch or overlap, as one."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    started = ranges_.withColumn("__new", (reach.isNull() | (F.col("lo") > reach)).cast("int"))
    numbered = started.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__island")


def intersection(a: DataFrame, b: DataFrame, bucket_order: int = 3) -> DataFrame:
    """Ranges in both; dealt over the cells of a coarse order that they touch, so the join has a key."""
    shift = 2 * (MAX_ORDER - bucket_order)

    def dealt(s: DataFrame, p: str) -> DataFrame:
        buckets = F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))
        return s.select(F.col("lo").alias(f"{p}lo"), F.col("hi").alias(f"{p}hi"), F.explode(buckets).alias("__bucket"))

    joined = dealt(a, "a").join(dealt(b, "b"), "__bucket")
    edge = F.shiftleft("__bucket", shift)
    low = F.greatest("alo", "blo", edge)
    high = F.least(F.col("ahi"), F.col("bhi"), F.shiftleft(F.col("__bucket") + 1, shift))
    return union(joined.select(low.alias("lo"), high.alias("hi")).where("lo < hi"))


def difference(a: DataFrame, b: DataFrame, bucket_order: int = 3) -> DataFrame:
    """Ranges in a but not in b, by a sweep over the ends of both within coarse cells."""
    shift = 2 * (MAX_ORDER - bucket_order)

    def ends(s: DataFrame, weight: int) -> DataFrame:
        cut = s.withColumn("__bucket", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))))
        low = F.greatest("lo", F.shiftleft("__bucket", shift))
        high = F.least(F.col("hi"), F.shiftleft(F.col("__bucket") + 1, shift))
        both = F.array(F.struct(low.alias("at"), F.lit(weight).alias("step")), F.struct(high.alias("at"), F.lit(-weight).alias("step")))
        return cut.select("__bucket", F.explode(both).alias("e")).select("__bucket", "e.at", "e.step")

    steps = ends(union(a), 1).unionByName(ends(union(b), 1_000_000)).groupBy("__bucket", "at").agg(F.sum("step").alias("step"))
    w = Window.partitionBy("__bucket").orderBy("at")
    state = steps.select("__bucket", F.col("at").alias("lo"), F.lead("at").over(w).alias("hi"), F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n"))
    return union(state.where("n = 1 and hi is not null").select("lo", "hi"))


def to_order(moc: DataFrame, order: int) -> DataFrame:
    """Cells of an order that a set touches."""
    shift = 2 * (MAX_ORDER - order)
    return moc.select(F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("cell")).distinct()


def compacted(cells: DataFrame, cell: str, order: int, top: int = 0) -> DataFrame:
    """Mixed orders (order, cell): four complete siblings become their parent, as often as that goes."""
    level, out = cells.select(F.col(cell).alias("cell")).distinct(), None
    for o in range(order, top, -1):
        parents = level.groupBy(F.shiftright("cell", 2).alias("up")).agg(F.count("*").alias("n"))
        full = parents.where("n = 4").select("up")
        kept = level.join(full, F.shiftright("cell", 2) == F.col("up"), "left_anti").select(F.lit(o).alias("order"), "cell")
        out = kept if out is None else out.unionByName(kept)
        level = full.select(F.col("up").alias("cell"))
    rest = level.select(F.lit(top).alias("order"), "cell")
    return rest if out is None else out.unionByName(rest)


def box(cells: DataFrame, shard: str, cell: str, order: int) -> DataFrame:
    """At most four cells, of one order, that hold each shard's cells: the finest order at which no more than four do.

    Cells are counted at all orders in one aggregation of distinct ancestors;
    a shard whose cells share fewer than four faces always gets a box.
    """
    spread = cells.select(shard, F.posexplode(F.array(*[F.shiftright(cell, 2 * k) for k in range(order + 1)])).alias("__up", "__cell")).distinct()
    counted = spread.groupBy(shard, "__up").agg(F.count("*").alias("n"))
    finest = counted.where("n <= 4").groupBy(shard).agg(F.min("__up").alias("__best"))
    kept = spread.withColumnRenamed(shard, "__s").join(finest, (F.col("__s") == F.col(shard)) & (F.col("__up") == F.col("__best")))
    return kept.groupBy(shard).agg((F.lit(order) - F.first("__best")).alias("box_order"), F.sort_array(F.collect_list("__cell")).alias("box"))


def bitmap(cells: DataFrame, shard: str, cell: str, levels: int) -> DataFrame:
    """Occupancy of each shard as text of 0 and 1, bit i for its i-th child."""
    n = 1 << (2 * levels)
    bit = F.col(cell).bitwiseAND(F.lit(n - 1))
    seen = cells.groupBy(shard).agg(F.collect_set(bit).alias("__bits"))
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")), lambda i: F.when(F.array_contains("__bits", i), "1").otherwise("0")), "")
    return seen.select(shard, text.alias("bitmap"), F.size("__bits").alias("n"))


def masked(cells: DataFrame, cell: str, order: int, aoi: DataFrame, name: str = "in_aoi", deal_order: int = DEAL_ORDER) -> DataFrame:
    """cells with whether they meet a set of ranges; none is dropped.

    The set is made disjoint and cut at coarse cells, each of which has the list
    of its parts; a cell looks only at that of its own. So the set is never
    expanded to cells, at any order.
    """
    deal = min(deal_order, order)
    parts = _dealt(union(aoi), deal).groupBy("__bucket").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("__parts"))
    low, high = F.shiftleft(F.col(cell), 2 * (MAX_ORDER - order)), F.shiftleft(F.col(cell) + 1, 2 * (MAX_ORDER - order))
    keyed = cells.withColumn("__own", F.shiftright(F.col(cell), 2 * (order - deal)))
    met = F.exists("__parts", lambda p: (p["lo"] < high) & (p["hi"] > low))
    return keyed.join(parts, F.col("__own") == F.col("__bucket"), "left").withColumn(name, F.coalesce(met, F.lit(False))).drop("__own", "__bucket", "__parts")


def in_polygon(x, y, ring: list[tuple[float, float]]) -> Column:
    """Whether a point is in a plane polygon, by the parity of the edges that a ray crosses."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    odd = F.lit(0)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y0 == y1:
            continue
        crosses = ((y >= min(y0, y1)) & (y < max(y0, y1))) & (x < x0 + (y - y0) * ((x1 - x0) / (y1 - y0)))
        odd = odd + crosses.cast("int")
    return F.pmod(odd, F.lit(2)) == 1


def cover_box(xmin: float, ymin: float, xmax: float, ymax: float, order: int, step: float | None = None) -> np.ndarray:
    """Points, in degrees, so close in a box that their cells at an order are a cover of it (used on the driver for regions of interest)."""
    step = step or 58.6 / (1 << order) / 4
    lats = np.unique(np.append(np.arange(ymin, ymax, step), ymax))
    lons = np.unique(np.append(np.arange(xmin, xmax, step), xmax))
    return np.stack(np.meshgrid(lats, lons, indexing="ij"), axis=-1).reshape(-1, 2)
