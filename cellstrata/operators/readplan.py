"""Runs of wanted records and the slices of samples to read for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of_run(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value differs from the row before."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) == 1
    return df.withColumn("__first", first | ~before.eqNullSafe(F.col(value))).where("__first").drop("__first")


def crosses_box(lat: str, lon: str, keys: list[str], order: str, box: tuple[float, float, float, float]) -> Column:
    """Whether a record's point is in (xmin, ymin, xmax, ymax) or the segment to the next one may cross it."""
    w = Window.partitionBy(*keys).orderBy(order)
    next_lat, next_lon = F.coalesce(F.lead(lat).over(w), F.col(lat)), F.coalesce(F.lead(lon).over(w), F.col(lon))
    x0, y0, x1, y1 = box
    t_in, t_out = F.lit(0.0), F.lit(1.0)
    for a, b, low, high in ((F.col(lon), next_lon, x0, x1), (F.col(lat), next_lat, y0, y1)):
        d = b - a
        near = F.when(d > 0, (low - a) / d).when(d < 0, (high - a) / d).otherwise(F.when(a.between(low, high), 0.0).otherwise(2.0))
        far = F.when(d > 0, (high - a) / d).when(d < 0, (low - a) / d).otherwise(F.when(a.between(low, high), 1.0).otherwise(-1.0))
        t_in, t_out = F.greatest(t_in, near), F.least(t_out, far)
    return t_in <= t_out


def slices(records: DataFrame, keys: list[str], order: str, wanted: str, begin: str, count: str, base: int = 0, pad: int = 0, full_above: float = 0.9) -> DataFrame:
    """keys, start, stop: slices of samples that cover the wanted records.

    Runs of wanted records grow by pad on both sides and merge if they meet.
    Records without samples never bound a slice. If a key's slices hold more
    than full_above of its samples, it gets one slice of all.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    near = w.rowsBetween(-pad, pad)
    sampled = records.withColumn("__keep", F.max(F.col(wanted).cast("int")).over(near) == 1)
    all_samples = Window.partitionBy(*keys)
    sampled = sampled.withColumn("__total", F.sum(count).over(all_samples))
    sampled = sampled.withColumn("__start", F.lag("__keep", 1, False).over(w) != F.col("__keep"))
    runs = sampled.withColumn("__run", F.sum(F.col("__start").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    kept = runs.where(F.col("__keep") & (F.col(count) > 0))
    first, stop = F.min(F.col(begin) - base).alias("start"), F.max(F.col(begin) - base + F.col(count)).alias("stop")
    found = kept.groupBy(*keys, "__run").agg(first, stop, F.first("__total").alias("__total"))
    share = F.sum(F.col("stop") - F.col("start")).over(Window.partitionBy(*keys)) > full_above * F.col("__total")
    judged = found.withColumn("__full", share)
    part = judged.where("not __full").select(*keys, "start", "stop")
    whole = judged.where("__full").groupBy(*keys).agg(F.lit(0).cast("long").alias("start"), F.first("__total").alias("stop"))
    return part.unionByName(whole)


def chunk_boundaries(points: DataFrame, keys: list[str], order: str, lat: str, lon: str, chunk: int) -> DataFrame:
    """First and last coordinate of each storage chunk of `chunk` points."""
    number = F.floor(F.col(order) / chunk).alias("chunk")
    ends = [f(c, order).alias(f"{n}_{c}") for n, f in (("first", F.min_by), ("last", F.max_by)) for c in (lat, lon)]
    return points.groupBy(*keys, number).agg(F.min(order).alias("elem_start"), (F.max(order) + 1).alias("elem_end"), *ends)


def planned(samples: DataFrame, found: DataFrame, keys: list[str], position: str, width: int = 4096) -> DataFrame:
    """Samples whose position is in one of their key's slices.

    Slices and samples are dealt over stretches of `width` positions, so the join
    has a key. A slice of which samples are missing fails the job: a part that
    could not be read must not look like an empty one.
    """
    cut = found.select(*[F.col(k).alias(f"__{k}") for k in keys], "start", "stop").withColumn("__stretch", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))))
    cut = cut.withColumn("__due", F.least("stop", (F.col("__stretch") + 1) * width) - F.greatest("start", F.col("__stretch") * width))
    own = samples.withColumn("__at", F.floor(F.col(position) / width))
    same = [own[k] == cut[f"__{k}"] for k in keys] + [own["__at"] == cut["__stretch"], own[position] >= cut["start"], own[position] < cut["stop"]]
    met = own.join(cut, same, "right")
    got = F.count(position).over(Window.partitionBy(*[f"__{k}" for k in keys], "start", "__stretch"))
    whole = F.when(got < F.col("__due"), F.raise_error(F.lit("samples of a slice are missing"))).otherwise(got)
    return met.withColumn("__got", whole).where("__got >= 0").select(*samples.columns)


def route(config: dict) -> str:
    """How a source is read: by its vlen links, by a plan from records or chunk bounds, or in full."""
    if config.get("vlen"):
        return "vlen"
    if config.get("chunk_bounds"):
        return "apriori"
    return "planned" if config.get("records") else "full"


def vlen(records: DataFrame, samples: str, variables: dict[str, tuple[str, str, str]], sibling: tuple | None = None) -> DataFrame:
    """One row for each sample of each record, with synthesized coordinates and the columns of a sibling.

    variables: name: (start, stop, count), columns of the record between whose
    values the sample's lies. sibling: table, left key, right key, variables, and
    a condition on the sibling or None; records whose sibling fails it go.
    """
    from . import joins

    if sibling:
        right, left_key, right_key, own, keep = sibling
        if keep is not None:
            records = joins.sibling_filter(records, right, left_key, right_key, keep)
        records = joins.sibling(records, right, left_key, right_key, own)
    each = joins.explode_samples(records, samples)
    return each.withColumns({n: joins.linspace(a, b, "index_in_record", c) for n, (a, b, c) in variables.items()})


def apriori(bounds: DataFrame, keys: list[str], box: tuple[float, float, float, float], lat: str, lon: str, margin: float = 0.0) -> DataFrame:
    """Slices of the chunks that may touch a box (xmin, ymin, xmax, ymax), by the bounds of chunk_boundaries; chunks in a row make one slice."""
    x0, y0, x1, y1 = box

    def meets(c: str, low: float, high: float) -> Column:
        a, b = F.col(f"first_{c}"), F.col(f"last_{c}")
        return (F.least(a, b) <= high + margin) & (F.greatest(a, b) >= low - margin)

    hit = bounds.where(meets(lon, x0, x1) & meets(lat, y0, y1))
    w = Window.partitionBy(*keys).orderBy("elem_start")
    numbered = hit.withColumn("__new", (~F.lag("elem_end").over(w).eqNullSafe(F.col("elem_start"))).cast("int"))
    numbered = numbered.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__run").agg(F.min("elem_start").alias("start"), F.max("elem_end").alias("stop")).drop("__run")


def chunk_map(points: DataFrame, keys: list[str], order: str, chunk: int, row_bytes: int) -> DataFrame:
    """Index of storage chunks: their elements and byte ranges."""
    number = F.floor(F.col(order) / chunk).alias("chunk_idx")
    found = points.groupBy(*keys, number).agg(F.min(order).alias("elem_start"), (F.max(order) + 1).alias("elem_end"))
    return found.withColumns({"byte_offset": F.col("elem_start") * row_bytes, "nbytes": (F.col("elem_end") - F.col("elem_start")) * row_bytes})
