"""t-digests of cells: one build for each cell from its rows, and folds of digests.

A digest is array<struct<mean: float, weight: float>>. Rows are sorted within
the kernel by value and weight, so results don't depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import tdigest as td
from ..functions.cells import ancestor_of

#: Companions of a centroid: what its members span, as struct fields by kind.
COMPANIONS = {"location": ("low", "high"), "time": ("start", "end")}


def _digest_type(companions) -> T.ArrayType:
    fields = [T.StructField(n, T.FloatType()) for n in ("mean", "weight")]
    fields += [T.StructField(n, T.LongType()) for c in companions for n in COMPANIONS[c]]
    return T.ArrayType(T.StructType(fields))


def _per_list(df: DataFrame, keys: list[str], rows: str, companions, kernel, name: str) -> DataFrame:
    """keys and kernel(columns of the row's list) for each row of df; lists and digests go through Arrow as flat arrays."""
    kind = _digest_type(companions)
    arrow = to_arrow_type(kind).value_type
    schema = df.select(*keys).withColumn(name, F.lit(None).cast(kind)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(rows)
            flat, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            columns = [c.to_numpy(zero_copy_only=False) for c in flat.flatten()]
            parts, offsets, begin = [], [0], 0
            for n, end in enumerate(ends.tolist()):
                parts.append(kernel(n, batch, [c[begin:end] for c in columns]))
                offsets.append(offsets[-1] + len(parts[-1][0]))
                begin = end
            made = []
            for k, field in enumerate(arrow):
                values = np.concatenate([p[k] for p in parts]) if parts else np.empty(0)
                made.append(pa.array(values.astype(field.type.to_pandas_dtype())))
            digests = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(made, fields=list(arrow)))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], digests], [*keys, name])

    return df.mapInArrow(run, schema)


def _spans(columns: list[np.ndarray], order: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Least and greatest of each pair of columns over the members of each centroid."""
    out = []
    for k, column in enumerate(columns):
        merge = np.minimum if k % 2 == 0 else np.maximum
        out.append(merge.reduceat(column[order], first) if len(first) else np.empty(0, np.int64))
    return out


def build(df: DataFrame, keys: list[str], value: str, delta: float = 512, weight: str | None = None, where: Column | None = None, name: str = "digest", location: str | None = None, time: str | None = None) -> DataFrame:
    """keys and the digest of the finite values of the rows that `where` takes; cells without any get an empty digest.

    With a location (a cell) or a time (a long), each centroid also has the least
    and greatest of its members', as low and high, start and end. Values of a
    cell meet in one array, so a cell must fit in a task; for larger ones build
    on finer cells and fold.
    """
    x = F.col(value).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    good = ~F.isnan(x) & (F.abs(x) != float("inf")) & ~F.isnan(w) & (w > 0)
    companions = {k: c for k, c in (("location", location), ("time", time)) if c}
    others = [F.col(c).cast("long").alias(n) for k, c in companions.items() for n in COMPANIONS[k]]
    taken = F.when(good & where if where is not None else good, F.struct(x.alias("x"), w.alias("w"), *others))
    lists = df.groupBy(*keys).agg(F.collect_list(taken).alias("__rows"))

    def kernel(n: int, batch: pa.RecordBatch, columns: list[np.ndarray]) -> list[np.ndarray]:
        rows, order = td.members(columns[0], columns[1], columns[2::2])
        digest, first = td.compress(rows, delta)
        return [digest[:, 0], digest[:, 1], *_spans(columns[2:], order, first)]

    return _per_list(lists, keys, "__rows", list(companions), kernel, name)


def fold(df: DataFrame, keys: list[str], digest: str = "digest", delta: float = 512, name: str | None = None, order: str | None = None) -> DataFrame:
    """keys and the merge of a group's digests, companions included.

    All at once, the same whatever the order or partitioning. With `order`, two
    by two in the order of that column: the pairwise law.
    """
    fields = [f.name for f in df.schema[digest].dataType.elementType]
    companions = [k for k, names in COMPANIONS.items() if names[0] in fields]
    own = F.when(F.size(digest) > 0, F.col(digest))  # empty ones don't count
    entry = F.struct(F.col(order).alias("at") if order else F.lit(0).alias("at"), own.alias("d"))
    lists = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(own.isNotNull(), entry))).alias("__parts") if order else F.collect_list(F.when(own.isNotNull(), entry)).alias("__parts"))
    flat = lists.select(*keys, F.flatten(F.transform("__parts", lambda p: p["d"])).alias("__rows"), F.transform("__parts", lambda p: F.size(p["d"])).alias("__sizes"))

    def kernel(n: int, batch: pa.RecordBatch, columns: list[np.ndarray]) -> list[np.ndarray]:
        sizes = batch.column("__sizes")[n].as_py()
        columns = [c.astype(np.float64) if k < 2 else c for k, c in enumerate(columns)]
        if len(sizes) < 2:
            return columns
        if not order:
            return _merged(columns, np.lexsort(columns[::-1]), delta)
        total, begin = [c[: sizes[0]] for c in columns], sizes[0]
        for size in sizes[1:]:
            both = [np.concatenate([t, c[begin : begin + size]]) for t, c in zip(total, columns, strict=True)]
            total, begin = _merged(both, np.argsort(both[0], kind="stable"), delta), begin + size
        return total

    return _per_list(flat, keys, "__rows", companions, kernel, name or digest)


def _merged(columns: list[np.ndarray], order: np.ndarray, delta: float) -> list[np.ndarray]:
    out, first = td.compress(np.stack([columns[0][order], columns[1][order]], axis=1), delta)
    return [out[:, 0].astype(np.float64), out[:, 1].astype(np.float64), *_spans(columns[2:], order, first)]


def with_ancestors(df: DataFrame, order: int, digest: str = "digest", name: str = "locations") -> DataFrame:
    """df with the least cell that holds the members of each centroid, in the numbering for mixed orders; null where their faces differ."""
    return df.withColumn(name, F.transform(digest, lambda c: ancestor_of(c["low"], c["high"], order)))


def occupancy(df: DataFrame, cell: str, covered: DataFrame, digest: str = "digest", name: str = "mask") -> DataFrame:
    """covered cells with 2 where df has a digest with centroids, 1 where an empty one, 0 where none: the mask of a dense block."""
    own = df.select(F.col(cell).alias("__cell"), F.when(F.size(digest) > 0, 2).otherwise(1).alias("__mask"))
    return covered.join(own, covered[cell] == F.col("__cell"), "left").withColumn(name, F.coalesce("__mask", F.lit(0))).drop("__cell", "__mask")


def _points(digests: pd.Series) -> list[np.ndarray]:
    return [np.array([(c["mean"], c["weight"]) for c in d]).reshape(-1, 2) for d in digests]


def quantiles(df: DataFrame, digest: str, qs: dict[str, float]) -> DataFrame:
    """df with a column for each quantile; NaN for empty digests."""

    def of(q: float):
        @F.pandas_udf("double")
        def kernel(digests: pd.Series) -> pd.Series:
            return pd.Series([td.quantile(d, q) for d in _points(digests)])

        return kernel

    return df.withColumns({n: F.coalesce(of(q)(digest), F.lit(float("nan"))) for n, q in qs.items()})  # pandas hands NaN on as null


def cdf_at(df: DataFrame, digest: str, value: str, name: str = "cdf") -> DataFrame:
    @F.pandas_udf("double")
    def kernel(digests: pd.Series, xs: pd.Series) -> pd.Series:
        return pd.Series([float(td.cdf(d, x)) for d, x in zip(_points(digests), xs, strict=True)])

    return df.withColumn(name, F.coalesce(kernel(digest, value), F.lit(float("nan"))))


def rasterized(df: DataFrame, digest: str, edges: list[float], name: str = "bins") -> DataFrame:
    @F.pandas_udf("array<double>")
    def kernel(digests: pd.Series) -> pd.Series:
        return pd.Series([td.rasterize(d, edges).tolist() for d in _points(digests)])

    return df.withColumn(name, kernel(digest))


def fit_window(low: Column, high: Column, bins: int, resolution: float, policy: str = "raise") -> tuple[Column, Column]:
    """First edge and bin width of a vertical window of `bins` bins that holds low to high. Too wide a span fails, coarsens all bins, or is cut at the top."""
    start = F.floor(low / resolution) * resolution
    needed = high - start
    fits = needed <= bins * resolution
    if policy == "raise":
        return start, F.when(fits, F.lit(resolution)).otherwise(F.raise_error(F.lit("the span does not fit the window")).cast("double"))
    if policy == "degrade_resolution":
        return start, F.when(fits, F.lit(resolution)).otherwise(F.ceil(needed / (bins * resolution)) * resolution)
    if policy == "collapse_bins":
        return start, F.lit(resolution)
    raise ValueError(f"unknown policy {policy!r}")


def waveform_digest(samples: DataFrame, keys: list[str], value: str, weight: Column, delta: float = 512) -> DataFrame:
    """Digest of elevations weighted by flux; samples without flux don't count."""
    return build(samples.withColumn("__flux", weight), keys, value, delta, "__flux")
