"""Aggregation of observations to cells: declared fields, chunk scalars, vectors, densifying."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import NAN, REDUCTIONS, aggregate, is_nan, per_row

KINDS = {"float32": "float", "float64": "double", "int32": "int", "int64": "long", "uint8": "short", "uint16": "int", "uint32": "long", "uint64": "long", "bool": "boolean"}


@dataclass(frozen=True)
class Field:
    """One output field: a function of a source column, or an expression. params: constants, columns or row expressions by name."""

    name: str
    function: str | None = None
    source: str | None = None
    expression: str | None = None
    params: dict = field(default_factory=dict)
    dtype: str = "float32"
    fill: object = NAN
    kind: str = "scalar"
    shape: int | None = None

    def __post_init__(self):
        if (self.function is None) == (self.expression is None):
            raise ValueError(f"{self.name}: one of function and expression")
        if self.dtype not in KINDS:
            raise ValueError(f"{self.name}: dtype {self.dtype}")
        if self.function and self.function.removeprefix("np.") not in REDUCTIONS:
            raise ValueError(f"{self.name}: function {self.function}")

    @property
    def is_float(self) -> bool:
        return self.dtype.startswith("float")

    def column(self, columns: list[str], chunk: dict[str, Column] | None = None) -> Column:
        """The aggregate, reduced in double and cast last; an integer field refuses a fraction."""
        if self.expression:
            value = aggregate(self.expression, columns, chunk)
        else:
            name = self.function.removeprefix("np.")
            args = [] if name in ("len", "count") else [F.col(self.source)]
            for p in self.params.values():
                args.append(p if not isinstance(p, str) else F.col(p) if p in columns else per_row(p, columns))
            value = REDUCTIONS[name](*args)
        return coerced(value, self).alias(self.name)


def coerced(value: Column, f: Field) -> Column:
    if f.is_float:
        return value.cast(KINDS[f.dtype])
    wide = value.cast("double")
    return F.when(wide != F.floor(wide), F.raise_error(F.lit(f"{f.name} is not integral")).cast(KINDS[f.dtype])).otherwise(value.cast(KINDS[f.dtype]))


#: Functions that a share of the sorted values gives, with the share of those that take no parameter.
QUANTILES = {"median": 0.5, "quantile": None}


def _share(f: Field) -> float | None:
    """The share that a quantile field asks for, if it is a constant."""
    name = (f.function or "").removeprefix("np.")
    if name not in QUANTILES:
        return None
    given = [p for p in f.params.values() if not isinstance(p, str)]
    return QUANTILES[name] if QUANTILES[name] is not None else given[0] if len(given) == 1 else None


def by_cell(df: DataFrame, fields: list[Field], keys: list[str]) -> DataFrame:
    """One row for each cell (and window) that has rows. Partial sums merge before the shuffle wherever the function allows.

    Quantiles of one source share one sorted state, and are taken from it together.
    """
    shares: dict[str, list[float]] = {}
    for f in fields:
        if (q := _share(f)) is not None and q not in shares.setdefault(f.source, []):
            shares[f.source].append(q)
    shared = {s: qs for s, qs in shares.items() if len(qs) > 1}
    aggs = [F.percentile(F.col(s).cast("double"), F.array(*[F.lit(q) for q in qs])).alias(f"__q_{k}") for k, (s, qs) in enumerate(shared.items())]
    aggs += [F.max(is_nan(F.col(s))).alias(f"__nan_{k}") for k, s in enumerate(shared)]
    places = {s: k for k, s in enumerate(shared)}
    own = [f for f in fields if not (_share(f) is not None and f.source in shared)]
    found = df.groupBy(*keys).agg(*aggs, *[f.column(df.columns) for f in own]) if aggs or own else df.groupBy(*keys).agg()

    def taken(f: Field) -> Column:
        if f in own:
            return F.col(f.name)
        k = places[f.source]
        value = F.get(F.col(f"__q_{k}"), F.lit(shared[f.source].index(_share(f))))
        return coerced(F.coalesce(F.when(F.col(f"__nan_{k}"), F.lit(NAN)).otherwise(value), F.lit(NAN)), f).alias(f.name)

    return found.select(*keys, *[taken(f) for f in fields]) if shared else found


def with_chunk_scalars(df: DataFrame, chunk: str, scalars: dict[str, str]) -> DataFrame:
    """df with scalars aggregated over each chunk, joined on the chunk (an aggregate of partial sums, no window over all of a chunk's rows)."""
    found = df.groupBy(chunk).agg(*[aggregate(e, df.columns).alias(n) for n, e in scalars.items()])
    return df.join(found, chunk)


def by_cell_in_chunks(df: DataFrame, fields: list[Field], cell: str, chunk: str, scalars: dict[str, str]) -> DataFrame:
    """by_cell, with chunk scalars as further names in the fields' expressions."""
    joined = with_chunk_scalars(df, chunk, scalars)
    known = {n: F.first(n) for n in scalars}
    return joined.groupBy(cell, chunk).agg(*[f.column(df.columns, known) for f in fields])


def histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, bins: int, name: str = "histogram") -> DataFrame:
    """Counts in equal bins of [low, high], the last closed, as an array; values outside and NaN don't count."""
    x = F.col(value).cast("double")
    at = F.when((x >= low) & (x <= high), F.least(F.floor((x - low) * bins / (high - low)), F.lit(bins - 1)))
    counts = df.select(*keys, at.cast("int").alias("__bin")).groupBy(*keys, "__bin").agg(F.count("*").alias("__n"))
    pairs = F.map_from_entries(F.filter(F.collect_list(F.struct("__bin", "__n")), lambda p: p["__bin"].isNotNull()))
    full = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.try_element_at(pairs, b), F.lit(0)))
    return counts.groupBy(*keys).agg(full.alias(name))


def densify(cells: DataFrame, shards: DataFrame, cell: str, shard: str, levels: int, fields: list[Field]) -> DataFrame:
    """Every child of every shard, with fills where there are no rows: counts 0, floats NaN, integers their fill, vectors full of it."""
    every = shards.select(shard).withColumn(cell, F.explode(F.sequence(F.shiftleft(shard, 2 * levels), F.shiftleft(F.col(shard) + 1, 2 * levels) - 1)))
    joined = every.join(cells.drop(shard), cell, "left")

    def filled(f: Field) -> Column:
        if f.kind == "vector":
            return F.coalesce(F.col(f.name), F.array_repeat(F.lit(f.fill), f.shape).cast(f"array<{KINDS[f.dtype]}>"))
        if f.function in ("len", "count"):
            return F.coalesce(F.col(f.name), F.lit(0).cast(KINDS[f.dtype]))
        return F.coalesce(F.col(f.name), F.lit(NAN if f.is_float else f.fill).cast(KINDS[f.dtype]))

    return joined.select(shard, cell, *[filled(f).alias(f.name) for f in fields])


def chunk_uniform(df: DataFrame, chunk: str, value: str) -> DataFrame:
    """chunk and its one value; a chunk with two values other than NaN fails, one with none stays NaN."""
    x = F.when(~is_nan(F.col(value)), F.col(value))
    low, high = F.min(x), F.max(x)
    one = F.when(low != high, F.raise_error(F.lit(f"{value} differs within a chunk")).cast("double")).otherwise(F.coalesce(low.cast("double"), F.lit(NAN)))
    return df.groupBy(chunk).agg(one.alias(value))


def occupied(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def ragged(df: DataFrame, keys: list[str], columns: list[str], name: str = "rows", where: Column | None = None) -> DataFrame:
    """All rows of each cell as one sorted array: of values for one column, of structs for several."""
    row = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(where, row) if where is not None else row)).alias(name))


def envelope(df: DataFrame, keys: list[str], start: str, end: str | None = None) -> DataFrame:
    """First and last instant of each cell's rows (or of each shard's, by its key); a cell without any instant fails."""
    low, high = F.min(start), F.max(end or start)
    return df.groupBy(*keys).agg(F.when(low.isNull(), F.raise_error(F.lit("no instant in a cell"))).otherwise(low).alias("start"), high.alias("end"))


def shaped(df: DataFrame, column: str, length: int, inner: int | None = None) -> DataFrame:
    """df; a vector that hasn't `length` values, or whose inner arrays haven't `inner`, fails the job."""
    good = F.size(column) == length
    if inner is not None:
        good = good & F.forall(column, lambda x: F.size(x) == inner)
    return df.withColumn(column, F.when(F.col(column).isNull() | good, F.col(column)).otherwise(F.raise_error(F.lit(f"{column} has another shape")).cast(dict(df.dtypes)[column])))


def selected(shards: DataFrame, most: int | None = None, only: int | None = None, shard: str = "shard", by: str = "n") -> DataFrame:
    """The shards to work on: one that is named, or the `most` with the largest `by`; ties go to the lesser number."""
    if only is not None:
        return shards.where(F.col(shard) == only)
    return shards.orderBy(F.desc(by), shard).limit(most) if most is not None else shards
