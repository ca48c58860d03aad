"""Sweeps over a hierarchy: staged merges from first-generation partials, cascades, declared levels, and what guards them."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.packing import combined_hash, digest_of
from ..functions.times import micros
from . import pyramid, sketch


class DeclarationMismatch(ValueError):
    pass


def declared(fields: dict[str, dict]) -> dict[str, dict]:
    """Declarations by field, with what folds depend on only: function, fill, delta, weights and companions."""
    return {n: {k: f.get(k) for k in ("function", "fill", "delta", "weights", "companions")} for n, f in sorted(fields.items())}


def check_match(parts: list[dict[str, dict]]) -> dict[str, dict]:
    """The declaration that all parts share; partials made under different ones aren't merged."""
    first = declared(parts[0])
    for other in parts[1:]:
        differ = sorted(n for n in first.keys() | declared(other).keys() if first.get(n) != declared(other).get(n))
        if differ:
            raise DeclarationMismatch(f"parts declare {', '.join(differ)} differently")
    return first


def gather(levels: DataFrame, orders: list[int], order: str = "order") -> DataFrame:
    """Rows of given orders out of a table of all levels: copied, not folded."""
    return levels.where(F.col(order).isin(orders))


def stage_merge(partials: list[DataFrame], cell: str, levels: int, laws: dict[str, str], fills: dict | None = None, digests: dict[str, float] | None = None) -> DataFrame:
    """Cells so many levels up from first-generation partials, in one grouping: never folds of folds, so the stages' width doesn't change the result."""
    every = reduce(DataFrame.unionByName, partials)
    out = pyramid.fold(every, cell, levels, laws, fills)
    for name, delta in (digests or {}).items():
        out = out.join(pyramid.digests(every, cell, levels, name, delta), cell, "left")
    return out


def stages(parent_order: int, top: int = 0, width: int = 2) -> list[tuple[str, int, int]]:
    """(kind, from, to): up to the first coarser order parts are gathered, from there merged, `width` orders a stage."""
    out, at = [("gather", parent_order, parent_order)], parent_order
    while at > top:
        out.append(("merge", at, max(top, at - width)))
        at = out[-1][2]
    return out


def cascade(cells: DataFrame, cell: str, order: int, orders: list[int], laws: dict[str, str], fills: dict | None = None, stored=None) -> dict[int, DataFrame]:
    """Levels by order, each folded from the finer one before: for exact laws the same as from the cells. stored(df) cuts in between, if given."""
    bad = [n for n, f in laws.items() if pyramid.law_class(f) != "exact"]
    if bad:
        raise ValueError(f"only exact laws cascade, not {', '.join(bad)}")
    out, at, now = {}, order, cells
    for o in sorted(orders, reverse=True):
        now = pyramid.fold(now, cell, at - o, laws, fills)
        now = stored(now) if stored else now
        out[o], at = now, o
    return out


def all_orders(levels: dict[int, DataFrame], order: str = "order") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn(order, F.lit(o)) for o, df in levels.items()])


def populated(level: DataFrame, cell: str, shard_levels: int, fields: list[str]) -> DataFrame:
    """shard, the number of its cells that hold anything, and a hash of their contents that doesn't depend on row order."""
    any_value = reduce(lambda a, b: a | b, [F.col(f).isNotNull() & ~F.coalesce(F.isnan(F.col(f).cast("double")), F.lit(False)) for f in fields])
    row = F.sha2(F.concat_ws("|", F.col(cell), *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), 256)
    kept = level.where(any_value)
    return kept.groupBy(F.shiftright(cell, shard_levels * 2).alias("shard")).agg(F.count("*").alias("n"), combined_hash(row).alias("content"))


def stale(current: DataFrame, built: DataFrame, key: str = "shard", stamp: str = "content") -> DataFrame:
    """Keys whose content isn't that from which their level was built, or that were never built: what a sweep has to do."""
    was = built.select(F.col(key).alias("__key"), F.col(stamp).alias("__was"))
    return current.join(was, current[key] == F.col("__key"), "left").where(~F.col(stamp).eqNullSafe(F.col("__was"))).select(key)


def retrofit(manifest: dict, levels: list[int], fields: dict[str, dict]) -> dict:
    """The manifest with levels declared after the fact; refused if it has other levels or fields already."""
    own = {"levels": sorted(levels, reverse=True), "fields": declared(fields)}
    known = manifest.get("pyramid")
    if known is not None and digest_of(known) != digest_of(own):
        raise DeclarationMismatch("the store declares another pyramid")
    return manifest | {"pyramid": own}


class Lease:
    """Admission of one sweep at a time: a file in the store, made only if it isn't there; one that has run out is taken over."""

    def __init__(self, spark: SparkSession, path: str, seconds: float, owner: str):
        self.jvm, self.seconds, self.owner = spark.sparkContext._jvm, seconds, owner
        self.at = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def __enter__(self) -> Lease:
        if self.fs.exists(self.at) and time.time() - self.fs.getFileStatus(self.at).getModificationTime() / 1000 > self.seconds:
            self.fs.delete(self.at, False)
        try:
            out = self.fs.create(self.at, False)
        except Exception as error:
            raise RuntimeError("another sweep holds the lease") from error
        out.write(bytearray(self.owner.encode()))
        out.close()
        return self

    def __exit__(self, *_) -> None:
        self.fs.delete(self.at, False)


def temporal_section(rows: DataFrame, shard: str, when: str, delta: float = 512) -> tuple[DataFrame, DataFrame]:
    """Envelope of times by shard, and the digest of all times (in seconds) built by shard and merged once at the root."""
    envelopes = rows.groupBy(shard).agg(F.min(when).alias("start"), F.max(when).alias("end"), F.count(when).alias("n"))
    by_shard = sketch.build(rows.withColumn("__s", micros(when) / 1e6), [shard], "__s", delta)
    root = sketch.fold(by_shard.withColumn("__root", F.lit(0)), ["__root"], delta=delta).drop("__root")
    return envelopes, root


def ancestors(cell: str, order: int) -> Column:
    """All ancestors of a cell and itself, finest first, as structs (order, cell)."""
    return F.array(*[F.struct(F.lit(o).alias("order"), F.shiftright(cell, 2 * (order - o)).alias("cell")) for o in range(order, -1, -1)])
