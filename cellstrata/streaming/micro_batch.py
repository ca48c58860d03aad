"""Streaming aggregation: micro-batches merged into cells under the pyramid's laws."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import aggregate, pyramid, sketch
from ..operators.aggregate import Field


def admissible(fields: list[Field]) -> None:
    """Only fields with an exact law can be merged batch by batch."""
    bad = [f.name for f in fields if pyramid.law_class(f.function) != "exact"]
    if bad:
        raise ValueError(f"no merge law for {', '.join(bad)}")


def merge_batches(stream: DataFrame, fields: list[Field], keys: list[str], path: str, checkpoint: str, digests: dict[str, str] | None = None, delta: float = 512) -> StreamingQuery:
    """Writes each micro-batch's cells to path/batch=<id>; a batch that is run again replaces its own. read_merged() folds them."""
    admissible(fields)

    def put(batch: DataFrame, number: int) -> None:
        part = aggregate.by_cell(batch, fields, keys)
        for name, source in (digests or {}).items():
            part = part.join(sketch.build(batch, keys, source, delta, name=name), keys)
        part.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_merged(spark, path: str, fields: list[Field], keys: list[str], digests: list[str] = (), delta: float = 512) -> DataFrame:
    """The cells of all batches, each merged once from its parts."""
    parts = spark.read.parquet(path)
    laws = {f.name: f.function for f in fields}
    out = pyramid.merged_partials([parts], keys, laws, {f.name: f.fill for f in fields if not f.is_float})
    for name in digests:
        out = out.join(sketch.fold(parts, keys, name, delta), keys)
    return out


def windowed(stream: DataFrame, ts: str, late: str, every: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums in event-time windows; rows later than the watermark go."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, every), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
