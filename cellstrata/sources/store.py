"""A product in a store: leaves written behind a gate, their coverage and hashes, maps and catalogs as files, templates and run statistics."""

from __future__ import annotations

from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.packing import combined_hash, digest_of
from ..operators import coverage, identity
from .tables import ManifestMismatch, ensure_manifest, write_shards

SHARD_MAP = "shard long, granules array<string>"


def template(spark: SparkSession, path: str, fields, keys: list[str]) -> None:
    """An empty table with the product's schema, so that readers know it before any leaf is there."""
    from ..operators.aggregate import KINDS

    schema = T.StructType([T.StructField(k, T.LongType()) for k in keys] + [T.StructField(f.name, T._parse_datatype_string(KINDS[f.dtype])) for f in fields])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _known(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def write_leaves(cells: DataFrame, planned: DataFrame, root: str, cell: str, levels: int, manifest: dict, run: str, allow_contraction: bool = False) -> DataFrame:
    """Writes the shards whose inputs have changed; gives shard and the run that wrote it last.

    planned: shard and granule. In this order: the manifest must agree; the gate
    compares planned with recorded inputs; data, replacing whole shards; coverage
    and content hashes; the inputs last, as the stamp without which a shard
    doesn't count. A refused shard fails the run before anything is written.
    """
    spark = cells.sparkSession
    ensure_manifest(spark, f"{root}/manifest.json", manifest)
    recorded = _known(spark, f"{root}/inputs", "shard long, granule string, run string, at timestamp")
    newest = recorded.groupBy("shard").agg(F.max_by("run", "at").alias("__run"))
    live = recorded.join(newest.withColumnRenamed("shard", "__shard"), (F.col("shard") == F.col("__shard")) & (F.col("run") == F.col("__run"))).select("shard", "granule")
    judged = identity.verdicts(planned, live, allow_contraction=allow_contraction).select("shard", "verdict").persist()
    try:
        refused = judged.where("verdict = 'refuse'").limit(5).collect()
        if refused:
            raise ManifestMismatch(f"recorded inputs are missing from the plan of shards such as {refused[0]['shard']}")
        todo = judged.where("verdict <> 'skip'").select("shard")
        out = cells.join(todo, "shard", "left_semi")
        if out.limit(1).count():
            write_shards(out, f"{root}/data", ["shard"], cell)
        leaves = coverage.bitmap(out, "shard", cell, levels).join(content_hashes(out, "shard", cell), "shard").withColumn("run", F.lit(run))
        leaves.write.mode("append").parquet(f"{root}/coverage")
        stamps = planned.join(todo, "shard", "left_semi").select("shard", F.col("granule").cast("string").alias("granule"), F.lit(run).alias("run"), F.current_timestamp().alias("at"))
        stamps.write.mode("append").parquet(f"{root}/inputs")
    finally:
        judged.unpersist()
    return _known(spark, f"{root}/inputs", "shard long, granule string, run string, at timestamp").groupBy("shard").agg(F.max_by("run", "at").alias("run"))


def content_hashes(cells: DataFrame, shard: str, cell: str) -> DataFrame:
    """A hash of each shard's rows, whatever their order."""
    values = [F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in cells.columns if c not in (shard, cell)]
    row = F.sha2(F.concat_ws("|", F.col(cell).cast("string"), *values), 256)
    return cells.groupBy(shard).agg(combined_hash(row).alias("content"))


def read_leaves(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the shards that have a stamp; a shard that its newest run left without cells has none, whatever an older run wrote."""
    newest = _known(spark, f"{root}/inputs", "shard long, granule string, run string, at timestamp").groupBy("shard").agg(F.max_by("run", "at").alias("run"))
    filled = _known(spark, f"{root}/coverage", "shard long, run string")
    done = newest.join(filled, ["shard", "run"], "left_semi").select("shard")
    return spark.read.parquet(f"{root}/data").withColumn("shard", F.col("shard").cast("long")).join(done, "shard", "left_semi")


def root_coverage(leaves: DataFrame, levels: int, order: int) -> DataFrame:
    """Ranges of the shards that have any cell, as one set; the union with an older one is coverage.union."""
    return coverage.union(coverage.ranges(leaves.where("n > 0"), "shard", order - levels))


def stale_coverage(leaves: DataFrame, present: DataFrame, shard: str = "shard") -> DataFrame:
    """Shards that are there without coverage, or the other way round."""
    a, b = leaves.select(shard).distinct(), present.select(shard).distinct()
    return a.join(b, shard, "left_anti").withColumn("lacks", F.lit("data")).unionByName(b.join(a, shard, "left_anti").withColumn("lacks", F.lit("coverage")))


def bitmap_and(a: DataFrame, b: DataFrame, shard: str = "shard") -> DataFrame:
    """Bitmaps of the shards that both have, where both have a cell."""
    both = a.select(shard, F.col("bitmap").alias("__a")).join(b.select(shard, F.col("bitmap").alias("__b")), shard)
    bits = F.zip_with(F.split("__a", ""), F.split("__b", ""), lambda x, y: F.when((x == "1") & (y == "1"), "1").otherwise("0"))
    return both.select(shard, F.array_join(bits, "").alias("bitmap"))


def write_map(mapped: DataFrame, path: str, form: str = "parquet") -> None:
    """A shard map as typed Parquet or as JSON lines."""
    mapped.select(F.col("shard").cast("long"), F.col("granules").cast("array<string>")).write.mode("overwrite").format(form).save(path)


def read_map(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return spark.read.schema(SHARD_MAP).format(form).load(path)


def write_levels(levels: dict[int, DataFrame], path: str, cell: str) -> None:
    """Levels of a pyramid as one table, partitioned by order; only the given orders are replaced."""
    for order, df in levels.items():
        rows = df.withColumn("order", F.lit(order)).sortWithinPartitions(cell)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("order").parquet(path)


def append_stats(records: DataFrame, path: str, run: str) -> None:
    """Run statistics, one row a shard, under their run; a run that is written again replaces its own."""
    records.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def product_name(kind: str, grid_signature: dict, semantic_hash: str) -> str:
    """Name of a product's root: what it is, its grid, and what it was made by."""
    return f"{kind}-{grid_signature['type']}-{digest_of(grid_signature)[:8]}-{semantic_hash[:12]}"


def _readable(spark: SparkSession, path: str, schema: str) -> bool:
    try:
        spark.read.schema(schema).option("ignoreCorruptFiles", False).parquet(path).limit(1).collect()
    except (PySparkException, Py4JJavaError):
        return False
    return True


def union_granules(spark: SparkSession, paths: list[str], schema: str) -> tuple[DataFrame, list[str]]:
    """Rows of all granules that can be read, in one scan, and the paths that are missing or corrupt; an error if none can be read.

    A first scan, of footers only, tells which files have rows; only paths without any are tried one by one.
    """
    there = [p for p in dict.fromkeys(paths) if _exists(spark, p)]
    if not there:
        raise FileNotFoundError("no granule can be read")
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*there)
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    full = set()
    for (uri,) in rows.select("_metadata.file_path").distinct().collect():
        at = PurePosixPath(unquote(urlparse(uri).path))
        full |= {str(at), *map(str, at.parents)}
    bad = {p for p in there if own(p).toUri().getPath().rstrip("/") not in full and not _readable(spark, p, schema)}
    if len(bad) == len(there):
        raise FileNotFoundError("no granule can be read")
    good = set(there) - bad
    return rows, [p for p in paths if p not in good]
