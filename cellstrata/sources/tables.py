"""Tables, stamps and manifests in a store that Spark reads: local, HDFS or object storage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.packing import canonical

FROZEN = ("semantic_hash", "grid", "schema")


class ManifestMismatch(ValueError):
    pass


def scan(spark: SparkSession, path: str, variables: dict[str, str] | None = None, cell: str | None = None, span: tuple[int, int] | None = None) -> DataFrame:
    """Declared variables (name: column) of a Parquet table, within a range of cells that file statistics can prune."""
    df = spark.read.parquet(path)
    if span is not None:
        df = df.where(F.col(cell).between(span[0], span[1] - 1))
    return df.select(*[F.col(c).alias(n) for n, c in variables.items()]) if variables else df


def union_groups(spark: SparkSession, paths: list[str], name: str = "grp") -> DataFrame:
    """Rows of several groups (beams, tracks) with the group they are from."""
    out = None
    for p in paths:
        one = spark.read.parquet(p).withColumn(name, F.lit(p.rstrip("/").rsplit("/", 1)[-1]))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def write_shards(df: DataFrame, path: str, keys: list[str], cell: str) -> None:
    """One file for each shard (and window), sorted by cell; only the partitions that df has are replaced."""
    shuffled = df.repartition(*keys).sortWithinPartitions(*keys, cell)
    shuffled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def stamp(df: DataFrame, path: str, keys: list[str], run: str) -> None:
    """Stamps of written shards: a second job, so that a shard without a stamp is debris."""
    df.select(*keys).distinct().withColumn("run", F.lit(run)).coalesce(1).write.mode("append").parquet(path)


def read_stamped(spark: SparkSession, path: str, stamps: str, keys: list[str]) -> DataFrame:
    """Rows of shards that have a stamp."""
    return spark.read.parquet(path).join(spark.read.parquet(stamps).select(*keys).distinct(), keys, "left_semi")


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """A table of one row an event; missing numbers are NaN in Parquet and CSV alike."""
    filled = df.fillna(float("nan"), [n for n, k in df.dtypes if k in ("double", "float")])
    writer = filled.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def _text(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def ensure_manifest(spark: SparkSession, path: str, manifest: dict) -> dict:
    """Writes a manifest once; later ones must agree in what is frozen."""
    known = _text(spark, path)
    if known is not None:
        old = json.loads(known)
        differ = [k for k in FROZEN if old.get(k) != manifest.get(k)]
        if differ:
            raise ManifestMismatch(f"the store has other {', '.join(differ)}")
        return old
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, False)
    out.write(bytearray(canonical(manifest).encode()))
    out.close()
    return manifest
