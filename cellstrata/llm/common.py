"""Column helpers and job helpers that the text operators share."""

from __future__ import annotations

import math
import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space as the operators read it: blank, tab, line feed, vertical tab, form feed, return.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def bound(value: Column, use) -> Column:
    """use(value), with value computed once: a lambda over a one-element array holds it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """The words of a text in order; an empty array for null, empty or blank texts."""
    blanked = F.coalesce(text, F.lit(""))
    for char in SPACE_CHARS[1:]:
        blanked = F.replace(blanked, F.lit(char), F.lit(" "))
    return F.array_remove(F.split(blanked, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(df: DataFrame) -> str:
    """The job's folder for checkpoints: that of spark.checkpoint.dir. A temporary one only where none is set and all runs on one machine."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder of spark.checkpoint.dir; keeps how rows are partitioned."""
    _shared_folder(df)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df as a Parquet table beside the checkpoints: smaller than one, and read by column."""
    path = f"{_shared_folder(df)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Bits of the bitmap of flagged() (8 MB).
MARK_BITS = 1 << 26


def _bit_of(columns: list[str]) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(*columns), F.lit(MARK_BITS))
    return F.bitmap_bucket_number(at), F.bitmap_bit_position(at)


def flagged(df: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str]) -> DataFrame:
    """df with __hit: true for all rows whose columns (of the same types) are among keys, and for few others.

    A bitmap of MARK_BITS bits, whatever the tables' sizes, is broadcast, so that
    the other rows needn't be shuffled. The more keys there are, the more rows
    are hit; never too few.
    """
    bucket, bit = _bit_of(key_columns)
    marks = keys.select(bucket.alias("__bucket"), bit.alias("__bit")).groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    bucket, bit = _bit_of(columns)
    known = df.withColumns({"__part": bucket, "__at": bit}).join(F.broadcast(marks), F.col("__part") == F.col("__bucket"), "left")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(F.col("__at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.floor(byte / F.pow(F.lit(2), F.col("__at") % 8)) % 2 == 1, F.lit(False))
    return known.withColumn("__hit", hit).drop("__part", "__at", "__bucket", "__bits")


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of one part of a group in with_offsets, about.
PART_ROWS = 250_000


def parts_for(rows: int) -> int:
    """Parts of each group for with_offsets, so that a group of all rows has parts of PART_ROWS."""
    return max(64, math.ceil(rows / PART_ROWS))


def with_offsets(df: DataFrame, group: str, order: list[Column], weight: Column, out: str, buckets: int) -> DataFrame:
    """Adds `out`: the sum of weight over the rows of the same group that come before.

    Rows are dealt over `buckets` parts of each group by the hash of the order
    columns. Only the parts' sums (at most groups * buckets rows) meet in one
    window a group; no task ever holds a whole group.
    """
    bucket, before = f"__bucket_{out}", f"__before_{out}"
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sums = dealt.groupBy(group, bucket).agg(F.sum(weight).alias("__sum"))
    ahead = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(group).alias("__group"),
        F.col(bucket).alias("__part"),
        F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias(before),
    )
    inner = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("__inner", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    joined = placed.join(starts, (placed[group].eqNullSafe(starts["__group"])) & (placed[bucket] == starts["__part"]))
    return joined.withColumn(out, F.col(before) + F.col("__inner")).drop("__group", "__part", before, "__inner", bucket)
