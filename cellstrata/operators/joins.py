"""Joins between records, siblings, samples and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """df; a key that repeats fails the job in which it is read, so no extra pass is made."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("__n", n).withColumn("__n", F.when(F.col("__n") > 1, F.raise_error(F.lit(f"{what} repeats a key"))).otherwise(F.col("__n"))).where("__n = 1").drop("__n")


def sibling(df: DataFrame, right: DataFrame, left_key: str, right_key: str, variables: dict[str, str]) -> DataFrame:
    """df with variables (name: column of right); `matched` tells whether the unique right key was found, floats are NaN where not."""
    kinds = dict(right.dtypes)
    slim = _unique(right.select(F.col(right_key).alias("__key"), *[F.col(c).alias(n) for n, c in variables.items()]), ["__key"], "the sibling")
    joined = df.join(slim.withColumn("__hit", F.lit(True)), df[left_key] == F.col("__key"), "left")
    filled = {n: F.when(F.col("__hit"), F.col(n)).otherwise(F.lit(float("nan"))) for n, c in variables.items() if kinds[c] in ("double", "float")}
    return joined.withColumns(filled | {"matched": F.col("__hit").isNotNull()}).drop("__key", "__hit")


def sibling_filter(df: DataFrame, right: DataFrame, left_key: str, right_key: str, keep: Column) -> DataFrame:
    """Rows whose sibling passes; rows without one go."""
    passed = right.where(keep).select(F.col(right_key).alias("__key"))
    return df.join(passed, df[left_key] == passed["__key"], "left_semi")


def pair_assets(a: DataFrame, b: DataFrame, pattern: str, groups: int, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Pairs of files by the parts that a pattern takes of their names, the first of each key; and the names on either side without a partner."""
    key = F.concat_ws("|", *[F.regexp_extract(name, pattern, g) for g in range(1, groups + 1)])

    def firsts(df: DataFrame, out: str) -> DataFrame:
        return df.where(F.col(name).rlike(pattern)).groupBy(key.alias("key")).agg(F.min(name).alias(out))

    left, right = firsts(a, "left_name"), firsts(b, "right_name")
    alone = left.join(right, "key", "left_anti").select("key", F.col("left_name").alias("name"))
    alone = alone.unionByName(right.join(left, "key", "left_anti").select("key", F.col("right_name").alias("name")))
    return left.join(right, "key"), alone


def explode_samples(records: DataFrame, samples: str, value: str = "sample", index: str = "index_in_record", keep_empty: bool = False) -> DataFrame:
    """One row for each sample of each record, the record's columns repeated. Records without samples give none, or one with index -1."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    out = records.select("*", explode(samples).alias("__pos", value)).drop(samples)
    return out.withColumn(index, F.coalesce(F.col("__pos"), F.lit(-1))).drop("__pos")


def linspace(start: str, stop: str, index: str, count: str) -> Column:
    """Coordinate of a sample between a record's ends; a single sample is at the start."""
    return F.col(start) + (F.col(stop) - F.col(start)) * F.col(index) / F.greatest(F.col(count) - 1, F.lit(1))


def records_to_samples(records: DataFrame, samples: DataFrame, begin: str, count: str, position: str, base: int = 0) -> DataFrame:
    """samples with the columns of the record whose interval [begin - base, begin - base + count) holds their position.

    The interval is expanded to its positions, so this is an equality join; gaps
    keep their samples with null record columns.
    """
    full = records.where(F.col(count) > 0)
    first = F.col(begin) - base
    each = full.withColumn("__at", F.explode(F.sequence(first.cast("long"), (first + F.col(count) - 1).cast("long"))))
    return samples.join(each, samples[position] == each["__at"], "left").drop("__at")


def interval_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, width: int) -> DataFrame:
    """Points within half-open intervals of longs. Both are dealt over buckets of `width`, so the join has a key and no nested loop."""
    cut = intervals.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width))))
    keyed = points.withColumn("__bucket", F.floor(F.col(at) / width))
    return keyed.join(cut, "__bucket").where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("__bucket")


def monthly_anomaly(df: DataFrame, climatology: DataFrame, value: str, ts: str, keys: list[str], mean: str = "mean") -> DataFrame:
    """value less its month's mean at exactly the same place; unmatched places become NaN."""
    slim = climatology.select(F.col("month").alias("__month"), *keys, F.col(mean).alias("__mean"))
    joined = df.withColumn("__month", F.month(ts)).join(slim, ["__month", *keys], "left")
    return joined.withColumn(value, F.coalesce(F.col(value) - F.col("__mean"), F.lit(float("nan")))).drop("__month", "__mean")


def aligned(cells: DataFrame, *others: DataFrame, keys: list[str], ts: str | None = None) -> DataFrame:
    """cells with the columns of gridded tables at exactly the same coordinates; a table with the column ts is met at the same time too. Places that a table lacks go."""
    out = cells
    for other in others:
        out = out.join(other, [*keys, ts] if ts and ts in other.columns else keys)
    return out


def disjoint(records: DataFrame, keys: list[str], begin: str, count: str) -> DataFrame:
    """records; two whose sample intervals overlap fail the job."""
    w = Window.partitionBy(*keys).orderBy(begin, count)
    reach = F.max(F.col(begin) + F.col(count)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    bad = (F.col(count) > 0) & (F.col(begin) < reach)
    return records.withColumn("__ok", F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit("records share samples"))).otherwise(F.lit(1))).where("__ok = 1").drop("__ok")
