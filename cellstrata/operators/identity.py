"""Identity of results: what to skip, rewrite or refuse, stamps, and the merge of run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.packing import ids_hash


def verdicts(planned: DataFrame, recorded: DataFrame, shard: str = "shard", item: str = "granule", allow_contraction: bool = False) -> DataFrame:
    """shard, missing, added and verdict for every planned shard.

    skip: recorded and planned inputs are the same; refuse: recorded inputs are
    missing from the plan; rewrite: anything else. Unrecorded shards are written.
    """
    plan = planned.select(shard, item).distinct().withColumn("__p", F.lit(1))
    past = recorded.select(shard, item).distinct().withColumn("__r", F.lit(1))
    both = plan.join(past, [shard, item], "full").groupBy(shard).agg(
        F.sum(F.when(F.col("__p").isNull(), 1).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("__r").isNull(), 1).otherwise(0)).alias("added"),
        F.count("__p").alias("__planned"), F.count("__r").alias("__recorded"),
    )
    verdict = F.when(F.col("__recorded") == 0, "write").when((F.col("missing") == 0) & (F.col("added") == 0), "skip")
    verdict = verdict.when((F.col("missing") > 0) & F.lit(not allow_contraction), "refuse").otherwise("rewrite")
    return both.where("__planned > 0").select(shard, "missing", "added", verdict.alias("verdict"))


def foreign(present: DataFrame, planned: DataFrame, key: str) -> DataFrame:
    """Keys that are there but not planned."""
    return present.select(key).distinct().join(planned.select(key).distinct(), key, "left_anti")


def input_hashes(planned: DataFrame, shard: str = "shard", item: str = "granule") -> DataFrame:
    return planned.groupBy(shard).agg(ids_hash(F.col(item)).alias("inputs"))


def merged_stats(records: DataFrame, keys: list[str], counters=(), optional=(), peaks=(), identity=(), latest: str | None = None, success: str | None = None) -> DataFrame:
    """Run statistics as one row for each key: counters sum (missing is 0), optional ones sum if any is there, peaks take the largest, identity values stay if all agree and none is missing, the latest time, success if all succeeded."""

    def agreed(c: str) -> Column:
        same = (F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1)))
        return F.when(same, F.min(c)).alias(c)

    aggs = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in counters]
    aggs += [F.sum(c).alias(c) for c in optional]
    aggs += [F.max(c).alias(c) for c in peaks] + [agreed(c) for c in identity]
    aggs += [F.max(latest).alias(latest)] if latest else []
    aggs += [F.bool_and(F.coalesce(F.col(success), F.lit(False))).alias(success)] if success else []
    return records.groupBy(*keys).agg(*aggs)
