"""Catalogs of granules and the map from shards to the granules that touch them."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cells import coarsen

CATALOG = "id string, xmin double, ymin double, xmax double, ymax double, start timestamp, end timestamp, assets map<string,string>"


def fetch_items(url: str, body: dict, open_url: Callable = urllib.request.urlopen, tries: int = 3) -> Iterator[dict]:
    """Items of a paged STAC search; a page that fails is asked for again."""
    while url:
        for turn in range(tries):
            try:
                with open_url(urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})) as reply:
                    page = json.load(reply)
                break
            except OSError:
                if turn + 1 == tries:
                    raise
        yield from page.get("features", [])
        link = next((x for x in page.get("links", []) if x.get("rel") == "next"), None)
        url, body = (link["href"], body | link.get("body", {})) if link else (None, body)


def from_items(spark: SparkSession, items: Iterator[dict]) -> DataFrame:
    """A catalog from STAC items (a driver-side list, as a search gives it)."""
    rows = []
    for i in items:
        p = i.get("properties", {})
        box = [float(v) for v in i["bbox"]]
        assets = {k: a["href"] for k, a in i.get("assets", {}).items()}
        rows.append((i["id"], *box, p.get("start_datetime") or p.get("datetime"), p.get("end_datetime") or p.get("datetime"), assets))
    plain = "id string, xmin double, ymin double, xmax double, ymax double, start string, end string, assets map<string,string>"
    return spark.createDataFrame(rows, plain).withColumns({c: F.to_timestamp(c) for c in ("start", "end")})


def shard_map(footprints: DataFrame, shards: DataFrame, levels: int, item: str = "id", cell: str = "cell", shard: str = "shard") -> DataFrame:
    """shard and its granules, in order. footprints: one row for each granule and covering cell; levels: from those cells up to shards."""
    pairs = footprints.select(item, coarsen(cell, levels).alias(shard)).distinct().join(shards.select(shard).distinct(), shard)
    return pairs.groupBy(shard).agg(F.sort_array(F.collect_list(item)).alias("granules"))


def reprojected(mapped: DataFrame, levels: int, shard: str = "shard") -> DataFrame:
    """A shard map so many levels coarser, exactly: the union of the granules of a shard's parts."""
    rows = mapped.select(coarsen(shard, levels).alias(shard), F.explode("granules").alias("g")).distinct()
    return rows.groupBy(shard).agg(F.sort_array(F.collect_list("g")).alias("granules"))


def densest(mapped: DataFrame, shard: str = "shard") -> DataFrame:
    """Shards by number of granules, most first; ties by shard."""
    rank = F.row_number().over(Window.orderBy(F.desc("n"), shard))
    return mapped.select(shard, F.size("granules").alias("n")).withColumn("rank", rank)
