"""Registered queries of scans, joins, sweeps and the store, and their SQL; see queries."""

from __future__ import annotations

import tempfile
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import cells, times
from .operators import aggregate, coverage, footprints, joins, pyramid, readplan, sketch, sweep
from .plans import registry
from .queries import _PYR, _PYR_FIELDS, CELLS, FOUR, GRID, celled, nested, query, rounded, table
from .sources import catalog, store


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors see: under spark.checkpoint.dir, or a temporary one where all runs on one machine."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return f"{shared or tempfile.mkdtemp(prefix='store-')}/store-{uuid4().hex}"


def _records(spark, sf_dir) -> DataFrame:
    """Orders of a customer as records in a row, each with its samples' place; every seventh has none."""
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, 0).otherwise(F.col("o_orderkey") % 3 + 1).cast("long").alias("cnt"))
    w = readplan.Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return df.withColumn("begin", F.sum("cnt").over(w.rowsBetween(readplan.Window.unboundedPreceding, 0)) - F.col("cnt")).withColumn("want", F.col("o_totalprice") > 200000)


def _samples(records: DataFrame) -> DataFrame:
    full = records.where("cnt > 0")
    return full.select("o_custkey", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("cnt") - 1)).alias("pos"), "o_totalprice")


_REC = """rec AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 3 + 1 END AS cnt, o_totalprice > 200000 AS want FROM orders),
  near AS (SELECT *, max(want) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS keep FROM rec),
  tot AS (SELECT o_custkey, sum(cnt) AS total, coalesce(sum(cnt) FILTER (keep), 0) AS kept FROM near GROUP BY ALL)"""


@query("src_02_planned_read", f"""WITH {_REC} SELECT o_custkey, CAST(sum(cnt) AS BIGINT) AS n, round(sum(cnt * o_totalprice) + 0.003, 1) AS total FROM near JOIN tot USING (o_custkey)
  WHERE cnt > 0 AND (CASE WHEN kept > 0.9 * total THEN TRUE ELSE keep END) AND kept > 0 GROUP BY ALL""")  # fmt: skip
def src_02_planned_read(spark, sf_dir):
    """Records that are wanted, padded by one, bound slices; only samples in these are read."""
    records = _records(spark, sf_dir)
    slices = readplan.slices(records, ["o_custkey"], "o_orderkey", "want", "begin", "cnt", pad=1)
    found = readplan.planned(_samples(records), slices, ["o_custkey"], "pos")
    return found.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice") + 0.003, 1).alias("total"))


@query("src_07_vlen", """SELECT l_orderkey AS k, count(*) AS n, round(sum(o_totalprice + l_linenumber), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY ALL""")
def src_07_vlen(spark, sf_dir):
    """Samples of records whose sibling passes, with the sibling's columns."""
    records = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list("l_linenumber")).alias("samples"))
    records = records.withColumns({"n": F.size("samples"), "lo": F.lit(0.0), "hi": F.size("samples").cast("double")})
    found = readplan.vlen(records, "samples", {"at": ("lo", "hi", "n")}, (table(spark, sf_dir, "orders"), "k", "o_orderkey", {"price": "o_totalprice"}, F.col("o_orderstatus") != "P"))
    return found.groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum(F.col("price") + F.col("sample")), 2).alias("total"))


@query("src_08_apriori", """WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, event_id % 180 - 90 AS lat, event_id % 360 - 180 AS lon FROM events),
  c AS (SELECT user_id, i // 4 AS chunk, min(i) AS s, max(i) + 1 AS e, arg_min(lat, i) AS la, arg_max(lat, i) AS lb, arg_min(lon, i) AS oa, arg_max(lon, i) AS ob FROM p GROUP BY ALL),
  h AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY user_id ORDER BY s) <> s, TRUE) AS new FROM c WHERE least(la, lb) <= 40 AND greatest(la, lb) >= -10 AND least(oa, ob) <= 90 AND greatest(oa, ob) >= -20),
  r AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY s) AS run FROM h) SELECT user_id, min(s) AS start, max(e) AS stop FROM r GROUP BY user_id, run""")  # fmt: skip
def src_08_apriori(spark, sf_dir):
    w = readplan.Window.partitionBy("user_id").orderBy("event_id")
    points = table(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).cast("long").alias("i"), (F.col("event_id") % 180 - 90).alias("lat"), (F.col("event_id") % 360 - 180).alias("lon"))
    bounds = readplan.chunk_boundaries(points, ["user_id"], "i", "lat", "lon", 4)
    return readplan.apriori(bounds, ["user_id"], (-20, -10, 90, 40), "lat", "lon")


@query("src_10_chunk_map", """WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)
  SELECT user_id, i // 8 AS chunk_idx, min(i) AS elem_start, max(i) + 1 AS elem_end, min(i) * 4 AS byte_offset, count(*) * 4 AS nbytes FROM p GROUP BY ALL""")  # fmt: skip
def src_10_chunk_map(spark, sf_dir):
    w = readplan.Window.partitionBy("user_id").orderBy("event_id")
    points = table(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).cast("long").alias("i"))
    return readplan.chunk_map(points, ["user_id"], "i", 8, 4)


@query("prj_12_envelopes", "SELECT o_custkey AS k, epoch_us(min(o_orderdate)) * 1000 AS start, epoch_us(max(o_orderdate)) * 1000 AS \"end\", min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY ALL")
def prj_12_envelopes(spark, sf_dir):
    found = aggregate.envelope(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k"), ["k"], "o_orderdate").select("k", times.envelope_words("start", "end").alias("w"))
    first, last = times.from_words("w")
    return found.select("k", "w.start", "w.end", first.cast("timestamp_ntz").alias("first"), last.cast("timestamp_ntz").alias("last"))


@query("flt_23_bounds", "SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1994-03-01' AND o_orderdate < TIMESTAMP '1996-07-15 12:00:00'")
def flt_23_bounds(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(times.within("o_orderdate", "1994-03-01", "1996-07-15T12:00:00Z")).agg(F.count("*").alias("n"))


@query("flt_17_fine_aoi", f"WITH {CELLS}{FOUR} SELECT (h % 5 = 1 AND l_orderkey % 65536 < 40000) AS in_aoi, count(*) AS n FROM marked GROUP BY ALL")
def flt_17_fine_aoi(spark, sf_dir):
    """Cells of order 12 against ranges that begin and end inside coarser cells."""
    fine = nested(spark, sf_dir).withColumn("fine", F.shiftleft(F.col("h"), 16) + F.col("l_orderkey") % 65536)
    up = 1 << (2 * (cells.MAX_ORDER - 12))
    aoi = spark.range(1, 4096, 5).select((F.col("id") * 65536 * up).alias("lo"), ((F.col("id") * 65536 + 40000) * up).alias("hi"))
    return coverage.masked(fine, "fine", 12, aoi).groupBy("in_aoi").agg(F.count("*").alias("n"))


@query("jon_06_indexed_pairs", """WITH f AS (SELECT o_orderkey AS id, unnest([o_custkey * 7 % 4096, o_orderkey * 13 % 4096]) >> 4 AS shard FROM orders)
  SELECT shard, count(DISTINCT id) AS n, min(id) AS first, max(id) AS last FROM f WHERE shard % 3 = 0 GROUP BY shard""")  # fmt: skip
def jon_06_indexed_pairs(spark, sf_dir):
    index = F.array((F.col("o_custkey") * 7) % 4096, (F.col("o_orderkey") * 13) % 4096)
    granules = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), index.alias("cells"))
    shards = spark.range(256).where("id % 3 = 0").select(F.col("id").alias("shard"))
    pairs = footprints.indexed_pairs(granules, shards, 2)
    return pairs.groupBy("shard").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


_TRI = "x0 + 20 AS x1, y0 + 5 AS y1, x0 + 7 AS x2, y0 + 25 AS y2"


def _edge(a: int, b: int) -> str:
    return f"(CASE WHEN cy >= least(y{a}, y{b}) AND cy < greatest(y{a}, y{b}) AND cx < x{a} + (cy - y{a}) * (x{b} - x{a}) / nullif(y{b} - y{a}, 0) THEN 1 ELSE 0 END)"


@query("jon_07_polygons", f"""WITH t AS (SELECT c_custkey AS id, CAST(c_custkey * 37 % 330 - 180 AS DOUBLE) AS x0, CAST(c_custkey * 53 % 150 - 90 AS DOUBLE) AS y0 FROM customer), p AS (SELECT *, {_TRI} FROM t),
  s AS (SELECT i AS shard, -180 + (i % 72 + 0.5) * 5 AS cx, 90 - (i // 72 + 0.5) * 5 AS cy FROM range(2592) r(i))
  SELECT shard, count(*) AS n, min(id) AS first FROM p, s WHERE ({_edge(0, 1)} + {_edge(1, 2)} + {_edge(2, 0)}) % 2 = 1 GROUP BY shard""")  # fmt: skip
def jon_07_polygons(spark, sf_dir):
    """Shards whose centre a triangle holds: candidates by the cells of its box, then the exact test."""
    x0, y0 = (F.col("c_custkey") * 37 % 330 - 180).cast("double"), (F.col("c_custkey") * 53 % 150 - 90).cast("double")
    ring = F.array(*[F.struct((x0 + a).alias("x"), (y0 + b).alias("y")) for a, b in ((0, 0), (20, 5), (7, 25))])
    granules = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ring.alias("ring"), footprints.rect_cells(GRID, x0, y0, x0 + 20, y0 + 25).alias("cells"))
    shards = spark.range(2592).select(F.col("id").alias("shard"))
    cx, cy = GRID.center("shard")
    pairs = footprints.indexed_pairs(granules, shards, 0).join(granules.select("id", "ring"), "id").withColumns({"cx": cx, "cy": cy})
    return footprints.refined(pairs, "cx", "cy", "ring").groupBy("shard").agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query("cov_06_index_column", """WITH b AS (SELECT c_custkey AS id, c_custkey * 37 % 330 - 180 AS x, c_custkey * 53 % 150 - 90 AS y FROM customer)
  SELECT id, CAST(least((90 - y) // 5, 35) AS BIGINT) * 72 + (x + 180) // 5 AS first_low, count(*) AS n FROM b, range(2592) r(i)
  WHERE i % 72 BETWEEN (x + 180) // 5 AND (x + 192) // 5 AND i // 72 BETWEEN greatest((90 - y - 8) // 5, 0) AND least((90 - y) // 5, 35) GROUP BY ALL""")  # fmt: skip
def cov_06_index_column(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 37 % 330 - 180).alias("x"), (F.col("c_custkey") * 53 % 150 - 90).alias("y"))
    index = footprints.rect_cells(GRID, F.col("x"), F.col("y"), F.col("x") + 12, F.col("y") + 8)
    bottom_left = F.least(F.floor((90 - F.col("y")) / 5), F.lit(35)) * 72 + F.floor((F.col("x") + 180) / 5)
    return df.withColumn("cells", index).select("id", bottom_left.alias("first_low"), F.size("cells").cast("long").alias("n")).where("n > 0")


@query("cov_07_corridors", "SELECT c_custkey AS id, k, round(c_custkey % 50 + 12.0 * k / 3, 6) AS x, round(CAST(k AS DOUBLE), 6) AS y FROM customer, range(3) r(k)")
def cov_07_corridors(spark, sf_dir):
    x = (F.col("c_custkey") % 50).cast("double")
    ring = F.array(*[F.struct((x + a).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((0, 0), (0, 9), (12, 12), (12, 3))])
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ring.alias("ring"))
    each = df.select("id", F.posexplode(footprints.corridors("ring", 3)).alias("k", "c"))
    return each.select("id", F.col("k").cast("long").alias("k"), F.round(F.col("c")[0]["x"], 6).alias("x"), F.round(F.col("c")[0]["y"], 6).alias("y"))


_WINDOWS = [(str(y), datetime(y, 1, 1), datetime(y + 1, 1, 1)) for y in range(1992, 1999)]


@query("jon_12_spans", """WITH i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END AS s, o_orderdate + (o_custkey % 400) * INTERVAL 1 DAY AS e FROM orders),
  w AS (SELECT CAST(y AS VARCHAR) AS label, make_timestamp(y, 1, 1, 0, 0, 0) AS lo, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS hi FROM range(1992, 1999) r(y))
  SELECT label, count(*) AS n FROM i, w WHERE s IS NULL OR (s < hi AND CASE WHEN s = e THEN e >= lo ELSE e > lo END) GROUP BY label""")  # fmt: skip
def jon_12_spans(spark, sf_dir):
    start = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
    end = F.col("o_orderdate") + F.make_dt_interval((F.col("o_custkey") % 400).cast("int"))
    items = table(spark, sf_dir, "orders").select("o_orderkey", start.alias("s"), end.alias("e"))
    return footprints.in_windows(items, "s", "e", _WINDOWS).groupBy("label").agg(F.count("*").alias("n"))


@query("jon_11_aligned", f"""WITH {CELLS}, m AS (SELECT DISTINCT cell FROM cells WHERE cell % 3 = 0), v AS (SELECT cell, avg(l_quantity) AS v FROM cells GROUP BY cell), s AS (SELECT DISTINCT cell FROM cells WHERE cell % 2 = 0)
  SELECT cell, round(v, 4) AS v FROM m JOIN v USING (cell) JOIN s USING (cell)""")  # fmt: skip
def jon_11_aligned(spark, sf_dir):
    df = celled(spark, sf_dir)
    mask, static = (df.select("cell").distinct().where(F.col("cell") % k == 0) for k in (3, 2))
    return rounded(joins.aligned(mask, df.groupBy("cell").agg(F.avg("l_quantity").alias("v")), static, keys=["cell"]), 4)


@query("agg_26_observed_range", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS shard, min(l_shipdate) AS start, max(l_shipdate) AS \"end\" FROM marked WHERE l_quantity > 10 GROUP BY ALL")
def agg_26_observed_range(spark, sf_dir):
    df = nested(spark, sf_dir).where("l_quantity > 10").withColumn("shard", cells.coarsen("h", 2))
    return aggregate.envelope(df, ["shard"], "l_shipdate")


@query("agg_28_first_seen", "SELECT o_custkey AS shard, array_to_string(list(p ORDER BY k), ',') AS granules FROM (SELECT o_custkey, o_orderpriority AS p, min(o_orderkey) AS k FROM orders GROUP BY ALL) GROUP BY o_custkey")
def agg_28_first_seen(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("shard"), F.col("o_orderpriority").alias("id"), "o_orderkey")
    return footprints.map_of(pairs, ordinal="o_orderkey").select("shard", F.concat_ws(",", "granules").alias("granules"))


@query("pyr_10_stage_merge", f"WITH {CELLS}{FOUR} SELECT h >> 6 AS h, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, round(sum(l_quantity), 3) AS total FROM marked GROUP BY ALL")
def pyr_10_stage_merge(spark, sf_dir):
    """Partials of three parts of the rows, merged at once."""
    df = nested(spark, sf_dir)
    parts = [aggregate.by_cell(df.where(F.col("l_linenumber") % 3 == k), _PYR_FIELDS, ["h"]) for k in range(3)]
    return rounded(sweep.stage_merge(parts, "h", 3, _PYR))


@query("pyr_12_cascade", " UNION ALL ".join(f"SELECT {o} AS \"order\", h >> {2 * (4 - o)} AS h, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, round(sum(l_quantity), 3) AS total FROM (WITH {CELLS}{FOUR} SELECT * FROM marked) GROUP BY ALL" for o in (3, 1, 0)))
def pyr_12_cascade(spark, sf_dir):
    """Each level from the one before, gathered out of one table."""
    levels = sweep.cascade(aggregate.by_cell(nested(spark, sf_dir), _PYR_FIELDS, ["h"]), "h", 4, [3, 2, 1, 0], _PYR)
    return rounded(sweep.gather(sweep.all_orders(levels), [3, 1, 0])).select("order", "h", "n", "low", "high", "total")


@query("pyr_14_populated", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS shard, count(DISTINCT h) AS n FROM marked GROUP BY ALL")
def pyr_14_populated(spark, sf_dir):
    level = aggregate.by_cell(nested(spark, sf_dir), _PYR_FIELDS, ["h"])
    return sweep.populated(level, "h", 2, ["n", "low"]).select("shard", "n")


@query("cov_01_boxes", f"""WITH {CELLS}{FOUR}, c AS (SELECT DISTINCT l_orderkey AS shard, ((l_orderkey % 12) << 8) + h % 256 AS c FROM marked), u AS (SELECT shard, k, c >> (2 * k) AS up FROM c, range(5) r(k) GROUP BY ALL),
  b AS (SELECT shard, min(k) AS k FROM (SELECT shard, k FROM u GROUP BY ALL HAVING count(*) <= 4) GROUP BY shard) SELECT u.shard, 4 - u.k AS box_order, array_to_string(list(up ORDER BY up), ',') AS box FROM u JOIN b USING (shard, k) GROUP BY ALL""")  # fmt: skip
def cov_01_boxes(spark, sf_dir):
    df = nested(spark, sf_dir).select(F.col("l_orderkey").alias("shard"), (F.shiftleft(F.col("l_orderkey") % 12, 8) + F.col("h") % 256).alias("c")).distinct()
    return coverage.box(df, "shard", "c", 4).select("shard", F.col("box_order").cast("long").alias("box_order"), F.concat_ws(",", F.transform("box", lambda c: c.cast("string"))).alias("box"))


@query("tmp_07_temporal_section", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS shard, min(l_shipdate) AS start, max(l_shipdate) AS \"end\", count(l_shipdate) AS n, (SELECT count(*) FROM marked) AS at_root FROM marked GROUP BY ALL")
def tmp_07_temporal_section(spark, sf_dir):
    envelopes, root = sweep.temporal_section(nested(spark, sf_dir).withColumn("shard", cells.coarsen("h", 2)), "shard", "l_shipdate", 64)
    weight = root.select(F.round(F.aggregate("digest", F.lit(0.0), lambda a, c: a + c["weight"].cast("double"))).cast("long").alias("at_root"))
    return envelopes.crossJoin(F.broadcast(weight))  # one row


@query("snk_06_leaves", f"""WITH {CELLS}{FOUR} SELECT h >> 6 AS shard, count(DISTINCT h) AS cells, count(*) AS n, CASE WHEN (h >> 6) % 2 = 0 THEN 'first' ELSE 'second' END AS run FROM marked GROUP BY ALL""")
def snk_06_leaves(spark, sf_dir):
    """Half the shards are written, then all planned: the second run skips those that are there, and readers see each once."""
    df = aggregate.by_cell(nested(spark, sf_dir).withColumn("shard", cells.coarsen("h", 3)), _PYR_FIELDS[:1], ["h", "shard"])
    planned = df.select("shard", F.concat(F.lit("g"), F.col("shard").cast("string")).alias("granule")).distinct()
    root, manifest = scratch(spark), {"semantic_hash": "x", "grid": GRID.signature(), "schema": ["n"]}
    store.write_leaves(df.where("shard % 2 = 0"), planned.where("shard % 2 = 0"), root, "h", 3, manifest, "first")
    runs = store.write_leaves(df, planned, root, "h", 3, manifest, "second")
    found = store.read_leaves(spark, root).groupBy("shard").agg(F.count("*").alias("cells"), F.sum("n").alias("n"))
    return found.join(runs, "shard").select("shard", "cells", "n", "run")


@query("snk_12_shard_map", "SELECT o_custkey AS shard, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY ALL")
def snk_12_shard_map(spark, sf_dir):
    """Through JSON, then through Parquet."""
    pairs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("shard"), F.col("o_orderpriority").alias("id"))
    root = scratch(spark)
    store.write_map(footprints.map_of(pairs), f"{root}/map.json", "json")
    store.write_map(store.read_map(spark, f"{root}/map.json", "json"), f"{root}/map")
    return store.read_map(spark, f"{root}/map").select("shard", F.size("granules").cast("long").alias("n"))


@query("lim_01_selected", "SELECT c_custkey AS shard, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL ORDER BY n DESC, shard LIMIT 10")
def lim_01_selected(spark, sf_dir):
    df = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return aggregate.selected(df.groupBy(F.col("c_custkey").alias("shard")).agg(F.count("*").alias("n")), most=10)


class Spread:
    """Greatest less least, in the shape of a user's aggregate."""

    def __init__(self):
        self.low, self.high = float("inf"), float("-inf")

    def update(self, x):
        self.low, self.high = min(self.low, x.min()), max(self.high, x.max())

    def finalize(self):
        return float(self.high - self.low)


@query("udf_04_user_aggregate", f"WITH {CELLS} SELECT cell // 72 AS r, max(l_quantity) - min(l_quantity) AS value FROM cells GROUP BY ALL")
def udf_04_user_aggregate(spark, sf_dir):
    df = celled(spark, sf_dir).select(F.floor(F.col("cell") / 72).alias("r"), F.col("l_quantity").alias("x"))
    return registry.user_aggregate(df, ["r"], ["x"], Spread, "double")


@query("agg_03_nan_laws", f"""WITH {CELLS}, x AS (SELECT cell, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS q FROM cells)
  SELECT cell, CASE WHEN count(q) < count(*) THEN -1 ELSE max(q) END AS strict, coalesce(max(q), -1) AS skipping, coalesce(sum(q), 0) AS total FROM x GROUP BY cell""")  # fmt: skip
def agg_03_nan_laws(spark, sf_dir):
    """NaN goes through max, is passed over by nanmax, and counts as nothing in nansum."""
    df = celled(spark, sf_dir).withColumn("q", F.when(F.col("l_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity")))
    fields = [aggregate.Field(n, f, "q", dtype="float64") for n, f in (("strict", "max"), ("skipping", "nanmax"), ("total", "nansum"))]
    found = aggregate.by_cell(df, fields, ["cell"])
    return found.withColumns({c: F.nanvl(c, F.lit(-1.0)) for c in ("strict", "skipping")})


@query("pyr_04_digest_fold", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS h, count(*) AS n FROM marked GROUP BY ALL")
def pyr_04_digest_fold(spark, sf_dir):
    folded = pyramid.digests(sketch.build(nested(spark, sf_dir), ["h"], "l_quantity", 64), "h", 2, "digest", 64)
    return folded.select("h", F.round(F.aggregate("digest", F.lit(0.0), lambda a, c: a + c["weight"].cast("double"))).cast("long").alias("n"))


@query("pyr_19_reprojected_pairs", "SELECT shard >> 2 AS shard, count(DISTINCT id) AS n FROM (SELECT o_custkey % 256 AS shard, o_orderpriority AS id FROM orders) GROUP BY ALL")
def pyr_19_reprojected_pairs(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 256).alias("shard"), F.col("o_orderpriority").alias("id"))
    return catalog.reprojected(footprints.map_of(pairs), 1).select("shard", F.size("granules").cast("long").alias("n"))
