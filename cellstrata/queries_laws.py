"""Registered queries of filters, joins, sketches, events and sinks that the other modules leave out, and their SQL; see queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import cells, packing, times
from .operators import aggregate, coverage, events, filters, identity, joins, pyramid, raster, readplan, sketch, sweep
from .plans import registry
from .queries import CELLS, FOUR, GRID, OBS, celled, nested, observed, query, rounded, table
from .queries_store import _records as records
from .queries_store import scratch
from .sources import store, tables
from .streaming import micro_batch

NAN = float("nan")


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is NaN in every seventh and null in every eleventh row."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit(NAN)).when(F.col("event_id") % 11 != 0, F.col("value"))
    return table(spark, sf_dir, "events").withColumn("x", value)


#: SQL's side has null for both, and says for each predicate what they give.
_GAPPY = "g AS (SELECT *, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN value END AS x FROM events)"


@query("flt_09_missing_values", f"""WITH {_GAPPY} SELECT event_type, count(*) FILTER (x = 50) AS eq, count(*) FILTER (x IS NULL OR x <> 50) AS ne, count(*) FILTER (x >= 50) AS ge, count(*) FILTER (x > 50) AS gt,
  count(*) FILTER (x <= 50) AS le, count(*) FILTER (x < 50) AS lt, count(*) FILTER (x IS NULL OR x < 50) AS not_ge, count(*) FILTER (x IS NULL OR x NOT IN (10, 50)) AS not_in FROM g GROUP BY ALL""")  # fmt: skip
def flt_09_missing_values(spark, sf_dir):
    """Every operator and an inverted one where values are NaN or null."""
    specs = {op: {"variable": "x", "op": op, "value": 50} for op in ("eq", "ne", "ge", "gt", "le", "lt")}
    specs |= {"not_ge": specs["ge"] | {"keep": False}, "not_in": {"variable": "x", "op": "not_in", "values": [10, 50]}}
    return _gappy(spark, sf_dir).groupBy("event_type").agg(*[F.count_if(filters.predicate(s)).alias(n) for n, s in specs.items()])


@query("flt_10_quality_filter", """SELECT 'alone' AS given, count(*) AS n FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'beside others', count(*) FROM lineitem WHERE l_linenumber >= 3""")  # fmt: skip
def flt_10_quality_filter(spark, sf_dir):
    df, own = table(spark, sf_dir, "lineitem"), {"dataset": "l_returnflag", "value": "R"}
    alone = filters.apply(df, quality_filter=own).agg(F.lit("alone").alias("given"), F.count("*").alias("n"))
    beside = filters.apply(df, [{"variable": "l_linenumber", "op": "ge", "value": 3}], quality_filter=own)
    return alone.unionByName(beside.agg(F.lit("beside others").alias("given"), F.count("*").alias("n")))


@query("flt_11_array_column", "SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_discount < 0.05 GROUP BY ALL")
def flt_11_array_column(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_linenumber", F.array("l_quantity", "l_discount").alias("v"))
    return df.where(filters.predicate({"variable": "v", "column": 1, "op": "lt", "value": 0.05})).groupBy("l_linenumber").agg(F.count("*").alias("n"))


@query("flt_15_shard_mask", f"WITH {CELLS}{FOUR} SELECT h, count(*) AS n FROM marked WHERE h >> 6 = 5 GROUP BY ALL")
def flt_15_shard_mask(spark, sf_dir):
    grid = cells.HealpixGrid(1, 4)
    return nested(spark, sf_dir).where(grid.shard("h") == 5).groupBy("h").agg(F.count("*").alias("n"))


@query("flt_19_time_overlap", """WITH s AS (SELECT o_orderstatus, o_orderdate AS a, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) END AS b FROM orders)
  SELECT o_orderstatus, count(*) AS n FROM s WHERE b IS NULL OR (a < TIMESTAMP '1996-01-01' AND CASE WHEN a = b THEN b >= TIMESTAMP '1995-01-01' ELSE b > TIMESTAMP '1995-01-01' END) GROUP BY ALL""")  # fmt: skip
def flt_19_time_overlap(spark, sf_dir):
    start = F.col("o_orderdate").cast("timestamp")
    end = F.when(F.col("o_orderkey") % 11 != 0, start + F.make_dt_interval(days=(F.col("o_orderkey") % 5).cast("int")))
    low, high = (F.lit(times.parse(t)) for t in ("1995-01-01", "1996-01-01"))
    return table(spark, sf_dir, "orders").where(times.overlaps(start, end, low, high)).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("flt_20_event_masks", """WITH m AS (SELECT event_type, event_id % 3 AS mask, user_id % 2 = 0 AS ais FROM events)
  SELECT event_type, CAST(sum(mask) AS BIGINT) AS f, CAST(sum(mask * ais::INT) AS BIGINT) AS a, CAST(sum(mask * (NOT ais)::INT) AS BIGINT) AS o FROM m GROUP BY ALL""")  # fmt: skip
def flt_20_event_masks(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumns({"mask": F.col("event_id") % 3, "ais_mask": F.col("user_id") % 2 == 0})
    return df.groupBy("event_type").agg(*[F.sum(filters.event_mask(k)).alias(k[0]) for k in ("full", "ais", "ocean")])


@query("flt_22_strata", """SELECT l_suppkey, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS weight, round(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS total FROM lineitem GROUP BY ALL""")
def flt_22_strata(spark, sf_dir):
    """A digest of the rows of one stratum: its weights and weighted means add up to the rows'."""
    found = sketch.build(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity", where=F.col("l_returnflag") == "R")
    weight = F.aggregate("digest", F.lit(0.0), lambda s, c: s + c["weight"].cast("double"))
    total = F.aggregate("digest", F.lit(0.0), lambda s, c: s + c["weight"].cast("double") * c["mean"])
    return found.select("l_suppkey", weight.alias("weight"), F.when(weight > 0, F.round(total, 0)).alias("total"))


@query("agg_22_flux_digest", """SELECT l_partkey, CAST(count(*) FILTER (l_quantity > 26) AS BIGINT) AS centroids, coalesce(sum(l_quantity - 20) FILTER (l_quantity > 26), 0) AS weight FROM lineitem GROUP BY ALL""")
def agg_22_flux_digest(spark, sf_dir):
    """Samples above noise weigh what they rise above the mean; their digest has no loss at so high a delta."""
    weight = packing.flux(F.col("l_quantity"), F.lit(20.0), F.lit(3.0), 2.0)
    found = sketch.waveform_digest(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_extendedprice", weight, 1e6)
    total = F.aggregate("digest", F.lit(0.0), lambda s, c: s + c["weight"].cast("double"))
    return found.select("l_partkey", F.size("digest").cast("long").alias("centroids"), total.alias("weight"))


@query("agg_21_single_or_nan", "SELECT l_orderkey, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN CAST(CASE min(l_linestatus) WHEN 'O' THEN 1 ELSE 0 END AS DOUBLE) ELSE 'nan'::DOUBLE END AS status FROM lineitem GROUP BY ALL")
def agg_21_single_or_nan(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("open", (F.col("l_linestatus") == "O").cast("int"))
    return aggregate.by_cell(df, [aggregate.Field("status", function="single_or_nan", source="open", dtype="float64")], ["l_orderkey"])


@query("agg_25_occupied_cells", f"WITH {CELLS}{FOUR} SELECT DISTINCT h >> 6 AS shard, h FROM marked")
def agg_25_occupied_cells(spark, sf_dir):
    return aggregate.occupied(nested(spark, sf_dir).withColumn("shard", cells.coarsen("h", 3)), ["shard", "h"])


@query("agg_29_shapes", "SELECT l_suppkey, count(*) FILTER (l_quantity < 5) AS lowest, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_29_shapes(spark, sf_dir):
    """Vectors of the declared shape pass with all their values."""
    counts = aggregate.histogram(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity", 0, 50, 10, "h")
    return aggregate.shaped(counts, "h", 10).select("l_suppkey", F.get("h", F.lit(0)).alias("lowest"), F.aggregate("h", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))


@query("jon_02_sibling_variable", """WITH c AS (SELECT * FROM customer WHERE c_custkey % 3 = 0) SELECT o_orderpriority, count(*) AS n, count(*) FILTER (c_custkey IS NULL) AS missing, round(sum(c_acctbal), 1) AS total
  FROM orders LEFT JOIN c ON o_custkey = c_custkey GROUP BY ALL""")  # fmt: skip
def jon_02_sibling_variable(spark, sf_dir):
    """A variable of the sibling is NaN where there is no sibling."""
    right = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0")
    df = joins.sibling(table(spark, sf_dir, "orders"), right, "o_custkey", "c_custkey", {"bal": "c_acctbal"})
    return df.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if(F.isnan("bal")).alias("missing"), F.round(F.sum(F.when(~F.isnan("bal"), F.col("bal"))), 1).alias("total"))


_RING = [(-100.003, -50.007), (80.011, -20.013), (10.017, 70.019)]
_EDGES = " + ".join(f"CAST(({y0} > lat) <> ({y1} > lat) AND lon < ({x1} - ({x0})) * (lat - ({y0})) / ({y1} - ({y0})) + ({x0}) AS INT)" for (x0, y0), (x1, y1) in zip(_RING, _RING[1:] + _RING[:1], strict=True))


@query("jon_08_point_in_polygon", f"WITH {OBS} SELECT l_linenumber, count(*) AS n FROM obs WHERE ({_EDGES}) % 2 = 1 GROUP BY ALL")
def jon_08_point_in_polygon(spark, sf_dir):
    return observed(spark, sf_dir).where(coverage.in_polygon("lon", "lat", _RING)).groupBy("l_linenumber").agg(F.count("*").alias("n"))


@query("jon_14_aoi_of_shards", f"""WITH {CELLS}{FOUR}, s AS (SELECT DISTINCT h >> 6 AS shard FROM marked), a AS (SELECT shard, greatest(shard * 64, 100) AS low, least(shard * 64 + 64, 1000) AS high FROM s)
  SELECT CAST(sum(high - low) AS BIGINT) AS cells, min(low) AS low, max(high) AS high FROM a WHERE low < high""")  # fmt: skip
def jon_14_aoi_of_shards(spark, sf_dir):
    """The part of an area of interest that lies in the shards there are."""
    shards = coverage.ranges(nested(spark, sf_dir).select(cells.coarsen("h", 3).alias("shard")).distinct(), "shard", 1)
    aoi = coverage.ranges(spark.range(100, 1000).withColumnRenamed("id", "cell"), "cell", 4)
    inside = coverage.to_order(coverage.intersection(aoi, shards), 4)
    return inside.agg(F.count("*").alias("cells"), F.min("cell").alias("low"), (F.max("cell") + 1).alias("high"))


@query("src_06_box_matches", """WITH p AS (SELECT user_id, event_id, event_id * 7 % 180 - 90 AS lat, event_id * 13 % 360 - 180 AS lon FROM events),
  s AS (SELECT *, coalesce(lead(lat) OVER w, lat) AS lat2, coalesce(lead(lon) OVER w, lon) AS lon2 FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  c AS (SELECT *, (lon2 - lon) * (y - lat) - (lat2 - lat) * (x - lon) AS side FROM s, (VALUES (-40.0137, -20.0291), (-40.0137, 35.0173), (60.0319, -20.0291), (60.0319, 35.0173)) v(x, y))
  SELECT user_id, count(*) AS n FROM (SELECT user_id, event_id FROM c WHERE least(lon, lon2) <= 60.0319 AND greatest(lon, lon2) >= -40.0137 AND least(lat, lat2) <= 35.0173 AND greatest(lat, lat2) >= -20.0291
    GROUP BY user_id, event_id HAVING min(side) <= 0 AND max(side) >= 0) GROUP BY ALL""")  # fmt: skip
def src_06_box_matches(spark, sf_dir):
    """Records in the box or whose way to the next one crosses it; SQL tells by the sides on which the corners lie."""
    df = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") * 7 % 180 - 90).cast("double").alias("lat"), (F.col("event_id") * 13 % 360 - 180).cast("double").alias("lon"))
    hit = readplan.crosses_box("lat", "lon", ["user_id"], "event_id", (-40.0137, -20.0291, 60.0319, 35.0173))
    return df.withColumn("hit", hit).where("hit").groupBy("user_id").agg(F.count("*").alias("n"))


@query("sk_08_cdf", """WITH m AS (SELECT l_partkey, CAST(l_extendedprice AS FLOAT)::DOUBLE AS v, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice) - 0.5 AS c FROM lineitem),
  a AS (SELECT l_partkey, min(v) * 0.4 + max(v) * 0.6 AS x, count(*) AS n, min(v) AS low FROM m GROUP BY ALL),
  b AS (SELECT l_partkey, any_value(x) AS x, any_value(n) AS n, max_by(v, c) FILTER (v <= x) AS v0, max(c) FILTER (v <= x) AS c0, min_by(v, c) FILTER (v > x) AS v1, min(c) FILTER (v > x) AS c1 FROM m JOIN a USING (l_partkey) GROUP BY ALL)
  SELECT l_partkey, round(CASE WHEN v1 IS NULL THEN n WHEN v0 IS NULL THEN 0 ELSE c0 + (c1 - c0) * (x - v0) / (v1 - v0) END, 5) AS cdf FROM b""")  # fmt: skip
def sk_08_cdf(spark, sf_dir):
    """Weight at or below a point of each part's prices; digests of so few rows have no loss."""
    found = sketch.build(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_extendedprice", 1e6)
    x = F.element_at("digest", 1)["mean"].cast("double") * 0.4 + F.element_at("digest", -1)["mean"].cast("double") * 0.6
    return rounded(sketch.cdf_at(found.withColumn("x", x), "digest", "x").select("l_partkey", "cdf"), 5)


@query("sk_12_fit_window", """WITH s AS (SELECT l_suppkey, floor(min(l_extendedprice) / 4) * 4 AS start, max(l_extendedprice) AS high FROM lineitem GROUP BY ALL)
  SELECT l_suppkey, start, CASE WHEN high - start <= 4000 THEN 4.0 ELSE ceil((high - start) / 4000) * 4 END AS coarser, 4.0 AS cut FROM s""")  # fmt: skip
def sk_12_fit_window(spark, sf_dir):
    """Windows of 1,000 bins of 4: coarser bins, or a cut, where the span is too wide."""
    spans = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))
    start, coarser = sketch.fit_window(F.col("low"), F.col("high"), 1000, 4.0, "degrade_resolution")
    cut = sketch.fit_window(F.col("low"), F.col("high"), 1000, 4.0, "collapse_bins")[1]
    return spans.select("l_suppkey", start.cast("double").alias("start"), coarser.cast("double").alias("coarser"), cut.cast("double").alias("cut"))


@query("sk_13_mask", f"""WITH {CELLS}{FOUR}, d AS (SELECT h, count(*) FILTER (l_returnflag = 'R') AS n FROM marked WHERE h % 3 = 0 GROUP BY h)
  SELECT range AS h, CASE WHEN n > 0 THEN 2 WHEN n = 0 THEN 1 ELSE 0 END AS mask FROM range(4096) LEFT JOIN d ON h = range""")  # fmt: skip
def sk_13_mask(spark, sf_dir):
    found = sketch.build(nested(spark, sf_dir).where("h % 3 = 0"), ["h"], "l_quantity", where=F.col("l_returnflag") == "R")
    return sketch.occupancy(found, "h", spark.range(4096).withColumnRenamed("id", "h")).select("h", "mask")


@query("sk_14_composition_merge", f"""WITH {CELLS}{FOUR}, w AS (SELECT h, count(*) FILTER (l_quantity > 25) AS strong, count(*) AS n FROM marked GROUP BY h)
  SELECT h >> 4 AS up, CAST(sum(n) AS BIGINT) AS n, max(strong) > 0 AS present FROM w GROUP BY ALL""")  # fmt: skip
def sk_14_composition_merge(spark, sf_dir):
    """Words of cells merged two levels up: counts add up, and what is there in a cell is there above."""
    strong = [F.when(F.col("l_quantity") > 25, 4).otherwise(0), *[F.lit(2)] * 4]
    words = nested(spark, sf_dir).groupBy("h").agg(*packing.composition(strong))
    merged = words.groupBy(cells.coarsen("h", 2).alias("up")).agg(*packing.merge_compositions("word", "n"))
    return merged.select("up", F.col("n").cast("long").alias("n"), (packing.unpack("word")[0] > 0).alias("present"))


@query("win_04_gradient", f"""WITH {CELLS}, g AS (SELECT l_linenumber AS t, 87.5 - 5 * (cell // 72) AS lat, -177.5 + 5 * (cell % 72) AS lon, avg(l_quantity) AS v FROM cells GROUP BY ALL),
  d AS (SELECT *, (coalesce(lead(v) OVER y, v) - coalesce(lag(v) OVER y, v)) / radians(nullif(coalesce(lead(lat) OVER y, lat) - coalesce(lag(lat) OVER y, lat), 0)) / 6378 AS dy,
    (coalesce(lead(v) OVER x, v) - coalesce(lag(v) OVER x, v)) / radians(nullif(coalesce(lead(lon) OVER x, lon) - coalesce(lag(lon) OVER x, lon), 0)) / 6378 / sin(radians(lat)) AS dx
    FROM g WINDOW y AS (PARTITION BY t, lon ORDER BY lat), x AS (PARTITION BY t, lat ORDER BY lon))
  SELECT t, round(max(sqrt(dx * dx + dy * dy)), 6) AS steepest FROM d GROUP BY t""")  # fmt: skip
def win_04_gradient(spark, sf_dir):
    """The steepest gradient of each step's mean quantities on the grid of 5 degrees."""
    grid = celled(spark, sf_dir).groupBy(F.col("l_linenumber").alias("t"), (87.5 - 5 * F.floor(F.col("cell") / 72)).cast("double").alias("lat"), (-177.5 + 5 * (F.col("cell") % 72)).cast("double").alias("lon")).agg(F.avg("l_quantity").alias("v"))
    found = events.gradient(grid, "v", keys=("t",))
    return found.groupBy("t").agg(F.round(F.max("gradient"), 6).alias("steepest"))


@query("evt_05_min_over_levels", f"""WITH {CELLS}, m AS (SELECT l_linenumber AS t, cell, min(l_extendedprice) AS v, any_value(cell % 3) AS mask FROM cells GROUP BY ALL)
  SELECT t, round(sum(v * mask * 2.0), 0) AS ws, sum(mask * 2.0) AS w FROM m GROUP BY t""")  # fmt: skip
def evt_05_min_over_levels(spark, sf_dir):
    """The least of a place's levels, then the parts of its weighted mean."""
    df = celled(spark, sf_dir).select(F.col("l_linenumber").alias("t"), "cell", F.col("l_extendedprice").alias("v"), (F.col("cell") % 3).alias("mask"), F.lit(2.0).alias("area"))
    least = events.min_over_levels(df, "v", keys=("t", "cell"))
    found = events.timesteps(least, "weighted_mean", "v", area="area", keys=("t",))
    return found.select("t", F.round("ws", 0).alias("ws"), F.col("w").cast("double").alias("w"))


@query("prj_09_prepared", """WITH p AS (SELECT round(value / 10, 0) AS lat, date_trunc('day', ts + INTERVAL 6 HOURS) AS ts, value * 2 AS value FROM events)
  SELECT lat, strftime(ts, '%Y-%m-%d') AS day, round(sum(value), 4) AS value FROM p GROUP BY ALL""")  # fmt: skip
def prj_09_prepared(spark, sf_dir):
    """Coordinates rounded, times shifted, values scaled, days summed: in this order."""
    df = table(spark, sf_dir, "events").select((F.col("value") / 10).alias("lat"), F.col("ts").cast("timestamp").alias("t"), "value", "props")
    found = events.prepared(df, round_to=0, shift="6 HOURS", scale={"value": 2.0}, resample=("1 day", "sum"), keys=("lat",), values=("value",))
    return found.select("lat", F.date_format("t", "yyyy-MM-dd").alias("day"), F.round("value", 4).alias("value"))


@query("prj_13_scales", """SELECT event_type, CAST(min((1262304000 - 18)::BIGINT * 1000000000 + event_id::BIGINT * 500000000) AS BIGINT) AS gps, CAST(max(1514764800::BIGINT * 1000000000 + event_id::BIGINT * 500000000) AS BIGINT) AS late,
  CAST(max((946684800 - 37)::BIGINT * 1000000000 + event_id::BIGINT % 10000 * 86400000000000) AS BIGINT) AS tai FROM events GROUP BY ALL""")  # fmt: skip
def prj_13_scales(spark, sf_dir):
    """Offsets on other scales: leap seconds count for epochs before 2017 only."""
    df = table(spark, sf_dir, "events").withColumn("x", F.col("event_id") * 0.5)
    gps = F.min(times.to_nanoseconds("x", "2010-01-01", "gps")).alias("gps")
    late = F.max(times.to_nanoseconds("x", "2018-01-01", "gps")).alias("late")
    return df.groupBy("event_type").agg(gps, late, F.max(times.to_nanoseconds(F.col("event_id") % 10000, "2000-01-01", "tai", "days")).alias("tai"))


@query("prj_20_time_steps", """WITH i AS (SELECT coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')) AS time_key, o_orderdate FROM orders),
  s AS (SELECT time_key, min(o_orderdate) AS first FROM i GROUP BY time_key) SELECT time_key, CAST(row_number() OVER (ORDER BY first, time_key) - 1 AS BIGINT) AS t_index FROM s""")  # fmt: skip
def prj_20_time_steps(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("datetime"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("time_key"))
    return raster.time_steps(items).select("time_key", F.col("t_index").cast("long").alias("t_index"))


@query("prj_19_squared_chord", f"""WITH {OBS}, c AS (SELECT l_orderkey, l_linenumber, i AS item, 2 - 2 * (sin(radians(lat)) * sin(radians(i * 30 - 60)) + cos(radians(lat)) * cos(radians(i * 30 - 60)) * cos(radians(lon - (i * 50 - 100)))) AS d
  FROM obs, range(5) r(i)) SELECT item, count(*) AS n FROM (SELECT l_orderkey, l_linenumber, arg_min(item, round(d, 9) * 10 + item * 1e-10) AS item FROM c GROUP BY ALL) GROUP BY item""")  # fmt: skip
def prj_19_squared_chord(spark, sf_dir):
    """Each observation's nearest of five tile centres by the chord; SQL has it from the angle between."""
    tiles = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(i * 30.0 - 60).alias("lat"), F.lit(i * 50.0 - 100).alias("lon")) for i in range(5)]))
    df = observed(spark, sf_dir).select("l_orderkey", "l_linenumber", "lat", "lon", tiles.alias("tile"), F.lit(1).alias("v"))
    df = df.withColumn("d", F.round(raster.squared_chord(F.col("lat"), F.col("lon"), F.col("tile.lat"), F.col("tile.lon")), 9)).withColumn("item", F.col("tile.i"))
    return raster.owned(df, ["l_orderkey", "l_linenumber"], "v", "d", "item").groupBy("item").agg(F.count("*").alias("n"))


@query("tmp_05_time_union", """WITH s AS (SELECT o_custkey, o_orderdate AS a, o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER) - 2) AS b FROM orders)
  SELECT o_custkey, epoch_us(min(a) FILTER (a <= b)) AS start, epoch_us(max(b) FILTER (a <= b)) AS end FROM s GROUP BY ALL""")  # fmt: skip
def tmp_05_time_union(spark, sf_dir):
    """Spans that end before they start don't count."""
    df = table(spark, sf_dir, "orders").withColumn("a", F.col("o_orderdate").cast("timestamp"))
    df = df.withColumn("b", F.col("a") + F.make_dt_interval(days=(F.col("o_orderkey") % 7 - 2).cast("int")))
    return df.groupBy("o_custkey").agg(*times.time_union("a", "b")).select("o_custkey", times.micros("start").alias("start"), times.micros("end").alias("end"))


@query("pyr_17_subtrees", f"WITH {CELLS}{FOUR} SELECT h >> 8 AS subtree, count(DISTINCT h) AS cells, count(*) AS n FROM marked GROUP BY ALL")
def pyr_17_subtrees(spark, sf_dir):
    return nested(spark, sf_dir).groupBy(pyramid.subtrees("h", 6, 2).alias("subtree")).agg(F.count_distinct("h").alias("cells"), F.count("*").alias("n"))


@query("snk_01_stamped_shards", f"WITH {CELLS}{FOUR}, c AS (SELECT h, count(*) AS n FROM marked GROUP BY h) SELECT h >> 6 AS shard, count(*) AS cells, CAST(sum(CASE WHEN (h >> 6) % 4 = 0 THEN 2 * n ELSE n END) AS BIGINT) AS n FROM c WHERE (h >> 6) % 2 = 0 GROUP BY ALL")
def snk_01_stamped_shards(spark, sf_dir):
    """All shards are written, every fourth again with other values; readers see those that have a stamp, each as last written."""
    df, root = nested(spark, sf_dir).groupBy(cells.coarsen("h", 3).alias("shard"), "h").agg(F.count("*").alias("n")), scratch(spark)
    tables.write_shards(df, f"{root}/data", ["shard"], "h")
    tables.write_shards(df.where("shard % 4 = 0").withColumn("n", F.col("n") * 2), f"{root}/data", ["shard"], "h")
    tables.stamp(df.where("shard % 2 = 0"), f"{root}/stamps", ["shard"], "run")
    found = tables.read_stamped(spark, f"{root}/data", f"{root}/stamps", ["shard"])
    return found.groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("cells"), F.sum("n").alias("n"))


@query("snk_04_chunk_uniform", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS chunk, coalesce(max(CASE WHEN h % 3 > 0 AND (h >> 4) % 5 > 0 THEN CAST((h >> 4) * 2 AS DOUBLE) END), 'nan'::DOUBLE) AS v FROM marked GROUP BY ALL")
def snk_04_chunk_uniform(spark, sf_dir):
    """One value of each chunk, NaN aside; a chunk of NaN keeps it."""
    df = nested(spark, sf_dir).withColumn("chunk", cells.coarsen("h", 2))
    df = df.withColumn("v", F.when((F.col("h") % 3 > 0) & (F.col("chunk") % 5 > 0), (F.col("chunk") * 2).cast("double")).otherwise(F.lit(NAN)))
    return aggregate.chunk_uniform(df, "chunk", "v")


@query("snk_11_tabular", "SELECT c_custkey AS event, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 'nan'::DOUBLE END AS parquet, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 'nan'::DOUBLE END AS csv FROM customer")
def snk_11_tabular(spark, sf_dir):
    """Results that an event lacks are NaN, in Parquet and in CSV."""
    df, root = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event"), "c_acctbal"), scratch(spark)
    full = events.table(df, [df.where("event % 3 = 0").withColumnRenamed("c_acctbal", "v")])
    tables.write_table(full, f"{root}/parquet")
    tables.write_table(full, f"{root}/csv", "csv")
    back = spark.read.schema("event long, v double").option("header", True).csv(f"{root}/csv")
    return spark.read.parquet(f"{root}/parquet").withColumnRenamed("v", "parquet").join(back.withColumnRenamed("v", "csv"), "event")


@query("src_01_scan", f"WITH {CELLS}{FOUR} SELECT h, CAST(sum(l_quantity) AS DOUBLE) AS q FROM marked WHERE h >= 512 AND h < 768 GROUP BY ALL")
def src_01_scan(spark, sf_dir):
    """Declared variables within a range of cells, which the files' statistics prune."""
    root = scratch(spark)
    nested(spark, sf_dir).select("h", "l_quantity", "l_tax").repartitionByRange("h").sortWithinPartitions("h").write.parquet(root)
    return tables.scan(spark, root, {"h": "h", "q": "l_quantity"}, "h", (512, 768)).groupBy("h").agg(F.sum("q").alias("q"))


@query("src_21_groups", "SELECT l_returnflag AS grp, count(*) AS n, round(sum(l_tax), 2) AS total FROM lineitem GROUP BY ALL")
def src_21_groups(spark, sf_dir):
    """One file for each group, read as one table that tells the group."""
    root, df = scratch(spark), table(spark, sf_dir, "lineitem")
    for flag in ("A", "N", "R"):
        df.where(F.col("l_returnflag") == flag).select("l_tax").write.parquet(f"{root}/{flag}")
    found = tables.union_groups(spark, [f"{root}/{flag}" for flag in ("A", "N", "R")])
    return found.groupBy("grp").agg(F.count("*").alias("n"), F.round(F.sum("l_tax"), 2).alias("total"))


def _widest(values, locations, temporal, share: float):
    return float(values.max() - values.min()) * share, int(locations.max()), int(temporal.min())


@query("udf_05_companion_reducer", "SELECT l_partkey, CAST(max(l_quantity) - min(l_quantity) AS DOUBLE) / 2 AS payload, max(l_orderkey) AS locations, min(l_suppkey) AS temporal FROM lineitem GROUP BY ALL")
def udf_05_companion_reducer(spark, sf_dir):
    return registry.companion_aggregate(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_quantity", _widest, "double", "l_orderkey", "l_suppkey", share=0.5)


@query("cov_03_root_ranges", f"WITH {CELLS}{FOUR} SELECT DISTINCT h >> 6 AS shard FROM marked WHERE h % 5 = 0")
def cov_03_root_ranges(spark, sf_dir):
    """Ranges of the shards that hold anything, and their union with those of an older run, expanded again."""
    df = nested(spark, sf_dir).where("h % 5 = 0").withColumn("shard", cells.coarsen("h", 3))
    new = coverage.bitmap(df.where("h % 10 = 0"), "shard", "h", 3)
    old = coverage.bitmap(df.where("h % 10 <> 0"), "shard", "h", 3)
    both = coverage.union(store.root_coverage(new, 3, 4), store.root_coverage(old, 3, 4))
    return coverage.to_order(both, 1).withColumnRenamed("cell", "shard")


@query("cov_04_stale", f"WITH {CELLS}{FOUR}, s AS (SELECT DISTINCT h >> 6 AS shard FROM marked) SELECT shard, CASE WHEN shard % 3 = 0 THEN 'data' ELSE 'coverage' END AS lacks FROM s WHERE (shard % 3 = 0) <> (shard % 4 = 0)")
def cov_04_stale(spark, sf_dir):
    """Shards with coverage but without data, and the other way round."""
    df = nested(spark, sf_dir).select(cells.coarsen("h", 3).alias("shard"))
    return store.stale_coverage(df.where("shard % 3 = 0"), df.where("shard % 4 = 0"))


@query("src_19_bitmap_and", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS shard, CAST(count(DISTINCT h) AS BIGINT) AS n FROM (SELECT h FROM marked WHERE l_returnflag = 'R' INTERSECT SELECT h FROM marked WHERE l_linenumber = 7) GROUP BY ALL")
def src_19_bitmap_and(spark, sf_dir):
    """Cells that two runs' bitmaps share."""
    df = nested(spark, sf_dir).withColumn("shard", cells.coarsen("h", 2))
    a, b = (coverage.bitmap(df.where(c), "shard", "h", 2) for c in ("l_returnflag = 'R'", "l_linenumber = 7"))
    n = F.length(F.replace(F.col("bitmap"), F.lit("0"), F.lit("")))
    return store.bitmap_and(a, b).select("shard", n.cast("long").alias("n")).where("n > 0")


@query("src_14_catalog_files", "SELECT c_custkey AS id, (c_custkey % 360) - 180.0 AS xmin FROM customer WHERE (c_custkey % 360) - 180 <= 20 AND (c_custkey % 360) - 178 >= -20 AND c_nationkey <= 12 AND c_nationkey + 1 >= 5")
def src_14_catalog_files(spark, sf_dir):
    """A catalog of footprints written, read, and searched by a box."""
    x, y = (F.col("c_custkey") % 360 - 180).cast("double"), F.col("c_nationkey").cast("double")
    items, root = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), x.alias("xmin"), y.alias("ymin"), (x + 2).alias("xmax"), (y + 1).alias("ymax")), scratch(spark)
    items.write.parquet(f"{root}/catalog")
    return spark.read.parquet(f"{root}/catalog").where(filters.in_boxes([(-20.0, 5.0, 20.0, 12.0)])).select("id", "xmin")


@query("snk_13_run_statistics", """SELECT CASE WHEN o_orderstatus = 'F' THEN 'one' ELSE 'two' END AS run, CAST(count(*) AS BIGINT) AS granules, max(o_totalprice) AS peak FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL""")
def snk_13_run_statistics(spark, sf_dir):
    """Two runs' records, the first written twice: each run counts once."""
    df, root = table(spark, sf_dir, "orders").select("o_orderstatus", F.col("o_custkey").alias("shard"), F.lit(1).alias("granules"), F.col("o_totalprice").alias("peak")), f"{scratch(spark)}/stats"
    for name, status in (("one", "P"), ("two", "O"), ("one", "F")):
        store.append_stats(df.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), root, name)
    return identity.merged_stats(spark.read.parquet(root), ["run"], counters=["granules"], peaks=["peak"])


@query("snk_14_levels", f"WITH {CELLS}{FOUR} SELECT 3 AS order_, h >> 2 AS h, count(*) AS n FROM marked GROUP BY ALL UNION ALL SELECT 1, h >> 6, count(*) FROM marked GROUP BY ALL")
def snk_14_levels(spark, sf_dir):
    """Levels written as one table, one of them anew, and two of them gathered."""
    base, root = nested(spark, sf_dir).groupBy("h").agg(F.count("*").alias("n")), f"{scratch(spark)}/levels"
    store.write_levels(sweep.cascade(base, "h", 4, [3, 2, 1], {"n": "len"}), root, "h")
    store.write_levels({3: pyramid.fold(base, "h", 1, {"n": "len"})}, root, "h")
    return sweep.gather(spark.read.parquet(root), [3, 1]).select(F.col("order").cast("int").alias("order_"), "h", "n")


@query("snk_05_template", "SELECT 0 AS n, 'cell bigint, n int, mean double' AS columns")
def snk_05_template(spark, sf_dir):
    """A product's table before any leaf is there."""
    root = f"{scratch(spark)}/template"
    store.template(spark, root, [aggregate.Field("n", "len", dtype="int32"), aggregate.Field("mean", "mean", "x", dtype="float64")], ["cell"])
    empty = spark.read.parquet(root)
    return empty.agg(F.count("*").cast("int").alias("n"), F.lit(", ".join(f"{c} {k}" for c, k in empty.dtypes)).alias("columns"))


@query("str_01_micro_batches", "SELECT l_suppkey AS cell, count(*) AS n, CAST(max(l_quantity) AS DOUBLE) AS top FROM lineitem GROUP BY ALL")
def str_01_micro_batches(spark, sf_dir):
    """A stream of files aggregated batch by batch and merged is as the table aggregated at once."""
    df, root = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_quantity").alias("x")), scratch(spark)
    df.repartition(3).write.parquet(f"{root}/in")
    fields = [aggregate.Field("n", "len", dtype="int64"), aggregate.Field("top", "max", "x", dtype="float64")]
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    micro_batch.merge_batches(stream, fields, ["cell"], f"{root}/out", f"{root}/ck").awaitTermination()
    return micro_batch.read_merged(spark, f"{root}/out", fields, ["cell"]).select("cell", "n", "top")


@query("jon_04_disjoint", "SELECT o_custkey, CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 3 + 1 END) AS BIGINT) AS samples FROM orders GROUP BY ALL")
def jon_04_disjoint(spark, sf_dir):
    """Records whose intervals don't overlap pass the check."""
    found = joins.disjoint(records(spark, sf_dir), ["o_custkey"], "begin", "cnt")
    return found.groupBy("o_custkey").agg(F.sum("cnt").alias("samples"))


@query("idn_02_nesting", "SELECT * FROM (VALUES ('finer cells', TRUE), ('other family', FALSE), ('other fields', FALSE), ('same grid', TRUE)) t(pair, nests)")
def idn_02_nesting(spark, sf_dir):
    """Which grids' products can be combined."""
    base = cells.HealpixGrid(2, 6)
    found = [("same grid", base.nests_with(base)), ("finer cells", base.nests_with(cells.HealpixGrid(3, 8))), ("other family", base.nests_with(GRID)), ("other fields", base.nests_with(base, ("n",), ("m",)))]
    return spark.createDataFrame(found, "pair string, nests boolean")


@query("idn_04_has_run", f"WITH {CELLS}{FOUR} SELECT h >> 6 AS shard, max((h >> 6) % 3 = 0) AS has_run FROM marked GROUP BY ALL")
def idn_04_has_run(spark, sf_dir):
    """Which planned shards a run has stamped."""
    planned, root = nested(spark, sf_dir).select(cells.coarsen("h", 3).alias("shard")).distinct(), scratch(spark)
    tables.stamp(planned.where("shard % 3 = 0"), f"{root}/stamps", ["shard"], "one")
    done = spark.read.parquet(f"{root}/stamps").where("run = 'one'").select(F.col("shard").alias("__done")).distinct()
    return planned.join(done, F.col("shard") == F.col("__done"), "left").select("shard", F.col("__done").isNotNull().alias("has_run"))
