"""Registered queries of the grid engine over the star-schema tables, and their SQL.

The tables have no coordinates, so observations get some by integer arithmetic
from their keys, which SQL can repeat. Floats are rounded on both sides, as sums
differ in their last digits with the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import cells, packing, times
from .functions.expressions import aggregate as reduce_by
from .functions.expressions import per_row
from .operators import aggregate, coverage, events, filters, identity, joins, pyramid, raster, readplan, sketch
from .operators.aggregate import Field
from .plans import compile as plan
from .plans import spec
from .sources import catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

OBS = """obs AS (SELECT *, CAST((l_partkey * 7919) % 18000 AS DOUBLE) / 100 - 90 AS lat,
  CAST((l_suppkey * 104729 + l_orderkey * 31) % 36000 AS DOUBLE) / 100 - 180 AS lon FROM lineitem)"""
CELLS = OBS + """, cells AS (SELECT *, CAST(floor((90 - lat) / 5) * 72 + floor((lon + 180) / 5) AS BIGINT) AS cell FROM obs
  WHERE lat > -90)"""
FOUR = """, marked AS (SELECT *, (cell * 37) % 4096 AS h FROM cells)"""
GRID = cells.RectGrid(-180, -90, 180, 90, 5, 5)


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    lat = ((F.col("l_partkey") * 7919) % 18000).cast("double") / 100 - 90
    lon = ((F.col("l_suppkey") * 104729 + F.col("l_orderkey") * 31) % 36000).cast("double") / 100 - 180
    return df.withColumn("lat", lat).withColumn("lon", lon)


def celled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GRID.with_cell(observed(spark, sf_dir), "lat", "lon").where("cell >= 0")


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with a nested cell of order 4 made from their keys."""
    return celled(spark, sf_dir).withColumn("h", (F.col("cell") * 37) % 4096)


def rounded(df: DataFrame, digits: int = 3) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if k in ("double", "float") else F.col(c) for c, k in df.dtypes])


LAND = {
    "data_source": {
        "coordinates": {"latitude": "lat", "longitude": "lon"},
        "variables": {"v": "l_extendedprice", "s": "l_quantity", "flag": "l_returnflag", "t": "l_shipdate"},
        "filters": [{"variable": "flag", "op": "ne", "value": "R"}],
    },
    "aggregation": {"variables": {
        "n": {"function": "len", "dtype": "int64", "fill_value": 0},
        "low": {"function": "min", "source": "v", "dtype": "float64"}, "high": {"function": "max", "source": "v", "dtype": "float64"},
        "weighted": {"function": "average", "source": "v", "params": {"weights": "1 / s ** 2"}, "dtype": "float64"},
        "sigma": {"expression": "1 / sqrt(sum(1 / s ** 2))", "dtype": "float64"},
        "variance": {"function": "var", "source": "v", "dtype": "float64"},
        "q25": {"function": "quantile", "source": "v", "params": {"q": 0.25}, "dtype": "float64"},
        "q50": {"function": "median", "source": "v", "dtype": "float64"},
        "q75": {"function": "quantile", "source": "v", "params": {"q": 0.75}, "dtype": "float64"},
    }},
    "output": {"grid": {"type": "rectilinear", "xmin": -180, "ymin": -90, "xmax": 180, "ymax": 90, "rx": 5, "ry": 5}, "windowing": {"schedule": "yearly", "time_field": "t"}},
}


@query("plan_land_ice_cells", f"""WITH {CELLS} SELECT cell, cell AS shard, strftime(l_shipdate, '%Y') AS "window", count(*) AS n,
  round(min(l_extendedprice), 4) AS low, round(max(l_extendedprice), 4) AS high,
  round(sum(l_extendedprice / l_quantity ** 2) / sum(1 / l_quantity ** 2), 4) AS weighted,
  round(1 / sqrt(sum(1 / l_quantity ** 2)), 4) AS sigma, round(var_pop(l_extendedprice) / 1000, 1) AS variance,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75
  FROM cells WHERE l_returnflag <> 'R' GROUP BY ALL""")  # fmt: skip
def plan_land_ice_cells(spark, sf_dir):
    found = plan.run(spec.parse(LAND), observed(spark, sf_dir)).cells
    found = found.withColumn("variance", F.round(F.col("variance") / 1000, 1))
    return rounded(found.select("cell", "shard", "window", "n", "low", "high", "weighted", "sigma", "variance", "q25", "q50", "q75"), 4)


def _healpix_sql(order: int) -> str:
    n, bits = 1 << order, range(order)
    spread = lambda v: " + ".join(f"(((CAST({v} AS BIGINT) >> {b}) & 1) << {2 * b})" for b in bits)
    e = cells._E
    q = f"(1 - {cells._E2!r}) * (sin(radians(lat)) / (1 - {cells._E2!r} * sin(radians(lat)) ** 2) - (1 / (2 * {e!r})) * ln((1 - {e!r} * sin(radians(lat))) / (1 + {e!r} * sin(radians(lat))))) / {cells._QP!r}"
    return f"""a AS (SELECT *, greatest(-1.0, least(1.0, {q})) AS z, (lon + 360.0 * (lon < 0)::INT) / 90.0 AS turn FROM obs),
  b AS (SELECT *, abs(z) AS za, CAST(floor({n} * (0.5 + turn) - {n} * z * 0.75) AS BIGINT) AS up, CAST(floor({n} * (0.5 + turn) + {n} * z * 0.75) AS BIGINT) AS down,
    CAST(least(3, floor(turn)) AS BIGINT) AS qu, {n} * sqrt(greatest(3 * (1 - abs(z)), 0.0)) AS sc FROM a),
  c AS (SELECT *, CAST(least(floor((turn - qu) * sc), {n - 1}) AS BIGINT) AS cp, CAST(least(floor((1 - (turn - qu)) * sc), {n - 1}) AS BIGINT) AS cm, up >> {order} AS fu, down >> {order} AS fd FROM b),
  d AS (SELECT *, CASE WHEN za <= 2.0/3.0 THEN CASE WHEN fu = fd THEN fu | 4 WHEN fu < fd THEN fu ELSE fd + 8 END WHEN z >= 0 THEN qu ELSE qu + 8 END AS face,
    CASE WHEN za <= 2.0/3.0 THEN down & {n - 1} WHEN z >= 0 THEN {n} - cm - 1 ELSE cp END AS x,
    CASE WHEN za <= 2.0/3.0 THEN {n - 1} - (up & {n - 1}) WHEN z >= 0 THEN {n} - cp - 1 ELSE cm END AS y FROM c),
  hp AS (SELECT *, ((face & 15) << {2 * order}) + ({spread('x')}) + 2 * ({spread('y')}) AS hcell FROM d)"""


@query("prj_03_healpix_cells", f"WITH {OBS}, {_healpix_sql(6)} SELECT hcell, count(*) AS n FROM hp GROUP BY hcell")
def prj_03_healpix_cells(spark, sf_dir):
    return cells.with_healpix(observed(spark, sf_dir), "lat", "lon", 6, "hcell").groupBy("hcell").agg(F.count("*").alias("n"))


@query("prj_04_rect_cells", f"WITH {CELLS} SELECT cell, count(*) AS n FROM cells GROUP BY cell")
def prj_04_rect_cells(spark, sf_dir):
    return celled(spark, sf_dir).groupBy("cell").agg(F.count("*").alias("n"))


@query("prj_14_rect_centers", f"WITH {CELLS} SELECT DISTINCT cell, -180 + (cell % 72 + 0.5) * 5 AS lon, 90 - (cell // 72 + 0.5) * 5 AS lat FROM cells")
def prj_14_rect_centers(spark, sf_dir):
    x, y = GRID.center("cell")
    return celled(spark, sf_dir).select("cell", x.alias("lon"), y.alias("lat")).distinct()


@query("prj_15_row_col", f"""WITH {CELLS}{FOUR} SELECT DISTINCT h, (h >> 1 & 1) + 2 * (h >> 3 & 1) + 4 * (h >> 5 & 1) + 8 * (h >> 7 & 1) + 16 * (h >> 9 & 1) + 32 * (h >> 11 & 1) AS r,
  (h & 1) + 2 * (h >> 2 & 1) + 4 * (h >> 4 & 1) + 8 * (h >> 6 & 1) + 16 * (h >> 8 & 1) + 32 * (h >> 10 & 1) AS c FROM marked""")  # fmt: skip
def prj_15_row_col(spark, sf_dir):
    r, c = cells.row_col("h")
    return nested(spark, sf_dir).select("h", r.alias("r"), c.alias("c")).distinct()


@query("prj_16_labels", f"""WITH {CELLS}, k AS (SELECT DISTINCT (cell * 5) % 192 AS k FROM cells) SELECT k,
  CASE WHEN k >> 4 < 6 THEN '' ELSE '-' END || CAST((k >> 4) % 6 + 1 AS VARCHAR) || CAST((k >> 2 & 3) + 1 AS VARCHAR) || CAST((k & 3) + 1 AS VARCHAR) AS label FROM k""")  # fmt: skip
def prj_16_labels(spark, sf_dir):
    return celled(spark, sf_dir).select(((F.col("cell") * 5) % 192).alias("k")).distinct().select("k", cells.label("k", 2).alias("label"))


def _filter(name: str, where: str, filters_: list[dict], expression: str | None = None) -> None:
    sql = f"SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 3) AS q FROM lineitem WHERE {where} GROUP BY l_returnflag"

    @query(name, sql)
    def run(spark, sf_dir):
        df = filters.apply(table(spark, sf_dir, "lineitem"), filters_, expression)
        return df.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 3).alias("q"))


for _name, _op, _sign in (("flt_01_eq", "eq", "="), ("flt_02_ne", "ne", "<>"), ("flt_03_ge", "ge", ">="), ("flt_04_le", "le", "<="), ("flt_05_gt", "gt", ">"), ("flt_06_lt", "lt", "<")):
    _filter(_name, f"l_linenumber {_sign} 3", [{"variable": "l_linenumber", "op": _op, "value": 3}])
_filter("flt_07_in", "l_linenumber IN (1, 4)", [{"variable": "l_linenumber", "op": "in", "values": [1, 4]}])
_filter("flt_08_not_in", "l_linenumber NOT IN (1, 4)", [{"variable": "l_linenumber", "op": "not_in", "values": [1, 4]}])
_filter("flt_09_inverted", "NOT (l_quantity > 25)", [{"variable": "l_quantity", "op": "gt", "value": 25, "keep": False}])
_filter("flt_13_expression", "l_extendedprice / l_quantity > 1500 AND l_discount <= 0.05", [], "(l_extendedprice / l_quantity > 1500) & (l_discount <= 0.05)")


@query("flt_12_cross_level", """SELECT o_orderstatus, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_totalprice > 150000 AND l_quantity < 30 GROUP BY o_orderstatus""")  # fmt: skip
def flt_12_cross_level(spark, sf_dir):
    records = filters.apply(table(spark, sf_dir, "orders"), [{"variable": "o_totalprice", "op": "gt", "value": 150000}])
    samples = filters.apply(table(spark, sf_dir, "lineitem"), [{"variable": "l_quantity", "op": "lt", "value": 30}])
    return samples.join(records, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("flt_14_sibling_filter", "SELECT count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def flt_14_sibling_filter(spark, sf_dir):
    kept = joins.sibling_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "doc_id", F.col("quality") == 1)
    return kept.agg(F.count("*").alias("n"))


@query("flt_16_time_range", "SELECT count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'")
def flt_16_time_range(spark, sf_dir):
    low, high = times.bounds(F.lit("1995"), "yearly")
    return table(spark, sf_dir, "lineitem").where((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high)).agg(F.count("*").alias("n"))


@query("flt_17_aoi_mask", f"WITH {CELLS}{FOUR} SELECT (h >= 256 AND h < 512) AS in_aoi, count(*) AS n FROM marked GROUP BY ALL")
def flt_17_aoi_mask(spark, sf_dir):
    aoi = coverage.ranges(spark.createDataFrame([(1,)], "cell long"), "cell", 0)
    return coverage.masked(nested(spark, sf_dir), "h", 4, aoi).groupBy("in_aoi").agg(F.count("*").alias("n"))


@query("flt_18_boxes", "SELECT count(*) AS n FROM (SELECT l_partkey % 360 - 180 AS x FROM lineitem) WHERE (x <= -150 AND x + 5 >= -170) OR (x <= 20 AND x + 5 >= 10)")
def flt_18_boxes(spark, sf_dir):
    x = F.col("l_partkey") % 360 - 180
    df = table(spark, sf_dir, "lineitem").select(x.alias("xmin"), (x + 5).alias("xmax"), F.lit(0).alias("ymin"), F.lit(1).alias("ymax"))
    return df.where(filters.in_boxes([(-170, 0, -150, 1), (10, 0, 20, 1)])).agg(F.count("*").alias("n"))


@query("flt_24_subtree", f"WITH {CELLS}{FOUR} SELECT h, count(*) AS n FROM marked WHERE h >> 4 = 21 GROUP BY h")
def flt_24_subtree(spark, sf_dir):
    return nested(spark, sf_dir).where(cells.is_under("h", 21, 2)).groupBy("h").agg(F.count("*").alias("n"))


def _agg(name: str, function: str, sql: str, source: str = "l_extendedprice", **params) -> None:
    @query(name, f"WITH {CELLS} SELECT cell, {sql} AS value FROM cells GROUP BY cell")
    def run(spark, sf_dir):
        dtype = "int64" if function in ("len", "count", "count_distinct", "unique_or_zero") else "float64"
        found = aggregate.by_cell(celled(spark, sf_dir), [Field("value", function, source, params=params, dtype=dtype, fill=0)], ["cell"])
        return rounded(found, 7)


_agg("agg_01_count", "len", "count(*)")
for _name, _function, _sql in (("agg_02_min", "min", "min"), ("agg_02_max", "max", "max"), ("agg_04_sum", "sum", "sum"), ("agg_05_mean", "mean", "avg"), ("agg_08_std", "std", "stddev_pop"), ("agg_09_median", "median", "median")):
    _agg(_name, _function, f"round({_sql}(l_extendedprice), 7)")
for _name, _function, _sql in (("agg_03_nanmin", "nanmin", "min"), ("agg_03_nanmax", "nanmax", "max"), ("agg_04_nansum", "nansum", "sum")):
    _agg(_name, _function, f"round({_sql}(l_quantity), 7)", "l_quantity")
_agg("agg_06_weighted_mean", "average", "round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 7)", weights="l_quantity")
_agg("agg_07_var", "var", "round(var_pop(l_quantity), 7)", "l_quantity")
_agg("agg_10_quantile", "quantile", "round(quantile_cont(l_extendedprice, 0.9), 7)", q=0.9)
_agg("agg_19_distinct_records", "count_distinct", "count(DISTINCT l_orderkey)", "l_orderkey")
_agg("agg_20_unique_or_zero", "unique_or_zero", "CASE WHEN min(l_orderkey) = max(l_orderkey) THEN min(l_orderkey) ELSE 0 END", "l_orderkey")


@query("agg_11_expression", f"WITH {CELLS} SELECT cell, round(1 / sqrt(sum(1 / (l_quantity * l_quantity))), 4) AS sigma FROM cells GROUP BY cell")
def agg_11_expression(spark, sf_dir):
    df = celled(spark, sf_dir)
    return rounded(df.groupBy("cell").agg(reduce_by("1 / sqrt(sum(1 / (l_quantity * l_quantity)))", df.columns).alias("sigma")), 4)


@query("agg_12_histogram", f"""WITH {CELLS}, b AS (SELECT cell // 72 AS r, least(floor((l_quantity - 1) * 8 / 49.0), 7) AS b FROM cells WHERE l_quantity BETWEEN 1 AND 50)
  SELECT r, array_to_string([count(*) FILTER (b = 0), count(*) FILTER (b = 1), count(*) FILTER (b = 2), count(*) FILTER (b = 3), count(*) FILTER (b = 4), count(*) FILTER (b = 5), count(*) FILTER (b = 6), count(*) FILTER (b = 7)], ',') AS histogram FROM b GROUP BY r""")  # fmt: skip
def agg_12_histogram(spark, sf_dir):
    df = celled(spark, sf_dir).withColumn("r", F.floor(F.col("cell") / 72))
    found = aggregate.histogram(df, ["r"], "l_quantity", 1, 50, 8)
    return found.select("r", F.concat_ws(",", F.transform("histogram", lambda n: n.cast("string"))).alias("histogram"))


@query("agg_13_ragged", f"WITH {CELLS} SELECT cell, array_to_string(list(CAST(l_quantity AS INT) ORDER BY l_quantity), ',') AS rows FROM cells GROUP BY cell")
def agg_13_ragged(spark, sf_dir):
    found = aggregate.ragged(celled(spark, sf_dir), ["cell"], ["l_quantity"])
    return found.select("cell", F.concat_ws(",", F.transform("rows", lambda v: v.cast("int").cast("string"))).alias("rows"))


@query("agg_15_chunk_scalars", f"""WITH {CELLS}, k AS (SELECT cell % 10 AS chunk, min(l_quantity) AS low FROM cells GROUP BY ALL)
  SELECT cell, chunk, round(avg(l_quantity) - any_value(low), 4) AS above FROM cells JOIN k ON cell % 10 = chunk GROUP BY cell, chunk""")  # fmt: skip
def agg_15_chunk_scalars(spark, sf_dir):
    df = celled(spark, sf_dir).withColumn("chunk", F.col("cell") % 10)
    field = Field("above", expression="mean(l_quantity) - low", dtype="float64")
    return rounded(aggregate.by_cell_in_chunks(df, [field], "cell", "chunk", {"low": "min(l_quantity)"}), 4)


def _scored(spark, sf_dir):
    df = nested(spark, sf_dir)
    return df, [((F.col(c) * k) % 5).cast("int") for c, k in (("l_orderkey", 1), ("l_partkey", 3), ("l_suppkey", 7), ("l_linenumber", 2), ("l_orderkey", 2))]


_S = ["(l_orderkey % 5)", "(l_partkey * 3 % 5)", "(l_suppkey * 7 % 5)", "(l_linenumber * 2 % 5)", "(l_orderkey * 2 % 5)"]
_LANES = [f"sum(CASE WHEN {s} >= 2 THEN 1 ELSE 0 END)" for s in _S] + [f"sum(CASE WHEN greatest({', '.join(_S)}) = {k} THEN 1 ELSE 0 END)" for k in (2, 3, 4)]
_BYTES = [f"CASE WHEN n = 0 OR c{i} = 0 THEN 0 ELSE greatest(CAST(round_even(255.0 * c{i} / n, 0) AS BIGINT), 1) END AS lane{i}" for i in range(8)]


@query("agg_18_composition", f"""WITH {CELLS}, s AS (SELECT cell % 50 AS g, sum(CASE WHEN greatest({', '.join(_S)}) >= 2 THEN 1 ELSE 0 END) AS n,
  {', '.join(f'{x} AS c{i}' for i, x in enumerate(_LANES))} FROM cells GROUP BY ALL) SELECT g, CAST(n AS BIGINT) AS n, {', '.join(_BYTES)} FROM s""")  # fmt: skip
def agg_18_composition(spark, sf_dir):
    df, surfaces = _scored(spark, sf_dir)
    found = df.groupBy((F.col("cell") % 50).alias("g")).agg(*packing.composition(surfaces))
    return found.select("g", "n", *[lane.alias(f"lane{i}") for i, lane in enumerate(packing.unpack("word"))])


@query("agg_23_time_envelope", f"WITH {CELLS} SELECT cell, min(l_shipdate) AS start, max(l_shipdate) AS \"end\" FROM cells GROUP BY cell")
def agg_23_time_envelope(spark, sf_dir):
    return aggregate.envelope(celled(spark, sf_dir), ["cell"], "l_shipdate")


@query("agg_24_common_ancestor", f"""WITH {CELLS}{FOUR}, e AS (SELECT l_orderkey AS k, min(h) AS lo, max(h) AS hi FROM marked GROUP BY l_orderkey)
  SELECT k, CASE WHEN lo = hi THEN 1024 + lo WHEN lo >> 2 = hi >> 2 THEN 256 + (lo >> 2) WHEN lo >> 4 = hi >> 4 THEN 64 + (lo >> 4)
  WHEN lo >> 6 = hi >> 6 THEN 16 + (lo >> 6) WHEN lo >> 8 = hi >> 8 THEN 4 + (lo >> 8) END AS ancestor FROM e""")  # fmt: skip
def agg_24_common_ancestor(spark, sf_dir):
    return nested(spark, sf_dir).groupBy(F.col("l_orderkey").alias("k")).agg(cells.common_ancestor("h", 4).alias("ancestor"))


@query("agg_27_stats_merge", """SELECT o_orderstatus AS status, count(*) AS n, round(max(o_totalprice), 2) AS peak,
  CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS priority, max(o_orderdate) AS latest, bool_and(o_totalprice > 1000) AS ok FROM orders GROUP BY ALL""")  # fmt: skip
def agg_27_stats_merge(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.lit(1).alias("n"), F.col("o_totalprice").alias("peak"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("latest"), (F.col("o_totalprice") > 1000).alias("ok"))
    return rounded(identity.merged_stats(df, ["status"], ["n"], (), ["peak"], ["priority"], "latest", "ok"), 2)


@query("agg_30_densify", f"""WITH {CELLS}{FOUR}, a AS (SELECT h, count(*) AS n, round(avg(l_quantity), 3) AS m FROM marked GROUP BY h)
  SELECT s.i AS h, s.i >> 4 AS shard, CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(m, -1) AS m FROM range(4096) s(i) LEFT JOIN a ON a.h = s.i""")  # fmt: skip
def agg_30_densify(spark, sf_dir):
    fields = [Field("n", "len", dtype="int64", fill=0), Field("m", "mean", "l_quantity", dtype="float64")]
    df = nested(spark, sf_dir).withColumn("shard", cells.coarsen("h", 2))
    shards = spark.range(256).select(F.col("id").alias("shard"))
    full = aggregate.densify(aggregate.by_cell(df, fields, ["h", "shard"]), shards, "h", "shard", 2, fields)
    return full.select("h", "shard", "n", F.round(F.nanvl("m", F.lit(-1.0)), 3).alias("m"))


def _centroids(delta: int, extra: str = "", order: str = "") -> str:
    """SQL of the centroids of l_quantity by rows of cells: the greedy k1 rule for unit weights, as jumps from first member to first member."""
    room = f"floor(n * (1 + 1e-12) * (1 + sin(pi() * (least(({delta} * (asin(2.0 * pos / n - 1) / pi() + 0.5) + 1) / {delta}, 1.0) - 0.5))) / 2)"
    return f"""WITH RECURSIVE {CELLS}, g AS (SELECT cell // 72 AS r, count(*) AS n FROM cells GROUP BY ALL),
  j(r, n, i, pos) AS (SELECT r, n, 0, CAST(0 AS BIGINT) FROM g UNION ALL SELECT r, n, i + 1, greatest(pos + 1, least(n, CAST({room} AS BIGINT))) FROM j WHERE pos < n),
  spans AS (SELECT * FROM (SELECT r, i, pos, lead(pos) OVER (PARTITION BY r ORDER BY i) AS stop FROM j) WHERE stop IS NOT NULL),
  v AS (SELECT *, cell // 72 AS r, row_number() OVER (PARTITION BY cell // 72 ORDER BY l_quantity{order}) - 1 AS p FROM cells)
  SELECT v.r, i, round(CAST(CAST(avg(l_quantity) AS FLOAT) AS DOUBLE), 3) AS mean, count(*) AS weight{extra} FROM v JOIN spans ON v.r = spans.r AND p >= pos AND p < stop GROUP BY ALL"""


def _listed(found: DataFrame, *extra: str) -> DataFrame:
    each = found.select("r", F.posexplode("digest").alias("i", "c"))
    return each.select("r", "i", F.round(F.col("c.mean").cast("double"), 3).alias("mean"), F.col("c.weight").cast("long").alias("weight"), *[F.col(f"c.{e}").alias(e) for e in extra])


def _by_row(spark, sf_dir) -> DataFrame:
    return celled(spark, sf_dir).withColumn("r", F.floor(F.col("cell") / 72))


@query("sk_03_tdigest_centroids", _centroids(64))
def sk_03_tdigest_centroids(spark, sf_dir):
    """Digests with loss: every centroid, over all rows."""
    return _listed(sketch.build(_by_row(spark, sf_dir), ["r"], "l_quantity", 64))


@query("sk_09_companions", _centroids(32, ", min(cell) AS low, max(cell) AS high, epoch_us(min(l_shipdate)) AS start, epoch_us(max(l_shipdate)) AS \"end\"", ", cell, l_shipdate"))
def sk_09_companions(spark, sf_dir):
    df = _by_row(spark, sf_dir).withColumn("__us", times.micros("l_shipdate"))
    return _listed(sketch.build(df, ["r"], "l_quantity", 32, location="cell", time="__us"), "low", "high", "start", "end")


_QS = {"q10": 0.1, "q50": 0.5, "q90": 0.9}


@query("sk_07_tdigest_quantile", f"WITH {CELLS}, g AS (SELECT cell // 72 AS r, list_sort(list(l_quantity)) AS x, count(*) AS n FROM cells GROUP BY ALL) SELECT r, n, "
  + ", ".join(f"x[CAST(ceil({q} * (n - 1)) AS BIGINT) + 1] AS {name}" for name, q in _QS.items()) + " FROM g")
def sk_07_tdigest_quantile(spark, sf_dir):
    """Quantiles of digests merged from those of cells, without loss."""
    merged = sketch.fold(sketch.build(_by_row(spark, sf_dir), ["r", "cell"], "l_quantity", 1_000_000), ["r"], delta=1_000_000)
    weight = F.aggregate("digest", F.lit(0.0), lambda a, c: a + c["weight"].cast("double"))
    return sketch.quantiles(merged.withColumn("n", F.round(weight).cast("long")), "digest", _QS).drop("digest")


@query("sk_04_pairwise_merge", f"WITH {CELLS} SELECT cell // 72 AS r, count(*) AS n, round(avg(l_quantity) + 0.0013, 2) AS mean FROM cells GROUP BY ALL")
def sk_04_pairwise_merge(spark, sf_dir):
    """Weights and sums go through merges two by two."""
    merged = sketch.fold(sketch.build(_by_row(spark, sf_dir), ["r", "cell"], "l_quantity", 64), ["r"], delta=64, order="cell")
    parts = [F.aggregate("digest", F.lit(0.0), lambda a, c: a + c["weight"].cast("double")), F.aggregate("digest", F.lit(0.0), lambda a, c: a + c["mean"].cast("double") * c["weight"].cast("double"))]
    return merged.select("r", F.round(parts[0]).cast("long").alias("n"), F.round(parts[1] / parts[0] + 0.0013, 2).alias("mean"))


_EDGES = [0.0, 10.0, 20.0, 30.0, 40.0, 60.0]


@query("sk_11_rasterize", f"""WITH {CELLS}, e AS (SELECT unnest({_EDGES}) AS e, unnest(range({len(_EDGES)})) AS k),
  c AS (SELECT cell // 72 AS r, k, e, count(*) AS n, count(*) FILTER (l_quantity <= e) AS i, max(l_quantity) FILTER (l_quantity <= e) AS lo, min(l_quantity) FILTER (l_quantity > e) AS hi FROM cells, e GROUP BY ALL),
  f AS (SELECT r, k, CASE WHEN i = 0 THEN 0 WHEN hi IS NULL THEN CASE WHEN lo = e THEN n - 0.5 ELSE n END ELSE i - 0.5 + (e - lo) / (hi - lo) END AS f FROM c)
  SELECT r, k, round(next - f, 6) AS weight FROM (SELECT r, k, f, lead(f) OVER (PARTITION BY r ORDER BY k) AS next FROM f) WHERE next IS NOT NULL""")  # fmt: skip
def sk_11_rasterize(spark, sf_dir):
    found = sketch.rasterized(sketch.build(_by_row(spark, sf_dir), ["r"], "l_quantity", 1_000_000), "digest", _EDGES)
    return found.select("r", F.posexplode("bins").alias("k", "weight")).select("r", F.col("k").cast("long").alias("k"), F.round("weight", 6).alias("weight"))


_PYR = {"n": "len", "low": "min", "high": "max", "total": "sum"}
_PYR_FIELDS = [Field("n", "len", dtype="int64"), Field("low", "min", "l_quantity", dtype="float64"), Field("high", "max", "l_quantity", dtype="float64"), Field("total", "sum", "l_quantity", dtype="float64")]


@query("pyr_02_fold", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS h, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, round(sum(l_quantity), 3) AS total FROM marked GROUP BY ALL")
def pyr_02_fold(spark, sf_dir):
    return rounded(pyramid.fold(aggregate.by_cell(nested(spark, sf_dir), _PYR_FIELDS, ["h"]), "h", 2, _PYR))


@query("pyr_08_column", " UNION ALL ".join(f"SELECT {o} AS \"order\", h >> {2 * (4 - o)} AS h, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, round(sum(l_quantity), 3) AS total FROM (WITH {CELLS}{FOUR} SELECT * FROM marked) GROUP BY ALL" for o in (3, 2, 0)))
def pyr_08_column(spark, sf_dir):
    return rounded(pyramid.column(aggregate.by_cell(nested(spark, sf_dir), _PYR_FIELDS, ["h"]), "h", 4, [3, 2, 0], _PYR))


@query("pyr_13_all_time", f"WITH {CELLS}{FOUR} SELECT h >> 2 AS h, count(*) AS n FROM marked GROUP BY ALL")
def pyr_13_all_time(spark, sf_dir):
    df = nested(spark, sf_dir).withColumn("window", times.label("l_shipdate", "yearly"))
    return pyramid.fold(aggregate.by_cell(df, _PYR_FIELDS[:1], ["h", "window"]), "h", 1, {"n": "len"})


@query("pyr_16_incremental", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS h, count(*) AS n FROM marked GROUP BY ALL")
def pyr_16_incremental(spark, sf_dir):
    """A level kept up to date by folding only the ancestors of changed cells equals one folded anew."""
    df = nested(spark, sf_dir)
    old = aggregate.by_cell(df.where("l_shipdate < '1996-01-01'"), _PYR_FIELDS[:1], ["h"])
    new = aggregate.by_cell(df, _PYR_FIELDS[:1], ["h"])
    changed = df.where("l_shipdate >= '1996-01-01'").select("h").distinct()
    return pyramid.refreshed(pyramid.fold(old, "h", 2, {"n": "len"}), new, changed, "h", 2, {"n": "len"})


@query("win_01_first_of_run", """SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS r FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE r = 1 OR p <> event_type""")  # fmt: skip
def win_01_first_of_run(spark, sf_dir):
    return readplan.first_of_run(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type")


@query("win_02_runs", """WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice > 200000 AS want, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
  s AS (SELECT *, want AND NOT coalesce(lag(want) OVER w, false) OR NOT want AND coalesce(lag(want) OVER w, false) AS new FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY i)),
  g AS (SELECT *, sum(new::INT) OVER (PARTITION BY o_custkey ORDER BY i) AS run FROM s),
  p AS (SELECT o_custkey, run, min(i) AS start, max(i) + 1 AS stop, any_value(total) AS total FROM g WHERE want GROUP BY ALL),
  f AS (SELECT *, sum(stop - start) OVER (PARTITION BY o_custkey) > 0.9 * total AS whole FROM p)
  SELECT o_custkey, start, stop FROM f WHERE NOT whole UNION ALL SELECT o_custkey, 0, any_value(total) FROM f WHERE whole GROUP BY o_custkey""")  # fmt: skip
def win_02_runs(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    records = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_totalprice") > 200000).alias("want"), (F.row_number().over(w) - 1).cast("long").alias("i"), F.lit(1).cast("long").alias("count"))
    return readplan.slices(records, ["o_custkey"], "i", "want", "i", "count")


@query("src_11_chunk_boundaries", "SELECT user_id % 10 AS grp, event_id // 512 AS chunk, min(event_id) AS elem_start, max(event_id) + 1 AS elem_end FROM events GROUP BY ALL")
def src_11_chunk_boundaries(spark, sf_dir):
    df = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("grp"), "event_id", F.col("value").alias("lat"), F.col("value").alias("lon"))
    return readplan.chunk_boundaries(df, ["grp"], "event_id", "lat", "lon", 512).select("grp", "chunk", "elem_start", "elem_end")


@query("src_07_waveform_samples", """SELECT l_orderkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY l_orderkey""")
def src_07_waveform_samples(spark, sf_dir):
    records = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_quantity")).alias("samples"))
    own = records.join(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    each = joins.explode_samples(own, "samples")
    return rounded(each.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query("prj_07_linspace", "SELECT l_orderkey, l_linenumber, round(1.0 + 8.0 * (l_linenumber - 1) / greatest(count(*) OVER (PARTITION BY l_orderkey) - 1, 1), 6) AS z FROM lineitem")
def prj_07_linspace(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.lit(1.0).alias("a"), F.lit(9.0).alias("b"), (F.col("l_linenumber") - 1).alias("i"), F.count("*").over(Window.partitionBy("l_orderkey")).alias("n"))
    return df.select("l_orderkey", "l_linenumber", F.round(joins.linspace("a", "b", "i", "n"), 6).alias("z"))


@query("jon_01_sibling_left", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.doc_id IS NOT NULL AS matched FROM documents d LEFT JOIN labels l USING (doc_id)")
def jon_01_sibling_left(spark, sf_dir):
    out = joins.sibling(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", "doc_id", {"quality": "quality"})
    return out.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), "matched")


@query("jon_03_sibling_pairs", "SELECT regexp_extract(c_name, '([0-9]+)$', 1) AS key, c_name AS left_name, s_name AS right_name FROM customer JOIN supplier ON regexp_extract(c_name, '([0-9]+)$', 1) = regexp_extract(s_name, '([0-9]+)$', 1)")
def jon_03_sibling_pairs(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return joins.pair_assets(a, b, "([0-9]+)$", 1)[0]


@query("jon_04_interval_join", "SELECT o_orderkey, count(*) AS n FROM orders JOIN events ON event_id >= o_orderkey * 3 AND event_id < o_orderkey * 3 + 5 GROUP BY o_orderkey")
def jon_04_interval_join(spark, sf_dir):
    spans = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * 3).alias("low"), (F.col("o_orderkey") * 3 + 5).alias("high"))
    return joins.interval_join(table(spark, sf_dir, "events"), spans, "event_id", "low", "high", 256).groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query("jon_05_shard_map", f"WITH {CELLS}{FOUR} SELECT h >> 4 AS shard, count(DISTINCT l_suppkey) AS n, min(l_suppkey) AS first FROM marked GROUP BY ALL")
def jon_05_shard_map(spark, sf_dir):
    prints = nested(spark, sf_dir).select(F.col("l_suppkey").alias("id"), F.col("h").alias("cell"))
    shards = prints.select(cells.coarsen("cell", 2).alias("shard")).distinct()
    return catalog.shard_map(prints, shards, 2).select("shard", F.size("granules").cast("long").alias("n"), F.get("granules", F.lit(0)).alias("first"))


@query("pyr_19_reproject", f"WITH {CELLS}{FOUR} SELECT h >> 6 AS shard, count(DISTINCT l_suppkey) AS n FROM marked GROUP BY ALL")
def pyr_19_reproject(spark, sf_dir):
    prints = nested(spark, sf_dir).select(F.col("l_suppkey").alias("id"), F.col("h").alias("cell"))
    mapped = catalog.shard_map(prints, prints.select(cells.coarsen("cell", 2).alias("shard")).distinct(), 2)
    return catalog.reprojected(mapped, 1).select("shard", F.size("granules").cast("long").alias("n"))


@query("win_06_densest", f"WITH {CELLS}{FOUR}, s AS (SELECT h >> 6 AS shard, count(DISTINCT l_suppkey) AS n FROM marked GROUP BY ALL) SELECT shard, CAST(n AS INT) AS n, CAST(row_number() OVER (ORDER BY n DESC, shard) AS INT) AS rank FROM s")
def win_06_densest(spark, sf_dir):
    prints = nested(spark, sf_dir).select(F.col("l_suppkey").alias("id"), F.col("h").alias("cell"))
    return catalog.densest(catalog.shard_map(prints, prints.select(cells.coarsen("cell", 3).alias("shard")).distinct(), 3))


@query("jon_10_monthly_anomaly", """WITH c AS (SELECT month(ts) AS m, user_id % 20 AS k, avg(value) AS mean FROM events GROUP BY ALL)
  SELECT event_id, round(value - mean, 4) AS value FROM events JOIN c ON m = month(ts) AND k = user_id % 20""")  # fmt: skip
def jon_10_monthly_anomaly(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "value", (F.col("user_id") % 20).alias("k"))
    clim = df.groupBy(F.month("ts").alias("month"), "k").agg(F.avg("value").alias("mean"))
    return joins.monthly_anomaly(df, clim, "value", "ts", ["k"]).select("event_id", F.round("value", 4).alias("value"))


@query("jon_12_windows", """SELECT w.label, count(*) AS n FROM lineitem JOIN (VALUES ('early', TIMESTAMP '1992-01-01', TIMESTAMP '1994-06-01'), ('late', TIMESTAMP '1996-02-01', TIMESTAMP '1998-01-01')) w(label, a, b)
  ON l_shipdate >= a AND l_shipdate < b GROUP BY w.label""")  # fmt: skip
def jon_12_windows(spark, sf_dir):
    w = times.explicit_windows(spark, [("early", "1992-01-01", "1994-06-01"), ("late", "1996-02-01", "1998-01-01")])
    return times.in_windows(table(spark, sf_dir, "lineitem"), "l_shipdate", w).groupBy("label").agg(F.count("*").alias("n"))


_SETS = "a AS (SELECT DISTINCT c_custkey % 700 AS cell FROM customer), b AS (SELECT DISTINCT s_suppkey * 7 % 3000 AS cell FROM supplier)"


def _sets(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 700).alias("cell")).distinct()
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 7 % 3000).alias("cell")).distinct()
    return coverage.ranges(a, "cell", 4), coverage.ranges(b, "cell", 4)


@query("set_01_moc_union", f"WITH {_SETS} SELECT cell FROM a UNION SELECT cell FROM b")
def set_01_moc_union(spark, sf_dir):
    return coverage.to_order(coverage.union(*_sets(spark, sf_dir)), 4)


@query("set_02_moc_intersection", f"WITH {_SETS} SELECT cell FROM a INTERSECT SELECT cell FROM b")
def set_02_moc_intersection(spark, sf_dir):
    return coverage.to_order(coverage.intersection(*_sets(spark, sf_dir)), 4)


@query("set_03_moc_difference", f"WITH {_SETS} SELECT cell FROM a EXCEPT SELECT cell FROM b")
def set_03_moc_difference(spark, sf_dir):
    return coverage.to_order(coverage.difference(*_sets(spark, sf_dir)), 4)


@query("set_04_moc_compaction", f"""WITH {_SETS}, l3 AS (SELECT cell >> 2 AS cell FROM a GROUP BY ALL HAVING count(*) = 4), l2 AS (SELECT cell >> 2 AS cell FROM l3 GROUP BY ALL HAVING count(*) = 4)
  SELECT CAST(4 AS INT) AS "order", cell FROM a WHERE cell >> 2 NOT IN (SELECT cell FROM l3) UNION ALL SELECT 3, cell FROM l3 WHERE cell >> 2 NOT IN (SELECT cell FROM l2) UNION ALL SELECT 2, cell FROM l2""")  # fmt: skip
def set_04_moc_compaction(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 700).alias("cell"))
    return coverage.compacted(a, "cell", 4, 2)


@query("cov_02_bitmap", f"WITH {CELLS}{FOUR}, s AS (SELECT DISTINCT h >> 4 AS shard, h FROM marked) SELECT shard, string_agg(CASE WHEN EXISTS (SELECT 1 FROM s t WHERE t.h = s2.shard * 16 + i) THEN '1' ELSE '0' END, '' ORDER BY i) AS bitmap FROM (SELECT DISTINCT shard FROM s) s2, range(16) r(i) GROUP BY shard")
def cov_02_bitmap(spark, sf_dir):
    return coverage.bitmap(nested(spark, sf_dir).withColumn("shard", cells.coarsen("h", 2)), "shard", "h", 2).select("shard", "bitmap")


@query("tmp_01_monthly", "SELECT strftime(l_shipdate, '%Y%m') AS label, count(*) AS n FROM lineitem GROUP BY ALL")
def tmp_01_monthly(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(times.label("l_shipdate", "monthly").alias("label")).agg(F.count("*").alias("n"))


@query("tmp_04_windows_of_span", "SELECT CAST(year(o_orderdate) + i AS VARCHAR) AS label, count(*) AS n FROM orders, range(2) r(i) WHERE year(o_orderdate + INTERVAL 200 DAY) >= year(o_orderdate) + i GROUP BY ALL")
def tmp_04_windows_of_span(spark, sf_dir):
    labels = times.windows_of_span(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 200 DAY"), "yearly")
    return table(spark, sf_dir, "orders").select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query("tmp_06_resample", "SELECT time_bucket(INTERVAL 3 HOUR, ts) AS t, round(sum(value * 2), 3) AS value FROM events GROUP BY ALL")
def tmp_06_resample(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(F.col("ts").alias("t"), "value", F.lit(0).alias("k"))
    return rounded(events.prepared(df, scale={"value": 2.0}, resample=("3 hours", "sum"), keys=("k",), values=("value",)).select("t", "value"))


def _event_cells(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return df.select((F.col("user_id") % 30).alias("event"), F.date_trunc("day", "ts").alias("t"), F.col("value").alias("x"), (F.col("event_type") != "click").cast("int").alias("mask"), ((F.col("user_id") % 3) + 1).cast("double").alias("area"), (F.col("event_id") % 4 == 0).cast("int").alias("static"))


_EV = "ev AS (SELECT user_id % 30 AS event, date_trunc('day', ts) AS t, value AS x, CAST(event_type <> 'click' AS INT) AS mask, user_id % 3 + 1.0 AS area, CAST(event_id % 4 = 0 AS INT) AS static FROM events)"


def _event(name: str, spatial: str, reducer: str, steps: str, final: str) -> None:
    @query(name, f"WITH {_EV}, st AS (SELECT event, t, {steps} FROM ev GROUP BY event, t) SELECT event, round(coalesce({final}, -1), 6) AS value FROM st GROUP BY event")
    def run(spark, sf_dir):
        found = events.reduced(events.timesteps(_event_cells(spark, sf_dir), spatial, "x", "mask", "area"), reducer, "value")
        return found.select("event", F.round(F.nanvl("value", F.lit(-1.0)), 6).alias("value"))


_event("evt_01_max_of_max", "max", "max", "max(x) FILTER (mask > 0) AS v", "max(v)")
_event("evt_01_min_of_min", "min", "min", "min(x) FILTER (mask > 0) AS v", "min(v)")
_event("evt_02_weighted_sum", "weighted_sum", "sum", "sum(x * mask * area) AS v", "sum(v)")
_event("evt_07_weighted_mean", "weighted_mean", "weighted_mean", "sum(x * mask * area) AS ws, sum(mask * area) AS w", "CASE WHEN sum(w) > 0 THEN sum(ws) / sum(w) END")
_event("evt_08_mean_of_ratios", "weighted_mean", "mean_of_ratios", "sum(x * mask * area) AS ws, sum(mask * area) AS w", "avg(CASE WHEN w > 0 THEN ws / w END)")
_event("evt_09_first_landfall", "max", "first_landfall", "max(x) FILTER (mask > 0) AS v", "arg_min(v, t) FILTER (v IS NOT NULL)")


@query("evt_12_trigger", f"WITH {_EV}, f AS (SELECT event, min(t) AS first FROM ev WHERE mask > 0 AND static > 0 GROUP BY event) SELECT event, count(*) AS n FROM ev JOIN f USING (event) WHERE t = first GROUP BY event")
def evt_12_trigger(spark, sf_dir):
    return events.triggered(_event_cells(spark, sf_dir), "static").groupBy("event").agg(F.count("*").alias("n"))


@query("prj_18_pixel_sample", f"WITH {OBS}, p AS (SELECT CAST(floor((lon + 180) / 10) AS BIGINT) AS col, CAST(floor((90 - lat) / 10) AS BIGINT) AS row FROM obs) SELECT row, col, count(*) AS n FROM p WHERE row < 18 AND (row + col) % 3 <> 0 GROUP BY ALL")
def prj_18_pixel_sample(spark, sf_dir):
    pixels = spark.range(18 * 36).select(F.floor(F.col("id") / 36).alias("row"), (F.col("id") % 36).alias("col"))
    pixels = pixels.withColumn("value", (F.col("row") + F.col("col")) % 3)
    got = raster.sample(observed(spark, sf_dir), pixels, (10.0, 0.0, -180.0, 0.0, -10.0, 90.0), 18, 36, "lon", "lat", nodata=0)
    return got.groupBy("row", "col").agg(F.count("*").alias("n"))


@query("prj_19_owner", "SELECT s_nationkey AS cell, arg_min(s_suppkey, s_suppkey % 7 * 10000 + s_suppkey) AS item FROM supplier GROUP BY ALL")
def prj_19_owner(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("cell"), F.col("s_acctbal").alias("value"), (F.col("s_suppkey") % 7).alias("distance"), F.col("s_suppkey").alias("item"))
    return raster.owned(df, ["cell"], "value", "distance", "item").select("cell", "item")


@query("prj_11_nanoseconds", "SELECT l_orderkey, l_linenumber, CAST(1262304000 - 0 + floor(l_extendedprice) AS BIGINT) * 1000000000 + CAST(round_even((l_extendedprice - floor(l_extendedprice)) * 1e9, 0) AS BIGINT) - 37 * CAST(1000000000 AS BIGINT) AS ns FROM lineitem")
def prj_11_nanoseconds(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", times.to_nanoseconds("l_extendedprice", "2010-01-01T00:00:00Z", "tai").alias("ns"))


@query("idn_03_verdicts", """WITH p AS (SELECT DISTINCT o_custkey % 40 AS shard, o_orderkey % 200 AS g FROM orders WHERE o_orderkey % 3 > 0), r AS (SELECT DISTINCT o_custkey % 40 AS shard, o_orderkey % 200 AS g FROM orders WHERE o_custkey % 40 < 30 AND o_orderkey % 3 = 1),
  b AS (SELECT coalesce(p.shard, r.shard) AS shard, count(*) FILTER (p.g IS NULL) AS missing, count(*) FILTER (r.g IS NULL) AS added, count(r.g) AS recorded, count(p.g) AS planned FROM p FULL JOIN r ON p.shard = r.shard AND p.g = r.g GROUP BY ALL)
  SELECT shard, missing, added, CASE WHEN recorded = 0 THEN 'write' WHEN missing = 0 AND added = 0 THEN 'skip' WHEN missing > 0 THEN 'refuse' ELSE 'rewrite' END AS verdict FROM b WHERE planned > 0""")  # fmt: skip
def idn_03_verdicts(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("shard"), (F.col("o_orderkey") % 200).alias("granule"), "o_orderkey")
    planned, recorded = df.where("o_orderkey % 3 > 0"), df.where("shard < 30 and o_orderkey % 3 = 1")
    return identity.verdicts(planned, recorded)


@query("idn_05_input_hashes", "SELECT o_custkey % 40 AS shard, sha256(string_agg(DISTINCT CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY CAST(o_orderkey AS VARCHAR))) AS inputs FROM orders GROUP BY ALL")
def idn_05_input_hashes(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("shard"), F.col("o_orderkey").alias("granule"))
    return identity.input_hashes(df)


@query("str_01_merged_partials", f"WITH {CELLS} SELECT cell, count(*) AS n, round(sum(l_quantity), 3) AS total FROM cells GROUP BY cell")
def str_01_merged_partials(spark, sf_dir):
    """Blocks aggregated apart and merged equal one aggregation."""
    fields = [Field("n", "len", dtype="int64"), Field("total", "sum", "l_quantity", dtype="float64")]
    df = celled(spark, sf_dir)
    parts = [aggregate.by_cell(df.where(F.col("l_linenumber") % 3 == k), fields, ["cell"]) for k in range(3)]
    return rounded(pyramid.merged_partials(parts, ["cell"], {"n": "len", "total": "sum"}))
