"""Grid functions and operators against numpy or plain Python."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from cellstrata.functions import cells, expressions, packing, tdigest, times
from cellstrata.operators import aggregate, coverage, events, filters, footprints, identity, joins, pyramid, readplan, sketch, sweep
from cellstrata.operators.aggregate import Field
from cellstrata.plans import compile as plan
from cellstrata.plans import registry, spec
from cellstrata.sources import catalog, store, tables
from cellstrata.sources.tables import ManifestMismatch
from cellstrata.streaming import micro_batch


@pytest.mark.parametrize("order", [0, 1, 6, 15])
def test_healpix_centres_round_trip(spark, order):
    n = 12 << (2 * order)
    ids = sorted(set(random.Random(order).sample(range(n), min(n, 400))))
    df = cells.with_center(spark.createDataFrame([(i,) for i in ids], "id long"), "id", order)
    assert cells.with_healpix(df, "lat", "lon", order).where("cell <> id or cell is null").count() == 0


def test_healpix_nests(spark):
    r = random.Random(0)
    df = spark.createDataFrame([(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 360)) for _ in range(500)], "lat double, lon double")
    both = cells.with_healpix(cells.with_healpix(df, "lat", "lon", 12, "fine"), "lat", "lon", 5, "coarse")
    assert both.where(cells.coarsen("fine", 7) != F.col("coarse")).count() == 0
    assert cells.with_healpix(spark.createDataFrame([(float("nan"), 1.0), (None, 2.0)], "lat double, lon double"), "lat", "lon", 3).where("cell is not null").count() == 0


def test_labels_and_ancestors(spark):
    df = spark.range(192).withColumn("label", cells.label("id", 2))
    assert df.where(cells.from_label("label") != F.col("id")).count() == 0
    row = spark.createDataFrame([(21,), (22,), (20,)], "id long").agg(cells.common_ancestor("id", 2).alias("a")).first()
    assert row.a == 16 + 5


def test_rect_grid(spark):
    g = cells.RectGrid(0, 0, 10, 10, 3, 3, 2, 2)
    assert (g.width, g.height) == (4, 4)
    got = {(r.x, r.y): r.c for r in spark.createDataFrame([(0.0, 10.0), (-0.1, 5.0), (11.9, -1.9), (12.0, 5.0)], "x double, y double").withColumn("c", g.cell("x", "y")).collect()}
    assert got == {(0.0, 10.0): 0, (-0.1, 5.0): -1, (11.9, -1.9): 15, (12.0, 5.0): -1}


def test_projections(spark):
    df = spark.createDataFrame([(-71.0, 0.0, 10.0, 9.0)], "lat double, lon double, a double, b double")
    x, y = cells.project("EPSG:3031", "lat", "lon")
    ux, uy = cells.project("EPSG:32632", "a", "b")
    r = df.select(x.alias("x"), y.alias("y"), ux.alias("ux"), uy.alias("uy")).first()
    assert r.x == pytest.approx(0, abs=1e-6) and r.y == pytest.approx(2082760.1, abs=1)
    assert r.ux == pytest.approx(500000, abs=1e-3) and r.uy == pytest.approx(1105410, abs=600)
    with pytest.raises(ValueError):
        cells.project("EPSG:2154", "lat", "lon")


def test_times(spark):
    df = spark.createDataFrame([(0.25, 1.5)], "s double, d double")
    r = df.select(times.to_nanoseconds("s", "2019-05-14T02:11:07Z").alias("a"), times.to_nanoseconds("d", "2018-01-01", "gps", "days").alias("b"), times.to_nanoseconds("s", "1980-01-06", "gps").alias("c")).first()
    assert r.a == 1557799867_250000000 and r.b == 1514764800_000000000 + 129600_000000000 and r.c == (315964800 - 18) * 10**9 + 250000000
    assert times.from_datetime(times.parse("2018-01-02"), "2018-01-01", "utc", "days") == 1.0
    with pytest.raises(ValueError):
        times.label("t", "quarterly")
    with pytest.raises(ValueError):
        times.explicit_windows(spark, [("a/b", "2020-01-01", None)])


REDUCERS = {"min": np.min, "max": np.max, "mean": np.mean, "var": np.var, "std": np.std, "median": np.median, "nanmin": np.nanmin, "nanmax": np.nanmax, "nanmean": np.nanmean, "nansum": np.nansum, "nanvar": np.nanvar, "nanmedian": np.nanmedian}


@pytest.mark.filterwarnings("ignore")
def test_reducers_follow_numpy(spark):
    groups = {1: [1.0, 2.0, 4.0], 2: [1.0, math.nan, 3.0], 3: [5.0], 4: [math.nan, math.nan], 5: [-1.5, 8.0, 2.5, 2.5]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "cell long, x double")
    found = aggregate.by_cell(df, [Field(n, n, "x", dtype="float64") for n in REDUCERS] + [Field("n", "len", dtype="int64")], ["cell"])
    for r in found.collect():
        assert r.n == len(groups[r.cell])
        for n, f in REDUCERS.items():
            want = float(f(np.array(groups[r.cell])))
            assert r[n] == pytest.approx(want, nan_ok=True), (n, r.cell)


def test_integer_fields_refuse_fractions(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "cell long, x double")
    with pytest.raises(Exception, match="not integral"):
        aggregate.by_cell(df, [Field("m", "mean", "x", dtype="int32", fill=0)], ["cell"]).collect()


@pytest.mark.parametrize("text", ["__import__('os')", "x.mean()", "[x for x in y]", "eval('x')", "x if y else x", "lambda: x", "open(x)", "sum(sum(x))"])
def test_expressions_refuse_the_rest(text):
    with pytest.raises(expressions.ExpressionError):
        expressions.aggregate(text, ["x", "y"])


def test_filters(spark):
    df = spark.createDataFrame([(1, [0, 4]), (None, [3, 1]), (3, [2, 2])], "v int, conf array<int>")
    keep = lambda **f: [r.v for r in filters.apply(df, [{"variable": "v", **f}]).collect()]
    assert keep(op="ne", value=1) == [None, 3] and keep(op="gt", value=0, keep=False) == [None] and keep(op="not_in", values=[3]) == [1, None]
    assert [r.v for r in filters.apply(df, [{"variable": "conf", "op": "ge", "value": 2, "column": 1}]).collect()] == [1, 3]
    assert [r.v for r in filters.apply(df, quality_filter={"dataset": "v", "value": 3}).collect()] == [3]
    with pytest.raises(ValueError):
        filters.predicate({"variable": "v", "op": "like", "value": 1})


def test_sibling_keys_are_unique(spark):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    right = spark.createDataFrame([(1, 0.5), (3, 0.7)], "k long, z double")
    got = {r.k: (r.z, r.matched) for r in joins.sibling(left, right, "k", "k", {"z": "z"}).collect()}
    assert got[1] == (0.5, True) and math.isnan(got[2][0]) and not got[2][1]
    with pytest.raises(Exception, match="repeats a key"):
        joins.sibling(left, right.union(right), "k", "k", {"z": "z"}).collect()


def test_read_slices(spark):
    rows = [(1, i, i in (3, 4, 9), 1 + 10 * i if i != 5 else 0, 10 if i != 5 else 0) for i in range(20)]
    df = spark.createDataFrame(rows, "g long, i long, want boolean, beg long, cnt long")
    got = sorted((r.start, r.stop) for r in readplan.slices(df, ["g"], "i", "want", "beg", "cnt", base=1, pad=1).collect())
    assert got == [(20, 50), (80, 110)]
    every = readplan.slices(df.withColumn("want", F.col("i") != 19), ["g"], "i", "want", "beg", "cnt", base=1)
    assert [(r.start, r.stop) for r in every.collect()] == [(0, 190)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=300), st.sampled_from([16, 64]))
def test_digest_invariants(values, delta):
    d = tdigest.build(values, delta=delta)
    assert d[:, 1].sum() == len(values) and (np.diff(d[:, 0]) >= 0).all()
    if len(values) <= delta:
        assert len(d) == len(values)
    parts = [tdigest.build(values[k::3], delta=delta) for k in range(3)]
    assert np.array_equal(tdigest.merge(parts, delta), tdigest.merge(parts[::-1], delta))
    assert tdigest.merge([d]).tolist() == d.tolist()


def test_digest_quantiles():
    x = np.random.default_rng(0).normal(size=20_000)
    d = tdigest.build(x, delta=200)
    for q in (0.01, 0.25, 0.5, 0.9, 0.999):
        assert abs((x <= tdigest.quantile(d, q)).mean() - q) < 0.01
    assert tdigest.rasterize(d, [-9, 0, 9]).sum() == pytest.approx(20_000) and math.isnan(tdigest.quantile(tdigest.EMPTY, 0.5))


def test_digest_columns(spark):
    df = spark.createDataFrame([(k % 3, float(k)) for k in range(90)] + [(5, math.nan), (5, math.inf)], "cell long, x double")
    built = sketch.quantiles(sketch.build(df, ["cell"], "x", 16), "digest", {"m": 0.5})
    got = {r.cell: (sum(c.weight for c in r.digest), r.m) for r in built.collect()}
    assert got[0][0] == 30 and abs(got[0][1] - 43.5) < 3 and got[5][0] == 0 and math.isnan(got[5][1])
    one = sketch.fold(built.drop("m").withColumn("up", F.lit(0)), ["up"], delta=16).first()
    assert sum(c.weight for c in one.digest) == 90


def test_composition_golden(spark):
    df = spark.createDataFrame([(1, 4, 4, 4, 4, 4), (2, -2, 0, 1, 1, 0)], "g int, a int, b int, c int, d int, e int")
    got = {r.g: (r.word, r.n) for r in df.groupBy("g").agg(*packing.composition([F.col(c) for c in "abcde"])).collect()}
    assert got[1][0] & (2**64 - 1) == 0xFF0000FFFFFFFFFF and got[2] == (0, 0)
    half = spark.createDataFrame([(1, 255, 1), (1, 0, 1)], "g int, word long, n long").groupBy("g").agg(*packing.merge_compositions("word", "n")).first()
    assert (half.word, half.n) == (128, 2)


def test_noise():
    assert packing.noise_sigmas(1, 1, 0.05) == pytest.approx(1.6449, abs=1e-3)
    assert packing.noise_sigmas(100, 1, 0.05) > 3


def test_pyramid_laws(spark):
    df = spark.createDataFrame([(0, 1, math.nan), (1, -9, 2.0), (4, -9, math.nan), (5, -9, math.nan)], "cell long, n int, x double")
    got = {r.cell: r for r in pyramid.fold(df, "cell", 1, {"n": "len", "x": "max"}, {"n": -9}).collect()}
    assert (got[0].n, got[0].x) == (1, 2.0) and got[1].n == -9 and math.isnan(got[1].x)
    assert pyramid.law_class("mean") == "none" and pyramid.ladder(3, [6, 5]) == [(3, [6, 5]), (2, [4]), (1, [3]), (0, [2])]


def test_ranges(spark):
    r = random.Random(8)
    a, b = ({r.randrange(768) for _ in range(300)} for _ in range(2))
    frame = lambda s: coverage.ranges(spark.createDataFrame([(x,) for x in s], "cell long"), "cell", 3)
    back = lambda m: {x.cell for x in coverage.to_order(m, 3).collect()}
    assert back(coverage.union(frame(a), frame(b))) == a | b
    assert back(coverage.intersection(frame(a), frame(b))) == a & b
    assert back(coverage.difference(frame(a), frame(b))) == a - b
    mixed = {(x.order, x.cell) for x in coverage.compacted(spark.createDataFrame([(x,) for x in a], "cell long"), "cell", 3).collect()}
    assert {c << 2 * (3 - o) | k for o, c in mixed for k in range(4 ** (3 - o))} == a


def test_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    df = spark.createDataFrame([(2.0, 0.5), (2.0, 3.0), (0.5, 2.0), (5.0, 1.0)], "x double, y double")
    assert [r.i for r in df.select(coverage.in_polygon("x", "y", ring).alias("i")).collect()] == [True, False, True, False]


def test_events(spark):
    rows = [(1, t, x, m, 2.0) for t, x, m in [(1, 5.0, 0), (2, 3.0, 1), (2, math.nan, 1), (3, 9.0, 1)]] + [(2, 1, 4.0, 0, 1.0)]
    df = spark.createDataFrame(rows, "event long, t long, x double, mask int, area double")
    value = lambda f, r: {x.event: x.v for x in events.reduced(events.timesteps(df, f, "x", "mask", "area"), r, "v").collect()}
    assert value("max", "max")[1] == 9 and math.isnan(value("max", "max")[2]) and value("max", "first_landfall")[1] == 3
    assert value("weighted_mean", "weighted_mean")[1] == pytest.approx((6 + 18) / 6) and value("weighted_mean", "mean_of_ratios")[1] == pytest.approx((1.5 + 9) / 2)
    with pytest.raises(ValueError):
        events.timesteps(df, "weighted_sum", "x")


def test_gradient(spark):
    df = spark.createDataFrame([(1, 1, float(a), float(b), 3.0 * a) for a in (10, 11, 12) for b in (0, 1)], "event long, t long, lat double, lon double, x double")
    got = {(r.lat, r.lon): r.gradient for r in events.gradient(df, "x").collect()}
    assert got[(11.0, 0.0)] == pytest.approx(3 / math.radians(1) / 6378)


def test_verdicts(spark):
    make = lambda rows: spark.createDataFrame(rows, "shard long, granule string")
    plan_, past = make([(1, "a"), (2, "a"), (2, "b"), (3, "a"), (4, "a")]), make([(1, "a"), (2, "a"), (3, "b")])
    assert {r.shard: r.verdict for r in identity.verdicts(plan_, past).collect()} == {1: "skip", 2: "rewrite", 3: "refuse", 4: "write"}
    assert {r.verdict for r in identity.verdicts(plan_, past, allow_contraction=True).where("shard = 3").collect()} == {"rewrite"}


def config():
    return {
        "data_source": {"coordinates": {"latitude": "lat", "longitude": "lon"}, "variables": {"h": "h", "q": "q"}, "filters": [{"variable": "q", "op": "eq", "value": 0}]},
        "aggregation": {"variables": {"n": {"function": "len", "dtype": "int32", "fill_value": 0}, "top": {"function": "max", "source": "h"}, "d": {"function": "tdigest", "source": "h", "delta": 32}}},
        "output": {"grid": {"type": "healpix", "parent_order": 2, "child_order": 6}, "pyramid": [4, 2]},
    }


def test_plan(spark):
    r = random.Random(1)
    rows = [(r.uniform(40, 42), r.uniform(10, 12), r.gauss(0, 1), k % 5 and 1 or 0) for k in range(500)]
    found = plan.run(spec.parse(config()), spark.createDataFrame(rows, "lat double, lon double, h double, q int"))
    assert found.cells.agg(F.sum("n")).first()[0] == found.levels[2].agg(F.sum("n")).first()[0] == 100
    assert sum(c.weight for x in found.levels[2].collect() for c in x.d) == 100


def test_spec_is_checked_and_hashed():
    one = spec.parse(config())
    finer = config()
    finer["output"]["grid"]["child_order"] = 8
    other = config()
    other["aggregation"]["variables"]["top"]["function"] = "min"
    assert one.semantic_hash == spec.parse(finer).semantic_hash != spec.parse(other).semantic_hash
    assert one.foldable() == {"n": "len", "top": "max"}
    for change in (lambda c: c.update(extra=1), lambda c: c["aggregation"]["variables"].update(x={"function": "mode", "source": "h"}), lambda c: c["aggregation"]["variables"].update(x={"expression": "sum(zz)"}), lambda c: c["output"].update(pyramid=[2, 4]), lambda c: c["data_source"]["filters"].append({"variable": "q", "op": "in", "value": 1})):
        bad = config()
        change(bad)
        with pytest.raises(spec.SpecError):
            spec.parse(bad)


def test_registry():
    with pytest.raises(ValueError):
        registry.register("reducer", "max", max)
    assert "weighted_mean" in registry.describe("spatial")


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, 0.5), (2, 9, 1.5)], "shard long, cell long, x double")
    tables.write_shards(df, str(tmp_path / "t"), ["shard"], "cell")
    tables.write_shards(df.where("shard = 2").withColumn("x", F.lit(7.0)), str(tmp_path / "t"), ["shard"], "cell")
    tables.stamp(df.where("shard = 2"), str(tmp_path / "s"), ["shard"], "run1")
    assert [(r.cell, r.x) for r in tables.read_stamped(spark, str(tmp_path / "t"), str(tmp_path / "s"), ["shard"]).collect()] == [(9, 7.0)]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    tables.ensure_manifest(spark, str(tmp_path / "m.json"), {"semantic_hash": "a"})
    with pytest.raises(tables.ManifestMismatch):
        tables.ensure_manifest(spark, str(tmp_path / "m.json"), {"semantic_hash": "b"})


def test_catalog_pages(spark):
    class Reply:
        def __init__(self, text):
            self.text = text

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self, *a):
            return self.text

    pages = iter(['{"features": [{"id": "a", "bbox": [0, 0, 1, 1], "properties": {"datetime": "2020-01-01T00:00:00Z"}}], "links": [{"rel": "next", "href": "http://x.example/2"}]}', '{"features": [{"id": "b", "bbox": [2, 2, 3, 3], "properties": {"datetime": "2020-01-02T00:00:00Z"}}]}'])
    items = catalog.fetch_items("http://x.example", {}, lambda request: Reply(next(pages)))
    assert [r.id for r in catalog.from_items(spark, items).where(filters.in_boxes([(1.5, 1.5, 2.5, 2.5)])).collect()] == ["b"]


def test_streaming_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(k % 4, float(k)) for k in range(100)], "cell long, x double").repartition(5)
    df.write.parquet(str(tmp_path / "in"))
    fields = [Field("n", "len", dtype="int64"), Field("top", "max", "x", dtype="float64")]
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    micro_batch.merge_batches(stream, fields, ["cell"], str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = micro_batch.read_merged(spark, str(tmp_path / "out"), fields, ["cell"]).select("cell", "n", "top")
    assert sorted(got.collect()) == sorted(aggregate.by_cell(df, fields, ["cell"]).select("cell", "n", "top").collect())
    with pytest.raises(ValueError):
        micro_batch.admissible([Field("m", "mean", "x")])


def test_entry_and_registry_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_digest_cuts_are_the_greedy_rule():
    """The jumps against the rule taken member by member, and sizes that are fixed by it."""
    r = np.random.default_rng(3)
    for weights, delta in ((np.ones(300), 16), (np.ones(40), 16), (r.exponential(size=500), 32), (np.where(np.arange(300) == 150, 5000.0, 1.0), 512), (np.ones(512), 512)):
        total, starts, left, seen = weights.sum(), [0], 0.0, 0.0
        for i, w in enumerate(weights):
            right = float(tdigest.k1(np.array((seen + w) / total), delta))
            if i > starts[-1] and right - left > 1 + 1e-9:
                starts.append(i)
                left = float(tdigest.k1(np.array(seen / total), delta))
            seen += w
        assert tdigest.cuts(weights, delta).tolist() == starts
    # Weights of published digests of 300 and 40 members at delta 16.
    assert np.diff(tdigest.cuts(np.ones(300), 16))[:6].tolist() == [2, 7, 12, 17, 21, 25]
    assert np.diff(tdigest.cuts(np.ones(40), 16))[:6].tolist() == [1, 1, 2, 2, 3, 3]
    assert np.isnan(tdigest.cdf(tdigest.EMPTY, [1.0])).all() and tdigest.rasterize(tdigest.EMPTY, [0, 1, 2]).tolist() == [0, 0]


def test_pairwise_merges_keep_weight_and_pass_empty_sides():
    a, b = tdigest.build(np.arange(900.0), delta=32), tdigest.build(np.arange(300.0, 500.0), delta=32)
    assert tdigest.merge_pair(a, b, 32)[:, 1].sum() == 1100 and tdigest.merge_pair(a, tdigest.EMPTY).tolist() == a.tolist() == tdigest.merge_pair(tdigest.EMPTY, a).tolist()


def test_boxes_and_masks_at_fine_orders(spark):
    far = [(1, c) for c in (0, 1 << 12, 2 << 12, 3 << 12, (3 << 12) + 5, 1 << 15, 2 << 16, 3 << 16)] + [(2, 77)]
    got = {r.shard: r for r in coverage.box(spark.createDataFrame(far, "shard long, c long"), "shard", "c", 10).collect()}
    assert got[2].box == [77] and got[2].box_order == 10 and len(got[1].box) <= 4
    assert {c >> (2 * (10 - got[1].box_order)) for _, c in far[:-1]} == set(got[1].box)
    whole = spark.createDataFrame([(0, 1 << 58), (1 << 58, (1 << 58) + 5), (3 << 58, 4 << 58), ((4 << 58) - 9, 5 << 58)], "lo long, hi long")
    assert sorted(map(tuple, coverage.union(whole).collect())) == [(0, (1 << 58)), (1 << 58, (1 << 58) + 5), (3 << 58, 4 << 58), (4 << 58, 5 << 58)]


def test_cover_holds_every_point_of_its_box(spark):
    box = (170.0, -20.0, 200.0, 5.0)
    points = [(box[1] + (box[3] - box[1]) * i / 12, box[0] + (box[2] - box[0]) * j / 12) for i in range(13) for j in range(13)]
    own = {r.cell for r in cells.with_healpix(spark.createDataFrame(points, "lat double, lon double"), "lat", "lon", 4).collect()}
    covered = {r.cell for r in footprints.cover(spark, box, 4).collect()}
    assert own <= covered and len(covered) < 1000


def test_sweep_declarations_lease_and_retrofit(spark, tmp_path):
    f = {"n": {"function": "len", "fill": 0}}
    assert sweep.check_match([f, f]) == sweep.declared(f)
    with pytest.raises(sweep.DeclarationMismatch):
        sweep.check_match([f, {"n": {"function": "len", "fill": 1}}])
    with sweep.Lease(spark, str(tmp_path / "lease"), 60, "me"), pytest.raises(RuntimeError), sweep.Lease(spark, str(tmp_path / "lease"), 60, "you"):
        pass
    kept = sweep.retrofit({"a": 1}, [3, 2], f)
    assert sweep.retrofit(kept, [2, 3], f) == kept
    with pytest.raises(sweep.DeclarationMismatch):
        sweep.retrofit(kept, [3], f)
    assert sweep.stages(6) == [("gather", 6, 6), ("merge", 6, 4), ("merge", 4, 2), ("merge", 2, 0)]


def test_store_refuses_contraction_and_reads_back(spark, tmp_path):
    df = spark.range(64).selectExpr("id DIV 16 AS shard", "id AS c", "id * 2 AS n")
    plan = spark.createDataFrame([(k, g) for k in range(4) for g in "ab"], "shard long, granule string")
    root, manifest = str(tmp_path / "store"), {"semantic_hash": "x", "grid": "g", "schema": ["n"]}
    store.write_leaves(df, plan, root, "c", 2, manifest, "one")
    assert {r.run for r in store.write_leaves(df, plan, root, "c", 2, manifest, "two").collect()} == {"one"}
    assert store.read_leaves(spark, root).count() == 64
    with pytest.raises(ManifestMismatch):
        store.write_leaves(df, plan.where("granule = 'a'"), root, "c", 2, manifest, "three")
    leaves = spark.read.parquet(f"{root}/coverage")
    assert store.root_coverage(leaves, 2, 3).count() == 1 and store.stale_coverage(leaves, df).count() == 0
    assert store.bitmap_and(leaves, leaves).where("bitmap like '%0%'").count() == 0


def test_slices_with_missing_samples_fail(spark):
    samples = spark.createDataFrame([(1, p) for p in (0, 1, 3)], "k long, pos long")
    slices = spark.createDataFrame([(1, 0, 2)], "k long, start long, stop long")
    assert readplan.planned(samples, slices, ["k"], "pos").count() == 2
    with pytest.raises(Exception, match="missing"):
        readplan.planned(samples, spark.createDataFrame([(1, 1, 4)], "k long, start long, stop long"), ["k"], "pos").collect()


def test_companion_reducers(spark):
    df = spark.createDataFrame([(1, 2.0, 9), (1, 4.0, 7), (2, 1.0, 5)], "k long, x double, cell long")
    found = registry.companion_aggregate(df, ["k"], "x", lambda v, locations: (float(v.max()), int(locations.min())), "double", location="cell").collect()
    assert sorted(map(tuple, found)) == [(1, 4.0, 7), (2, 1.0, 5)]


def test_shared_quantiles_equal_single_ones(spark):
    df = spark.createDataFrame([(k % 3, float(k) if k != 7 else math.nan) for k in range(40)], "c long, x double")
    fields = [Field(n, f, "x", params=p, dtype="float64") for n, f, p in (("a", "median", {}), ("b", "quantile", {"q": 0.25}), ("d", "quantile", {"q": 0.9}))]
    both = {r.c: r for r in aggregate.by_cell(df, fields, ["c"]).collect()}
    for f in fields:
        for r in aggregate.by_cell(df, [f], ["c"]).collect():
            assert r[f.name] == both[r.c][f.name] or math.isnan(r[f.name]) and math.isnan(both[r.c][f.name])


def test_nan_is_in_no_order(spark):
    df = spark.sql("SELECT * FROM VALUES (double('NaN'), 1), (1.0, 2), (5.0, 3), (CAST(NULL AS DOUBLE), 4), (double('inf'), 5) t(x, i)")

    def kept(condition) -> list[int]:
        return sorted(r.i for r in df.where(condition).collect())

    for op, v, expected in (("eq", 5, [3]), ("ne", 5, [1, 2, 4, 5]), ("ge", 5, [3, 5]), ("gt", 1, [3, 5]), ("le", 5, [2, 3]), ("lt", 5, [2]), ("ge", float("nan"), []), ("ne", float("nan"), [1, 2, 3, 4, 5])):
        assert kept(filters.predicate({"variable": "x", "op": op, "value": v})) == expected
        assert kept(filters.predicate({"variable": "x", "op": op, "value": v, "keep": False})) == sorted({1, 2, 3, 4, 5} - set(expected))
    assert kept(filters.predicate({"variable": "x", "op": "not_in", "values": [5.0, float("nan")]})) == [1, 2, 4, 5]
    for text, expected in (("x > 1", [3, 5]), ("x >= x", [2, 3, 5]), ("x == x", [2, 3, 5]), ("x != x", [1]), ("1 < x", [3, 5]), ("0 < x < 9", [2, 3])):
        assert kept(expressions.per_row(text, df.columns)) == expected


def test_a_shard_left_without_cells_is_not_read(spark, tmp_path):
    df, root, manifest = spark.range(64).selectExpr("id AS c", "id DIV 16 AS shard"), str(tmp_path / "store"), {"semantic_hash": "x", "grid": {}, "schema": []}
    plan = df.selectExpr("shard", "'a' AS granule").distinct()
    store.write_leaves(df, plan, root, "c", 2, manifest, "one")
    more = plan.unionByName(spark.sql("SELECT 1L AS shard, 'b' AS granule"))
    store.write_leaves(df.where("shard <> 1"), more, root, "c", 2, manifest, "two")
    assert sorted({r.shard for r in store.read_leaves(spark, root).collect()}) == [0, 2, 3]


def test_granules_that_cannot_be_read_are_named(spark, tmp_path):
    good, empty, broken, gone = (str(tmp_path / n) for n in ("good one", "empty", "broken", "gone"))
    spark.range(5).write.parquet(good)
    spark.range(0).write.parquet(empty)
    (tmp_path / "broken").write_bytes(b"no Parquet")
    rows, bad = store.union_granules(spark, [good, broken, gone, empty], "id long")
    assert rows.count() == 5 and bad == [broken, gone]
    for paths in ([gone], [broken, gone]):
        with pytest.raises(FileNotFoundError):
            store.union_granules(spark, paths, "id long")
