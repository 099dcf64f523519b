"""Unions and differences of boxes, scenes' stacks, services, outlines and vectorised scoring, against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessaline import cli
from tessaline.functions import geometry as G
from tessaline.operators import fetch, inference, raster, zones
from tessaline.plans import config, pipelines
from tessaline.sources import services
from tessaline.sources.manifests import Grid

BOX = "id int, minx double, miny double, maxx double, maxy double"


def boxes_of(spark, draw, n, span, step=64.0):
    rows = []
    for k in range(n):
        x, y = draw.randrange(-20, 40) * step, draw.randrange(-20, 40) * step
        rows.append((k, x, y, x + draw.randrange(0, span) * step, y + draw.randrange(0, span) * step))
    return rows, spark.createDataFrame(rows, BOX)


def cells_of(rows, step=64.0):
    """The set of step by step cells that boxes cover."""
    return {(i, j) for _, x0, y0, x1, y1 in rows for i in range(int(x0 // step), int(x1 // step)) for j in range(int(y0 // step), int(y1 // step))}


def cells_of_pieces(pieces, step=64.0):
    out = []
    for r in pieces.collect():
        out += [(i, j) for i in range(round(r["minx"] / step), round(r["maxx"] / step)) for j in range(round(r["miny"] / step), round(r["maxy"] / step))]
    assert len(out) == len(set(out)), "rectangles overlap"
    return set(out)


@pytest.mark.parametrize("seed", range(4))
def test_unions_and_differences(spark, seed):
    draw = random.Random(seed)
    (a, left), (b, right) = boxes_of(spark, draw, 25, 14), boxes_of(spark, draw, 25, 9)
    assert cells_of_pieces(zones.union(left)) == cells_of(a)
    free = cells_of(a) - cells_of(b)
    assert cells_of_pieces(zones.difference(left, right)) == free
    assert cells_of_pieces(zones.difference(left, right.limit(0))) == cells_of(a)
    assert zones.union(left.limit(0)).count() == 0 and zones.difference(left.limit(0), right).count() == 0
    # connected parts, by flood fill over cells
    parent, todo = {}, set(free)
    while todo:
        start = todo.pop()
        stack, own = [start], {start}
        while stack:
            i, j = stack.pop()
            for n in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                if n in todo:
                    todo.discard(n)
                    own.add(n)
                    stack.append(n)
        parent[frozenset(own)] = len(own) * 64.0 * 64.0
    parted = zones.parts(zones.difference(left, right)).cache()
    areas = sorted(r["area"] for r in zones.area_of(parted, "part").collect())
    assert areas == sorted(parent.values())
    least = 64.0 * 64.0 * 3
    kept = zones.area_of(zones.without_slivers(parted, least), "part").collect()
    assert sorted(r["area"] for r in kept) == sorted(v for v in parent.values() if v > least)


def test_safe_zones(spark):
    area = spark.createDataFrame([(1, 0.0, 0.0, 1000.0, 1000.0)], BOX)
    labels = spark.createDataFrame([(1, 400.0, 0.0, 500.0, 1000.0)], BOX)
    inventory = spark.createDataFrame([(1, 0.0, 0.0, 300.0, 980.0)], BOX)
    got = zones.area_of(zones.safe_zone(area, labels, inventory), "part").collect()
    assert sorted(r["area"] for r in got) == [300 * 20.0, 400 * 1000.0]
    assert [r["area"] for r in zones.area_of(zones.safe_zone(area, labels, inventory, least=6000.0), "part").collect()] == [400 * 1000.0]
    assert zones.area_of(zones.safe_zone(area, labels.limit(0), inventory.limit(0)), "part").first()["area"] == 1e6
    assert zones.union_bounds(labels.limit(0)) is None and tuple(zones.union_bounds(labels.unionByName(inventory)).first()) == (0.0, 0.0, 500.0, 1000.0)


def test_rounded_rings(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 30.0, 10.0)], BOX)
    ring = G.rounded_ring(5.0, 16)
    r = df.select(ring.alias("ring"), G.ring_area(ring).alias("area")).first()
    arc = 4 * 16 * 0.5 * 25 * math.sin(math.pi / 32)
    assert r["area"] == pytest.approx(300 + 2 * 5 * 40 + arc) and len(r["ring"]) == 68
    assert df.select(G.ring_area(G.rounded_ring(0.0))).first()[0] == 300


def test_rings_meet_boxes(spark):
    """Random triangles and boxes on a grid of half points, against a search for a common point."""
    draw = random.Random(11)
    rows = []
    for k in range(150):
        points = [(draw.randrange(0, 12) * 2.0, draw.randrange(0, 12) * 2.0) for _ in range(3)]
        x, y = draw.randrange(0, 11) * 2 + 0.5, draw.randrange(0, 11) * 2 + 0.5
        rows.append((k, [{"x": a, "y": b} for a, b in points], x, y, x + draw.randrange(1, 5), y + draw.randrange(1, 5)))
    df = spark.createDataFrame(rows, "k int, ring array<struct<x:double,y:double>>, minx double, miny double, maxx double, maxy double")
    got = {r["k"]: r["m"] for r in df.select("k", G.ring_meets_box(F.col("ring"), *(F.col(c) for c in ("minx", "miny", "maxx", "maxy"))).alias("m")).collect()}

    def clip(poly, inside, cut):
        out = []
        for p, q in zip(poly, poly[1:] + poly[:1]):
            if inside(p):
                out.append(p)
            if inside(p) != inside(q):
                out.append(cut(p, q))
        return out

    for k, ring, x0, y0, x1, y1 in rows:
        poly = [(p["x"], p["y"]) for p in ring]
        if abs((poly[1][0] - poly[0][0]) * (poly[2][1] - poly[0][1]) - (poly[2][0] - poly[0][0]) * (poly[1][1] - poly[0][1])) < 1e-9:
            continue
        at_x = lambda v: lambda p, q: (v, p[1] + (q[1] - p[1]) * (v - p[0]) / (q[0] - p[0]))
        at_y = lambda v: lambda p, q: (p[0] + (q[0] - p[0]) * (v - p[1]) / (q[1] - p[1]), v)
        for inside, cut in ((lambda p: p[0] >= x0, at_x(x0)), (lambda p: p[0] <= x1, at_x(x1)), (lambda p: p[1] >= y0, at_y(y0)), (lambda p: p[1] <= y1, at_y(y1))):  # noqa: B023
            poly = clip(poly, inside, cut) if poly else poly
        assert got[k] == bool(poly), (k, ring, x0, y0, x1, y1)


ITEMS = "item_id string, ord int, time_index int, epsg int, assets map<string,string>, minx double, miny double, maxx double, maxy double"


def test_stacks_of_scenes(spark):
    from tessaline.functions import scalars as S

    assets = {a: f"http://x/{a}" for a in [*S.ASSETS, "scl"]}
    rows = [("b", 7, 0, 32616, assets, 0.0, 0.0, 10.0, 10.0), ("a", 9, 1, 32617, {"scl": "u"}, 20.0, 0.0, 30.0, 10.0), ("c", 5000, 2, None, {"nir": "u"}, 5.0, 5.0, 15.0, 15.0)]
    items = spark.createDataFrame(rows, ITEMS)
    readings = spark.createDataFrame([("b", 0, 0, {"green": 1000.0, "nir": 5000.0}), ("a", 0, 1, {"scl": 4.0})], "item_id string, row int, col int, dn map<string,double>")
    bands, epsg = fetch.stacked_bands(items, readings)
    assert epsg == 32616 and fetch.stacked_bands(items, readings, "EPSG:5070")[1] == 5070
    got = {r["item_id"]: (r["time_index"], r["bands"]) for r in bands.collect()}
    assert got["b"] == (0, pytest.approx([0.1, 0, 0, 0, 0.5, 0, 0])) and got["a"][0] == 1
    assert {r["item_id"]: r["scl"] for r in fetch.stacked_classes(items, readings)[0].collect()} == {"a": 4, "b": 0}
    assert {r["item_id"]: r["time_index"] for r in fetch.timed(items).collect()} == {"b": 0, "a": 1, "c": 2}
    for bad, target in ((items.limit(0), None), (items.where("item_id = 'c'"), None), (items.where("item_id = 'a'"), 5070)):
        with pytest.raises(ValueError):
            fetch.stacked_bands(bad, readings, target)
    with pytest.raises(ValueError):
        fetch.checked_system(items.where("item_id = 'c'"))
    records = fetch.fetched(items, (0, 0, 8, 8), ["green"]).orderBy("time_index").collect()
    assert [(r["success"], r["error"]) for r in records] == [(True, None), (False, "no overlap"), (False, "asset missing")]
    values = fetch.fetched_values(fetch.fetched(items, (0, 0, 8, 8), ["green"]), readings, ["green"]).collect()
    assert [(r["item_id"], r["bands"]) for r in values] == [("b", [pytest.approx(0.1)])]


def test_services(spark):
    assert services.datasets_for("10m")[0] == services.THIRD and services.datasets_for(None, ["x"]) == ["x"] and services.datasets_for() == services.DEFAULT_DATASETS
    with pytest.raises(ValueError):
        services.datasets_for("5m")
    assert services.query_params((1, 2, 3, 4), "d", 9) == {"bbox": "1,2,3,4", "datasets": "d", "prodFormats": "GeoTIFF,IMG,TIF", "outputFormat": "JSON", "max": 9}
    assert services.primary_url([{"x": 1}, {"URL": "ftp://a"}]) == "ftp://a" and services.primary_url(["ftp://a", "http://b"]) == "http://b"
    assert services.primary_url({"TIFF": "https://c"}) == "https://c" and services.primary_url(None) is None and services.primary_url([]) is None
    catalog = spark.createDataFrame([(k, 2018 + k % 2, k * 10.0, 0.0, k * 10.0 + 5, 5.0) for k in range(8)], "id int, year int, minx double, miny double, maxx double, maxy double")
    ids = lambda df: [r["id"] for r in df.orderBy("id").collect()]
    assert ids(fetch.catalog_tiles(catalog, (12, 1, 41, 2))) == [1, 2, 3, 4] and ids(fetch.catalog_tiles(catalog, (12, 1, 41, 2), 2018, 1)) == [2]
    cut = fetch.clipped_shapes(catalog, (12, 1, 23, 9)).orderBy("id").collect()
    assert [(r["id"], r["minx"], r["miny"], r["maxx"], r["maxy"]) for r in cut] == [(1, 12.0, 1.0, 15.0, 5.0), (2, 20.0, 1.0, 23.0, 5.0)]
    assert fetch.clipped_shapes(catalog.limit(0), (0, 0, 1, 1)).count() == 0


def test_pairs_and_progress(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 5)], "k int, v int")
    assert sorted(tuple(r) for r in fetch.paired(left, right, "k", "v", -1).select("k", "v", "paired").collect()) == [(1, 5, True), (2, -1, False)]
    with pytest.raises(Exception, match="No partner for 2"):
        fetch.paired(left, right, "k", "v", -1, strict=True).collect()
    events = spark.sql("select 'a' as g, cast(id as int) as n, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id * 2) as ts from range(4)")
    rows = fetch.progress(events, ["g"], ["ts"], "n", whole=10).orderBy("n").collect()
    assert [(r["done"], r["total"]) for r in rows] == [(1, 0), (2, 1), (3, 3), (4, 6)]
    assert rows[0]["rate"] is None and rows[3]["rate"] == pytest.approx(4 / 6) and rows[3]["left"] == pytest.approx(9.0)


def ring_cells(rings, h, w):
    """The cells whose centre lies in an odd number of rings."""
    out = set()
    for r in range(h):
        for c in range(w):
            x, y, inside = c + 0.5, -(r + 0.5), False
            for ring in rings:
                for p, q in zip(ring, ring[1:] + ring[:1]):
                    if (p["y"] > y) != (q["y"] > y) and x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]:
                        inside = not inside
            if inside:
                out.add((r, c))
    return out


def test_outlines(spark):
    """Rings hold exactly a region's cells, holes included; signed areas add up; a tolerance drops small steps."""
    draw = np.random.default_rng(5)
    grid = draw.random((14, 16)) < 0.6
    cells = spark.createDataFrame([(int(r), int(c)) for r, c in zip(*np.nonzero(grid))], "row int, col int")
    regions = inference.regions(cells, 16)
    own = {}
    for r in regions.collect():
        own.setdefault(r["region"], set()).add((r["row"], r["col"]))
    got = {r["region"]: r for r in inference.outlines(regions).collect()}
    assert set(got) == set(own)
    signed = lambda ring: sum(p["x"] * q["y"] - q["x"] * p["y"] for p, q in zip(ring, ring[1:] + ring[:1])) / 2
    for region, r in got.items():
        assert ring_cells(r["rings"], 14, 16) == own[region] and r["area"] == len(own[region])
        assert sum(map(signed, r["rings"])) == pytest.approx(len(own[region]))
    steps = [(r, c) for r in range(10) for c in range(10 + r % 2)]
    df = spark.createDataFrame([(*s, 0) for s in steps], "row int, col int, region long")
    rough, smooth = (inference.outlines(df, t, (100.0, 50.0), 2.0).first()["rings"] for t in (0.0, 2.1))
    assert len(rough[0]) > 10 and len(smooth[0]) <= 6 and min(p["x"] for p in smooth[0]) == 100.0 and max(p["y"] for p in smooth[0]) == 50.0


def plain_inference(array, valid, window, overlap, model, threshold):
    """Whole rasters in numpy: windows added up, averaged and thresholded."""
    _, h, w = array.shape
    side = lambda size: (min(window, size), [0] if size <= window else sorted({*range(0, size - window + 1, max(window - overlap, 1)), size - window}))
    (wh, rows), (ww, cols) = side(h), side(w)
    total, count = np.zeros((2, h, w)), np.zeros((h, w))
    for r in rows:
        for c in cols:
            logits = model(array[:, r : r + wh, c : c + ww].astype(np.float32))
            e = np.exp(logits - logits.max(axis=0))
            total[:, r : r + wh, c : c + ww] += e / e.sum(axis=0)
            count[r : r + wh, c : c + ww] += 1
    return np.where(valid & (total[1] / count >= threshold), 1, 0)


def test_vectorised_inference(spark, tmp_path):
    """A model that sees its whole window: classes, outlines and files."""
    draw = np.random.default_rng(9)
    h, w = 18, 21
    array = draw.uniform(0, 1, (3, h, w))
    missing = draw.random((h, w)) < 0.1
    array[:, missing] = -9999.0

    def model(x):
        near = x[0] - x.mean() + 0.3 * np.roll(x[1], 1, axis=1)
        return np.stack([-near, near])

    cells = spark.createDataFrame([(r, c, array[:, r, c].tolist()) for r in range(h) for c in range(w)], "row int, col int, bands array<double>")
    own = config.build({"inference": {"window": 8, "overlap": 3, "threshold": 0.55, "min_area": 2}})
    ready = np.where(missing, 0.0, array)
    want = plain_inference(ready, ~missing, 8, 3, model, 0.55)
    grid = Grid("EPSG:5070", (10.0, 0.0, 0.0, 0.0, -10.0, 500.0), w, h)
    layers = [raster.Layer(cells, ("a", "b", "c"), type="naip")]
    mask = pipelines.infer_stack(spark, layers, grid, model, own)
    got = np.zeros((h, w))
    for r in mask.collect():
        got[r["row"], r["col"]] = r["class_id"]
    assert (got == want).all() and want.any() and not want.all()
    source = raster.Raster(cells, grid, ("a", "b", "c"))
    byte = plain_inference(ready / 255, ~missing, 8, 3, model, 0.55)
    assert sum(r["class_id"] for r in pipelines.infer_raster(source, model, own).collect()) == byte.sum()
    paths = pipelines.infer_to(mask, grid, own, "x.json", str(tmp_path / "mask"), str(tmp_path / "shapes"))
    shapes = spark.read.parquet(paths[1])
    assert shapes.agg(F.sum("area")).first()[0] <= want.sum() * 100 and shapes.where("area < 200").count() == 0
    with pytest.raises(Exception, match="shape"):
        pipelines.infer_stack(spark, layers, grid, lambda x: x[:1], own).collect()


def test_block_functions(spark):
    rows = [(r, c, float(r * 10 + c)) for r in range(7) for c in range(9)]
    got = inference.block_function(spark.createDataFrame(rows, "row int, col int, v double"), 4, lambda a: a - a.max(), "v").collect()
    for r in got:
        top, left = min(r["row"] // 4 * 4 + 3, 6), min(r["col"] // 4 * 4 + 3, 8)
        assert r["value"] == r["row"] * 10 + r["col"] - (top * 10 + left)


def test_topography_plan(spark):
    z = lambda r, c: 2.0 * c
    tile = lambda left: raster.Raster(spark.createDataFrame([(r, c, [z(r, c + left)]) for r in range(6) for c in range(4)], "row int, col int, bands array<double>"), Grid("EPSG:5070", (1.0, 0.0, float(left), 0.0, -1.0, 6.0), 4, 6), ("z",))
    out = pipelines.topography([tile(0), tile(4)], Grid("EPSG:5070", (1.0, 0.0, 1.0, 0.0, -1.0, 5.0), 6, 4), 1.0, 2.0)
    rows = out.cells.collect()
    assert len(rows) == 24 and all(r["bands"][0] == pytest.approx(math.degrees(math.atan(2.0))) for r in rows) and len(out.labels) == 4
    with pytest.raises(FileNotFoundError):
        pipelines.topography([], out.grid)


def test_command_line(spark, tmp_path):
    args = cli.parser().parse_args(["infer", "--raster", "r", "--manifest", "m", "--model", "x", "--window", "64", "--overlap", "8"])
    assert cli.settings_of(args).inference.window == 64 and cli.settings_of(args).inference.classes == 2
    with pytest.raises(config.ConfigurationError):
        cli.settings_of(cli.parser().parse_args(["infer", "--raster", "r", "--manifest", "m", "--model", "x", "--window", "4", "--overlap", "8"]))
    grid = spark.createDataFrame([(k, k * 10.0, 0.0, k * 10.0 + 10, 10.0) for k in range(30)], BOX)
    labels = spark.createDataFrame([(1, 5.0, 5.0, 6.0, 6.0)], BOX)
    for name, df in (("grid", grid), ("labels", labels), ("inventory", labels.limit(0))):
        df.write.parquet(str(tmp_path / name))
    assert cli.main(["sample", "--grid", str(tmp_path / "grid"), "--labels", str(tmp_path / "labels"), "--inventory", str(tmp_path / "inventory"), "--out", str(tmp_path / "out"), "--ratio", "2", "--margin", "20"]) == 0
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("class_label").count().collect()
    assert {r["class_label"]: r["count"] for r in got} == {1: 1, 0: 2}
    spark.createDataFrame([(r, c, float(c)) for r in range(5) for c in range(5)], "row int, col int, z double").write.parquet(str(tmp_path / "z"))
    assert cli.main(["topography", "--surface", str(tmp_path / "z"), "--cell", "1", "--small", "1", "--large", "2", "--out", str(tmp_path / "t")]) == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 25
