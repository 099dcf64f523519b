"""Windows, resampling, reprojection, mosaics, clips and extraction, against numpy or plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessaline.functions import crs
from tessaline.operators import extraction, raster
from tessaline.sources import areas
from tessaline.sources.manifests import Grid

NODATA = -9999.0


def grid_of(h, w, x=0.0, y=100.0, size=1.0, epsg=5070):
    return Grid(f"EPSG:{epsg}", (size, 0.0, x, 0.0, -size, y), w, h)


def raster_of(spark, array, x=0.0, y=100.0, size=1.0, epsg=5070):
    """A raster from an array (bands, rows, columns); NaN is a missing cell of all bands."""
    bands, h, w = array.shape
    rows = [(r, c, [float(v) for v in array[:, r, c]]) for r in range(h) for c in range(w) if not np.isnan(array[:, r, c]).all()]
    return raster.Raster(spark.createDataFrame(rows, "row int, col int, bands array<double>"), grid_of(h, w, x, y, size, epsg), tuple(f"b{k}" for k in range(bands)))


def array_of(source):
    out = np.full((len(source.labels), source.grid.height, source.grid.width), np.nan)
    for r in source.cells.collect():
        out[:, r["row"], r["col"]] = r["bands"]
    return out


def plain_window(array, nodata, scale, row_off, col_off, height, width):
    """A window of one source, cell by cell."""
    bands, grid_h, grid_w = array.shape
    out = np.full((bands, math.ceil(height), math.ceil(width)), NODATA)
    top, left = max(math.floor(row_off), 0), max(math.floor(col_off), 0)
    for r in range(top, min(math.ceil(row_off + height), grid_h)):
        for c in range(left, min(math.ceil(col_off + width), grid_w)):
            at = r - top + round(top - row_off), c - left + round(left - col_off)
            if 0 <= at[0] < out.shape[1] and 0 <= at[1] < out.shape[2]:
                for b in range(bands):
                    v = array[b, r, c]
                    out[b, at[0], at[1]] = NODATA if v in (nodata, NODATA) else scale(b, v)
    return out


@pytest.mark.parametrize("window", [(0, 0, 4, 5), (1, 2, 3, 2), (-2, -1, 5, 4), (4, 5, 6, 6), (1.5, 0.25, 2, 3), (0.6, 1.4, 2.5, 2.2), (-0.5, -1.5, 3, 3), (20, 20, 2, 2), (-3.7, 2, 2.2, 1)])
def test_windows_of_stacks(spark, window):
    draw = np.random.default_rng(3)
    one, two, three = draw.integers(0, 255, (2, 6, 7)).astype(float), draw.uniform(-5, 5, (2, 6, 7)), draw.uniform(0, 9, (1, 6, 7))
    one[0, 2, 3], two[1, 1, 1] = 0.0, -1.0
    source = lambda a, **more: raster.Layer(raster_of(spark, a).cells, tuple(f"b{k}" for k in range(len(a))), **more)
    layers = [source(one, nodata=0.0, scale_max=255.0), source(two, nodata=-1.0, band_scaling={"b0": (-5.0, 5.0), "b1": (2.0, 2.0)}, scale_max=3.0), source(three, scale_max=9.0, scale_min=1.0)]
    scales = [(0.0, lambda b, v: v / 255), (-1.0, lambda b, v: (v + 5) / 10 if b == 0 else v), (None, lambda b, v: (v - 1) / 8)]
    want = np.concatenate([plain_window(a, n, f, *window) for a, (n, f) in zip((one, two, three), scales)])
    got = np.full(want.shape, np.nan)
    for r in raster.read_window(spark, layers, grid_of(6, 7), *window).collect():
        got[:, r["row"], r["col"]] = r["bands"]
    assert np.allclose(got, want)


def test_bad_windows(spark):
    layer = raster.Layer(raster_of(spark, np.ones((1, 2, 2))).cells, ("b0",))
    with pytest.raises(ValueError):
        raster.read_window(spark, [layer], grid_of(2, 2), 0, 0, 0, 3)
    bad = spark.createDataFrame([(0.0, 0.0, -1.0, 2.0, 2, 2)], "row_off double, col_off double, height double, width double, grid_h int, grid_w int")
    with pytest.raises(Exception, match="positive height"):
        raster.read_windows(bad, [layer], []).collect()


def test_utm_there_and_back(spark):
    for lon, lat in ((-85.3, 42.1), (-81.0, 29.5), (-87.0, 0.1), (10.2, -33.4), (178.9, 71.0)):
        zone, south = int((lon + 180) // 6) + 1, lat < 0
        x, y = crs.to_utm(F.lit(lon), F.lit(lat))
        lon2, lat2 = crs.from_utm(F.col("x"), F.col("y"), zone, south)
        got = spark.range(1).select(x.alias("x"), y.alias("y")).select(lon2, lat2).first()
        assert got[0] == pytest.approx(lon, abs=1e-6) and got[1] == pytest.approx(lat, abs=1e-7)
    there = raster.projected_points(spark, [(500000.0, 4649776.0)], 32616, 5070)
    back = raster.projected_points(spark, raster.projected_points(spark, there, 5070, 32617), 32617, 32616)
    assert back[0] == pytest.approx((500000, 4649776), abs=0.05)
    with pytest.raises(ValueError):
        crs.project(F.lit(1.0), F.lit(1.0), 3857, 4326)


def plain_bilinear(array, y, x, nodata=NODATA):
    out = []
    for band in array:
        total = weight = 0.0
        for dr in (0, 1):
            for dc in (0, 1):
                r, c = math.floor(y) + dr, math.floor(x) + dc
                w = (y - math.floor(y) if dr else 1 - y + math.floor(y)) * (x - math.floor(x) if dc else 1 - x + math.floor(x))
                if 0 <= r < band.shape[0] and 0 <= c < band.shape[1] and w > 0 and not np.isnan(band[r, c]) and band[r, c] != nodata:
                    total, weight = total + w * band[r, c], weight + w
        out.append(total / weight if weight else nodata)
    return out


def test_resampling(spark):
    array = np.random.default_rng(1).uniform(0, 9, (2, 6, 8))
    array[0, 2, 2], array[:, 4, 4] = NODATA, np.nan
    source = raster_of(spark, array)
    got = raster.resampled(source, 2.0)
    assert (got.grid.height, got.grid.width, got.grid.transform) == (3, 4, (2.0, 0.0, 0.0, 0.0, -2.0, 100.0))
    want = np.array([[plain_bilinear(array, (r + 0.5) * 2 - 0.5, (c + 0.5) * 2 - 0.5) for c in range(4)] for r in range(3)])
    assert np.allclose(array_of(got), want.transpose(2, 0, 1))
    assert raster.resampled(source, 1.0) is source
    assert raster.resampled(source, 1.5).grid.width == 6
    for epsg in (4326, None):
        with pytest.raises(ValueError):
            raster.resampled(raster.Raster(source.cells, Grid(f"EPSG:{epsg}" if epsg else "", source.grid.transform, 8, 6), source.labels), 2.0)


def test_reprojection(spark):
    """A surface that is linear in the target's coordinates stays so; the same system is left alone."""
    x0, y0 = raster.projected_points(spark, [(-85.0, 42.0)], 4326, 32616)[0]
    h = w = 30
    source = raster_of(spark, np.zeros((1, h, w)), x0, y0, 100.0, 32616)
    cells = source.cells.withColumns({"x": F.lit(x0) + (F.col("col") + 0.5) * 100, "y": F.lit(y0) - (F.col("row") + 0.5) * 100})
    cells = crs.moved(cells, "x", "y", 32616, 5070).select("row", "col", F.array(F.col("x") / 1000 + F.col("y") / 500).alias("bands"))
    source = raster.Raster(cells, source.grid, ("v",))
    got = raster.reprojected(source, 5070)
    assert got.grid.crs == "EPSG:5070" and got.resolution == 100.0 and raster.reprojected(source, 32616) is source
    minx, miny, maxx, maxy = got.grid.bounds()
    corners = raster.projected_points(spark, [(x0, y0), (x0 + 3000, y0 - 3000)], 32616, 5070)
    assert all(minx - 1e-6 <= px <= maxx + 1e-6 and miny - 1e-6 <= py <= maxy + 1e-6 for px, py in corners)
    inner = [r for r in got.cells.collect() if r["bands"][0] != NODATA]
    assert len(inner) > 0.7 * got.grid.height * got.grid.width
    a, _, c, _, e, f = got.grid.transform
    errors = sorted(abs(r["bands"][0] - ((c + (r["col"] + 0.5) * a) / 1000 + (f + (r["row"] + 0.5) * e) / 500)) for r in inner)
    assert errors[int(0.85 * len(errors))] < 1e-3  # cells at the source's edge have fewer neighbours


def test_mosaics_and_references(spark):
    one, two = np.full((4, 4, 4), 1.0), np.full((4, 4, 4), 2.0)
    one[0, 1, 3] = NODATA
    tiles = [raster_of(spark, one, 0, 100), raster_of(spark, two, 3, 101)]
    got = raster.mosaic(tiles)
    assert got.grid.bounds() == (0, 96, 7, 101) and (got.grid.height, got.grid.width) == (5, 7)
    a = array_of(got)
    assert np.isnan(a[0, 0, 0]) and a[0, 0, 3] == 2 and a[0, 1, 0] == 1 and a[1, 2, 3] == 1 and a[0, 2, 3] == 2 and a[3, 3, 6] == 2
    reference = raster.prepared_reference(tiles, resolution=0.5)
    assert reference.labels == ("Red", "Green", "Blue", "NIR") and reference.grid.width == 14
    assert raster.prepared_reference(tiles[:1]).grid == tiles[0].grid
    other = raster_of(spark, two, 500000.0, 4649776.0, 1.0, 32616)
    for bad in ([], [tiles[0], other], [tiles[0], raster_of(spark, two, 0, 100, 2.0)], [tiles[0], raster_of(spark, two[:3])]):
        with pytest.raises(ValueError):
            raster.prepared_reference(bad)
    at = raster.projected_points(spark, [(500000.0, 4649776.0)], 32616, 5070)[0]
    both = raster.prepared_reference([raster_of(spark, one, at[0], at[1]), other], epsg=5070)
    assert both.grid.crs == "EPSG:5070" and both.cells.count() > 16
    assert raster.distinct_systems([tiles[0], other, tiles[1]]) == ["EPSG:32616", "EPSG:5070"]


def test_clips(spark):
    source = raster_of(spark, np.arange(64.0).reshape(1, 8, 8))
    square = [(1.0, 98.0), (1.0, 93.2), (6.1, 93.2), (6.1, 98.0)]
    hole = [(3.0, 96.0), (4.0, 96.0), (4.0, 95.0), (3.0, 95.0)]
    got = raster.clipped(source, [square, hole], 5070)
    assert got.grid.transform[2] == 1.0 and got.grid.transform[5] == 98.0 and (got.grid.height, got.grid.width) == (5, 6)
    a = array_of(got)
    for r in range(5):
        for c in range(6):
            x, y = 1.5 + c, 97.5 - r
            inside = 1 < x < 6.1 and 93.2 < y < 98 and not (3 < x < 4 and 95 < y < 96)
            assert a[0, r, c] == ((r + 2) * 8 + c + 1 if inside else NODATA)
    with pytest.raises(ValueError):
        raster.clipped(source, [[(50.0, 50.0), (51.0, 50.0), (51.0, 51.0)]], 5070)
    with pytest.raises(ValueError):
        raster.clipped(raster.Raster(source.cells, Grid("", source.grid.transform, 8, 8), source.labels), [square])


def test_footprints(spark):
    grids = spark.createDataFrame([(1, 0.0, 1e6, 1000.0, 1.001e6), (2, 5e5, 1.5e6, 5.01e5, 1.501e6)], "id int, minx double, miny double, maxx double, maxy double")
    rows = {r["id"]: r for r in raster.footprints(grids, 5070).collect()}
    for r in grids.collect():
        corners = raster.projected_points(spark, [(r["minx"], r["miny"]), (r["maxx"], r["miny"]), (r["maxx"], r["maxy"]), (r["minx"], r["maxy"])], 5070, 4326)
        assert np.allclose([(p["x"], p["y"]) for p in rows[r["id"]]["ring"]], corners, atol=1e-9)
        assert rows[r["id"]]["minx"] == pytest.approx(min(p[0] for p in corners))
    assert raster.channels(("a", "b")) == 2 and raster.channels(("a",), 5) == 5


def test_extraction(spark, tmp_path):
    """Pairs of tiles of two stacks; what is there stays unless told; in-place bytes; extents."""
    one, two = np.arange(2 * 12 * 12.0).reshape(2, 12, 12), np.full((2, 12, 12), 7.0)
    cells = raster_of(spark, one).cells.withColumn("stack", F.lit(0)).unionByName(raster_of(spark, two).cells.withColumn("stack", F.lit(1)))
    layers = [raster.Layer(cells, ("b0", "b1"), scale_max=288.0)]
    grids = spark.createDataFrame([(0, 1.0, 0.0, -1.0, 100.0, 12, 12), (1, 1.0, 10.0, -1.0, 100.0, 12, 12)], "stack int, a double, c double, e double, f double, grid_w int, grid_h int")
    tiles = spark.createDataFrame([(3, 1.0, 94.0, 5.0, 98.0), (7, 10.0, 96.0, 14.0, 100.0), (8, 14.0, 96.0, 18.0, 100.0), (9, 200.0, 0.0, 204.0, 4.0)], "id int, minx double, miny double, maxx double, maxy double")
    shapes = spark.createDataFrame([(1, 2.0, 90.0, 3.9, 97.0), (2, 15.6, 97.6, 16.4, 99.4)], "id int, minx double, miny double, maxx double, maxy double")
    path = str(tmp_path / "tiles")
    assert extraction.extract(spark, tiles, grids, layers, path, shapes) == 3
    assert [r["id"] for r in extraction.unplaced(tiles, grids).collect()] == [9]
    images = {(r["tile"], r["row"], r["col"]): r["bands"] for r in spark.read.parquet(f"{path}/images").collect()}
    labels = {(r["tile"], r["row"], r["col"]): r["label"] for r in spark.read.parquet(f"{path}/labels").collect()}
    assert len(images) == len(labels) == 48
    for (tile, r, c), bands in images.items():
        if tile == "tile_00003":
            assert bands == pytest.approx([one[b, r + 2, c + 1] / 288 for b in (0, 1)])
        elif tile == "tile_00007":  # the first stack holds its left two columns
            assert bands == pytest.approx([one[b, r, c + 10] / 288 for b in (0, 1)] if c < 2 else [NODATA] * 2)
        else:
            assert bands == pytest.approx([7 / 288] * 2)
        x, y = {"tile_00003": (1, 98), "tile_00007": (10, 100), "tile_00008": (14, 100)}[tile]
        x, y = x + c + 0.5, y - r - 0.5
        assert labels[tile, r, c] == int(2 <= x <= 3.9 and 90 <= y <= 97 or 15.6 <= x <= 16.4 and 97.6 <= y <= 99.4)
    assert extraction.extract(spark, tiles, grids, layers, path, shapes) == 0 and extraction.extract(spark, tiles, grids, layers, path, shapes, overwrite=True) == 3
    assert [tuple(r) for r in extraction.extents(spark, path).collect()][0] == ("tile_00003", 1.0, 94.0, 5.0, 98.0)
    assert extraction.rewrite(spark, path, layers) == 3
    again = {(r["tile"], r["row"], r["col"]): r["bands"] for r in spark.read.parquet(f"{path}/images").collect()}
    assert again["tile_00003", 0, 0] == [math.floor(one[b, 2, 1] / 288 * 255) for b in (0, 1)] and len(again) == 48
    assert extraction.rewrite(spark, str(tmp_path / "none"), layers) == 0 and extraction.extents(spark, str(tmp_path / "none")).count() == 0


def test_label_preparation(spark):
    ring = [(-85.0, 42.0), (-84.99, 42.0), (-84.99, 42.01)]
    labels = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ring])], "id int, ring array<struct<x:double,y:double>>")
    got = extraction.prepared_labels(labels, 4326, 5070).first()
    want = raster.projected_points(spark, ring, 4326, 5070)
    assert np.allclose([(p["x"], p["y"]) for p in got["ring"]], want) and got["minx"] == pytest.approx(min(p[0] for p in want))
    assert extraction.prepared_labels(labels, 4326, 4326).first()["minx"] == -85.0
    for bad, epsg in ((labels.limit(0), 4326), (labels, None)):
        with pytest.raises(ValueError):
            extraction.prepared_labels(bad, epsg, 5070)
    tiles = spark.createDataFrame([(1, 5070), (2, 32616)], "id int, epsg int")
    sets = spark.createDataFrame([(5070, "a.gpkg")], "epsg int, labels string")
    assert {r["id"]: r["labels"] for r in extraction.labels_by_system(tiles, sets).collect()} == {1: "a.gpkg", 2: None}


def test_opened_sources(spark):
    """Imagery stays as it is, others are warped to the stack's grid by their kernel."""
    array = np.arange(16.0).reshape(1, 4, 4)
    grid = grid_of(8, 8, 0.0, 100.0, 0.5)
    source = raster_of(spark, array)
    assert raster.opened(source, grid, "naip", scale_max=2.0).cells is source.cells
    near = {(r["row"], r["col"]): r["bands"][0] for r in raster.opened(source, grid, "dem", "nearest").cells.collect()}
    assert near == {(r, c): array[0, r // 2, c // 2] for r in range(8) for c in range(8)}
    smooth = {(r["row"], r["col"]): r["bands"] for r in raster.opened(source, grid, "dem").cells.collect()}
    for r in range(8):
        for c in range(8):
            assert smooth[r, c] == pytest.approx(plain_bilinear(array, (r + 0.5) / 2 - 0.5, (c + 0.5) / 2 - 0.5))


def test_grown_areas(spark):
    rings = areas.parse("MULTIPOLYGON (((-85 42, -84.99 42, -84.99 42.01, -85 42.01, -85 42), (-84.997 42.003, -84.995 42.003, -84.995 42.005, -84.997 42.003)), ((10 -33, 10.01 -33, 10.01 -32.99, 10 -33)))")
    assert [len(p) for p in raster.grown_polygons(spark, rings)] == [2, 1]
    grown = raster.grown_polygons(spark, rings, 500.0)
    for own, more in zip(areas.polygons(rings), grown):
        assert len(more) == 1 and all(areas.contains(more, x, y) for x, y in own[0])
        minx, miny, maxx, maxy = areas.bounds(own)
        gx0, gy0, gx1, gy1 = areas.bounds(more)
        assert (miny - gy0) * 111_000 == pytest.approx(500, rel=0.02) and (gy1 - maxy) * 111_000 == pytest.approx(500, rel=0.02) and gx0 < minx and gx1 > maxx
    labels = spark.createDataFrame([(0.0, 1e6, 10.0, 1.00001e6), (500.0, 1.0002e6, 700.0, 1.0003e6)], "minx double, miny double, maxx double, maxy double")
    ring = raster.acquisition_ring(labels, 1000.0)
    back = raster.projected_points(spark, ring, 4326, 5070)
    assert areas.bounds([back]) == pytest.approx((-1000, 999_000, 1700, 1_001_300), abs=1e-3)
    assert areas.signed_area(back) == pytest.approx(700 * 300 + 2 * 1000 * 1000 + 4 * 16 * 0.5 * 1e6 * math.sin(math.pi / 32), rel=1e-6)
    with pytest.raises(ValueError):
        raster.acquisition_ring(labels.limit(0))


def test_areas_from_files(tmp_path):
    (tmp_path / "a.json").write_text('{"type": "Polygon", "coordinates": [[[0,0],[0,0],[4,0],[4,4],[0,4],[0,0]]]}')
    assert areas.read(str(tmp_path / "a.json")) == [[(0, 0), (4, 0), (4, 4), (0, 4)]] == areas.read("0,0,4,4")
    (tmp_path / "a.gpkg").write_text("")
    (tmp_path / "empty.txt").write_text("")
    for bad in ("a.gpkg", "empty.txt"):
        with pytest.raises(ValueError):
            areas.read(str(tmp_path / bad))
    with pytest.raises(ValueError):
        areas.read("POLYGON ((0 0, 1 1, 0 0))")


def test_areas_are_written(spark, tmp_path):
    """Composites, manifests and an index; an area without scenes is left out."""
    from tessaline.plans import config, pipelines
    from tessaline.sources import files, manifests

    catalog = spark.sql("select id as item_id, 0 as tile_id, timestamp'2020-04-01' + make_interval(0, id * 3) as ts, 10.0D as cloud_cover, id as ord, 'a' as area from range(3)")
    obs = spark.sql("select s.id as scene, 0 as row, c.id as col, timestamp'2020-04-01' + make_interval(0, s.id * 3) as ts, 4 as scl, 1000.0D * (c.id + 1) as dn, 'a' as area from range(3) s cross join range(2) c cross join range(3) n")
    grids = {"b": grid_of(1, 2), "a": grid_of(1, 2)}
    paths = pipelines.composite_areas(spark, catalog, obs, grids, config.build({"composite": {"years": [2020]}}), str(tmp_path), "2024-01-01T00:00:00Z")
    assert [p.split("/")[-2] for p in paths] == ["a"] and [str(p) for p in manifests.resolve(tmp_path / "index.json")] == paths
    rows = manifests.read_manifests(spark, paths[0]).collect()
    assert files.read_raster(spark, rows[0]["path"]).count() == 2 and rows[0]["band_labels"] == ["SPR", "SUM", "FAL"]
    files.clear_folder(spark, str(tmp_path / "a"))
    assert list((tmp_path / "a").iterdir()) == []
