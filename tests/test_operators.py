"""Operators on small hand-made inputs, against numpy or plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessaline.functions import crs, scalars as S
from tessaline.operators import composite, focal, inference, sampling, scenes, stack, tiles


def values(spark, expr, rows, names):
    return [r[0] for r in spark.createDataFrame(rows, names).select(expr).collect()]


def test_byte_conversion_truncates(spark):
    got = values(spark, S.to_byte(F.col("v")), [(x,) for x in (0.0, 0.25, 0.5, 0.75, 1.0, 0.999, -1.0, 2.0)], ["v"])
    assert got == [0, 63, 127, 191, 255, 254, 0, 255]


def test_window_preparation(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([0.2, 1.2, -9999.0],), ([0.5, -5.0, 2.0],), ([nan, 0.4, 3.0],), ([-9999.0, inf, -inf],)]
    got = values(spark, S.prepared(F.col("b"), 4, byte_scale=True), rows, "b array<double>")
    want = [[0.2, 1, 0, 0], [0.5, 0, 1, 0], [0, 0.4, 1, 0], [0, 1, 0, 0]]
    assert np.allclose(got, np.array(want) / 255)


def test_mask_sets(spark):
    rows = [(x,) for x in (4, 5, 6, 7, 9)]
    assert values(spark, S.is_clear(F.col("v"), [6]), rows, ["v"]) == [True, True, False, True, True]
    assert values(spark, S.is_clear(F.col("v"), []), rows, ["v"]) == [True] * 5
    assert values(spark, S.is_clear(F.col("v")), rows, ["v"]) == [True, True, True, True, False]


def test_unknown_names_are_errors(spark):
    for expr in (S.corner(F.lit("xx"), 5, 5), S.season_start(F.lit(2020), F.lit("WIN"))):
        with pytest.raises(Exception, match="Un"):
            spark.range(1).select(expr).collect()


def test_ties_go_to_the_lowest_class(spark):
    rows = [([0.5, 0.5],), ([0.2, 0.8],)]
    assert values(spark, S.class_of(F.col("p")), rows, "p array<double>") == [0, 1]
    assert values(spark, S.class_of(F.col("p"), 0.5), rows, "p array<double>") == [1, 1]


def test_dilation_is_a_square(spark):
    rows = [(0, r, c, int(r == 5 and c == 5)) for r in range(10) for c in range(10)]
    out = composite.dilated(spark.createDataFrame(rows, ["scene", "row", "col", "cloudy"]), 2, ["scene"])
    assert out.agg(F.sum("cloudy")).first()[0] == 25


def test_median_rules(spark):
    """Even counts interpolate, too few clear observations give null, and a season is clipped only when it exceeds [0, 1] clearly."""
    at = "timestamp'2020-06-15'"
    obs = [(0, 0, 4, v) for v in (1000.0, 2000.0, 10000.0, 20000.0)] + [(0, 1, 4, 10005.0)] * 3 + [(0, 2, 9, 1.0)] * 5 + [(0, 2, 4, 1.0)] * 2
    df = spark.createDataFrame(obs, ["row", "col", "scl", "dn"]).withColumn("ts", F.expr(at))
    got = {r["col"]: (r["n_clear"], r["value"]) for r in composite.seasonal_median(df).collect()}
    assert got[0] == (4, pytest.approx(0.6)) and got[1] == (3, pytest.approx(1.0005)) and got[2] == (2, None)
    more = df.unionByName(spark.createDataFrame([(0, 3, 4, 10020.0)] * 3, ["row", "col", "scl", "dn"]).withColumn("ts", F.expr(at)))
    got = {r["col"]: r["value"] for r in composite.seasonal_median(more).collect()}
    assert got[1] == 1.0 and got[3] == 1.0 and got[2] is None
    assert composite.seasonal_median(df.limit(0)).count() == 0


def python_best(items, most):
    """A plain model of tile-aware selection; items: (id, tile, cover or None, ord)."""
    if most is None or most >= len(items):
        return {i[0] for i in items}
    cover = lambda i: (100.0 if i[2] is None else i[2], i[3])
    order = list(dict.fromkeys(i[1] for i in sorted(items, key=lambda i: i[3])))
    each = max(1, most // (2 * len(order)))
    chosen = []
    for tile in order:
        own = sorted((i for i in items if i[1] == tile), key=cover)
        chosen += own[: min(each, most - len(chosen))]
    rest = sorted((i for i in items if i not in chosen), key=cover)
    return {i[0] for i in chosen + rest[: most - len(chosen)]}


@pytest.mark.parametrize("seed", range(6))
def test_best_scenes(spark, seed):
    draw = random.Random(seed)
    items = [(k, draw.randrange(1 + seed), draw.choice([None, *map(float, range(0, 90, 7))]), k) for k in range(40)]
    df = spark.createDataFrame(items, "item_id int, tile_id int, cloud_cover double, ord int")
    for most in (1, 4, 13, 60):
        got = scenes.best_scenes(df, most).orderBy("place").collect()
        assert {r["item_id"] for r in got} == python_best(items, most)
        covers = [100.0 if r["cloud_cover"] is None else r["cloud_cover"] for r in got]
        assert covers == sorted(covers) if most < len(items) else [r["ord"] for r in got] == list(range(len(items)))


@pytest.mark.parametrize("radius", [1, 4])
def test_focal_operators_against_numpy(spark, radius):
    draw = np.random.default_rng(1234)
    z = draw.uniform(0, 50, (14, 17))
    z[5:7, 8:10] = np.nan
    rows = [(r, c, None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(14) for c in range(17)]
    df = spark.createDataFrame(rows, "row int, col int, z double")
    padded = np.pad(z, radius, mode="edge")
    want = np.array([[np.nanmean(padded[r : r + 2 * radius + 1, c : c + 2 * radius + 1]) for c in range(17)] for r in range(14)])
    out = focal.slope(focal.box_mean(df, radius), 2.0).collect()
    gy, gx = np.gradient(z, 2.0)
    slope = np.degrees(np.arctan(np.hypot(gx, gy)))
    for r in out:
        assert r["box_mean"] == pytest.approx(want[r["row"], r["col"]], abs=1e-9)
        expected = slope[r["row"], r["col"]]
        assert (r["slope"] is None) == bool(np.isnan(expected))
        if r["slope"] is not None:
            assert r["slope"] == pytest.approx(expected, abs=1e-9)


def test_offsets_cover(spark):
    for size, window, overlap in ((10, 4, 2), (7, 10, 3), (11, 4, 4), (512, 512, 256), (100, 30, 7)):
        got = spark.range(1).select(tiles.offsets(F.lit(size), F.lit(window), F.lit(overlap))).first()[0]
        step = max(window - overlap, 1)
        want = [0] if size <= window else sorted({*range(0, size - window + 1, step), size - window})
        assert got == want


def test_spatial_joins_against_all_pairs(spark):
    draw = random.Random(5)
    box = lambda k, span: (k, *(lambda x, y, w: (x, y, x + w, y + w))(draw.uniform(0, 6000), draw.uniform(0, 6000), draw.uniform(1, span)))
    a, b = [box(k, 900) for k in range(60)], [box(k, 2500) for k in range(40)]
    names = "id int, minx double, miny double, maxx double, maxy double"
    left, right = spark.createDataFrame(a, names), spark.createDataFrame(b, names)
    touch = lambda p, q: p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2]
    gap = lambda p, q: np.hypot(max(0, p[1] - q[3], q[1] - p[3]), max(0, p[2] - q[4], q[2] - p[4]))
    assert {r["id"] for r in tiles.semi(left, right).collect()} == {p[0] for p in a if any(touch(p, q) for q in b)}
    assert {r["id"] for r in tiles.anti(left, right, 150.0).collect()} == {p[0] for p in a if all(gap(p, q) >= 150 for q in b)}
    first = {r["id"]: r["manifest_ord"] for r in tiles.first_match(left, right.withColumn("ord", F.col("id"))).collect()}
    assert first == {p[0]: min(q[0] for q in b if touch(p, q)) for p in a if any(touch(p, q) for q in b)}


def test_balanced_sampling(spark):
    ids = lambda low, high: spark.range(low, high).select("id")
    got = sampling.balanced(ids(0, 10), ids(10, 100), 2.0).collect()
    again = sampling.balanced(ids(0, 10), ids(10, 100), 2.0).collect()
    assert sorted(got) == sorted(again) and len({r["id"] for r in got}) == 30
    assert sampling.balanced(ids(0, 10), ids(10, 15), 2.0).count() == 15
    assert sampling.balanced(ids(0, 0), ids(10, 15), 2.0).count() == 5


@pytest.mark.parametrize("diagonal", [False, True])
def test_regions(spark, diagonal):
    draw = np.random.default_rng(2)
    grid = draw.random((12, 15)) < 0.5
    rows = [(int(r), int(c)) for r, c in zip(*np.nonzero(grid))]
    got = {(r["row"], r["col"]): r["region"] for r in inference.regions(spark.createDataFrame(rows, "row int, col int"), 15, diagonal).collect()}
    parent = {p: p for p in rows}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r, c in rows:
        for dr, dc in [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if diagonal else []):
            if (r + dr, c + dc) in parent:
                a, b = find((r, c)), find((r + dr, c + dc))
                parent[max(a, b)] = min(a, b)
    assert got == {p: find(p)[0] * 15 + find(p)[1] for p in rows}


def test_long_regions(spark):
    """A line that winds through 10,000 cells, and one cell beside it."""
    side, cells, row, col = 199, [], 0, 0
    for k in range(0, side, 2):
        cells += [(k, c) for c in range(side // 2)]
        cells.append((k + 1, side // 2 - 1 if k % 4 == 0 else 0))
    cells = cells[:10_000] + [(300, 5)]
    got = inference.regions(spark.createDataFrame(cells, "row int, col int"), 200).groupBy("region").count().collect()
    assert sorted(map(tuple, got)) == [(0, len(set(cells)) - 1), (300 * 200 + 5, 1)]


def test_windows_of_a_pixel(spark):
    """The closed form against all starts."""
    for size, window, overlap in ((10, 4, 2), (7, 10, 3), (11, 4, 4), (23, 5, 0), (100, 30, 7), (9, 2, -1), (50, 8, -4)):
        step = max(window - overlap, 1)
        starts = [0] if size <= window else sorted({*range(0, size - window + 1, step), size - window})
        rows = spark.range(-2, size + 2).select("id", tiles.holding(F.col("id"), size, window, overlap).alias("o")).collect()
        for r in rows:
            assert sorted(r["o"]) == [o for o in starts if o <= r["id"] < o + window and 0 <= r["id"] < size], (size, window, overlap, r)


def test_bilinear_skips_missing(spark):
    source = spark.createDataFrame([(0, 0, 1.0), (0, 1, None), (1, 0, 3.0), (1, 1, 5.0)], "row int, col int, z double")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.0, 0.0), (3, 9.0, 9.0)], "id int, y double, x double")
    assert {r["id"]: r["value"] for r in stack.bilinear(source, points).collect()} == {1: pytest.approx(3.0), 2: 1.0, 3: None}
    with pytest.raises(ValueError):
        stack.read_window(spark, [(source, 1)], 0, 0, 0, 4)


def test_projections(spark):
    """Published worked examples: Albers on the Clarke ellipsoid differs slightly, so its inverse is tested; UTM at a known point."""
    x, y = crs.to_albers(F.col("lon"), F.col("lat"))
    lon, lat = crs.from_albers(F.col("x"), F.col("y"))
    df = spark.createDataFrame([(-75.0, 35.0), (-96.0, 23.0), (-120.5, 48.25)], ["lon", "lat"]).withColumns({"x": x, "y": y})
    for r in df.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9) and r["lat2"] == pytest.approx(r["lat"], abs=1e-9)
        if r["lon"] == -96.0:
            assert r["x"] == pytest.approx(0, abs=1e-6) and r["y"] == pytest.approx(0, abs=1e-6)
    east, north = crs.to_utm(F.lit(-87.0), F.lit(40.0))
    got = spark.range(1).select(east, north, crs.utm_epsg(F.lit(-87.0), F.lit(40.0))).first()
    assert got[0] == pytest.approx(500000, abs=1e-3) and got[1] == pytest.approx(4427757.22, abs=0.05) and got[2] == 32616
