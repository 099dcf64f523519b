"""Manifests, areas, files, settings and the streaming addition."""

import json

import pytest
from pyspark.sql import functions as F

from tessaline.operators import composite
from tessaline.plans import config, pipelines
from tessaline.sources import areas, files, manifests
from tessaline.streaming import incremental

GRID = manifests.Grid("EPSG:32616", (1.0, 0.0, 500000.0, 0.0, -1.0, 4500000.0), 64, 32)


def test_manifest_round_trip(spark, tmp_path):
    sources = [manifests.Source("naip", "a.tif", ("R", "G"), {"scale_max": 255.0}), manifests.Source("s2", "b.tif")]
    (tmp_path / "one.json").write_text(manifests.manifest_json(GRID, sources, "2024-01-01T00:00:00Z"))
    rows = manifests.read_manifests(spark, str(tmp_path / "one.json")).orderBy("place").collect()
    assert [(r["type"], r["band_labels"], r["scale_max"], r["nodata"], r["resample"]) for r in rows] == [("naip", ["R", "G"], 255.0, -9999.0, "bilinear"), ("s2", [], None, -9999.0, "bilinear")]
    assert rows[0]["grid"]["pixel_size"] == [1.0, 1.0] and GRID.bounds() == (500000.0, 4499968.0, 500064.0, 4500000.0)
    broken = json.loads(manifests.manifest_json(GRID, sources, "x"))
    del broken["sources"][0]["path"]
    (tmp_path / "two.json").write_text(json.dumps(broken))
    with pytest.raises(Exception, match="Incomplete manifest"):
        manifests.read_manifests(spark, str(tmp_path / "two.json")).collect()


def test_resolving_manifests(tmp_path):
    own = manifests.manifest_json(GRID, [], "x")
    (tmp_path / "sub").mkdir()
    for name in ("B.json", "a.json", "sub/c.json"):
        (tmp_path / name).write_text(own)
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "index.json").write_text(manifests.index_json(["sub/c.json", "a.json", "index.json"], "x"))
    names = lambda p: [x.name for x in manifests.resolve(tmp_path / p)]
    assert names("a.json") == ["a.json"] and names("index.json") == ["c.json", "a.json"]
    assert names(".") == ["a.json", "B.json", "c.json"]
    for missing in ("nothing.json", "bad.json"):
        with pytest.raises(FileNotFoundError):
            manifests.resolve(tmp_path / missing)


@pytest.mark.parametrize(
    "text", ["0,0,2,1", "[0, 0, 2, 1]", "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))", '{"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,1],[0,1],[0,0]]]}', '{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[2,0],[2,1],[0,1],[0,0]]]]}}']
)
def test_areas(text):
    rings = areas.parse(text)
    assert areas.bounds(rings) == (0, 0, 2, 1) and len(rings) == 1 and len(rings[0]) == 4
    assert areas.grown_box(rings, 0) == areas.box(0, 0, 2, 1)
    assert areas.grown_box(rings, 1000)[0][0] < 0


def test_bad_areas():
    for text in ("", "LINESTRING (0 0, 1 1)", "[1, 2]"):
        with pytest.raises(ValueError):
            areas.parse(text)
    assert len(areas.hull([(0, 0), (1, 0), (1, 1), (0, 1), (0.5, 0.5)])) == 4


def test_holes_are_kept():
    square, hole = "(0 0, 4 0, 4 4, 0 4, 0 0)", "(1 1, 2 1, 2 2, 1 2, 1 1)"
    texts = [
        f"POLYGON ({square}, {hole})",
        f"MULTIPOLYGON (({square}, {hole}))",
        '{"type": "Polygon", "coordinates": [[[0,0],[0,4],[4,4],[4,0],[0,0]], [[1,1],[2,1],[2,2],[1,2],[1,1]]]}',
    ]
    for text in texts:
        rings = areas.parse(text)
        assert areas.area(rings) == 15 and areas.bounds(rings) == (0, 0, 4, 4)
        assert areas.contains(rings, 3, 3) and not areas.contains(rings, 1.5, 1.5) and not areas.contains(rings, 5, 1)
    two = areas.parse(f"MULTIPOLYGON (({square}), ((10 0, 12 0, 12 2, 10 2, 10 0)))")
    assert areas.area(two) == 20 and areas.contains(two, 11, 1)


def test_raster_round_trip(spark, tmp_path):
    cells = spark.range(40).select((F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"), F.array(F.col("id") * 1.0, F.lit(None).cast("double")).alias("bands"))
    path = str(tmp_path / "raster")
    files.write_raster(cells, path, ["one", "two"], block=2)
    got = files.read_raster(spark, path, 2, (1, 2, 3, 2)).orderBy("row", "col").collect()
    assert [r["bands"] for r in got] == [[8.0 * r + c, -9999.0] for r in (1, 2, 3) for c in (2, 3)]
    assert files.band_labels(spark, path) == ["one", "two"]
    with pytest.raises(ValueError):
        files.write_raster(cells, path, ["one"])
    with pytest.raises(ValueError):
        files.write_report(cells.limit(0), path, ["row"])


def test_files_and_products(tmp_path):
    for name in ("b.tif", "a.tif", "c.tiff", "d.txt"):
        (tmp_path / name).write_text("")
    assert [p.name for p in files.list_rasters([tmp_path, tmp_path / "a.tif"])] == ["a.tif", "b.tif", "c.tiff"]
    assert files.output_paths("/x/stack.json", "unet")[0] == "/x/predictions/stack_unet.tif"
    payload = json.dumps({"items": [{"title": "t", "urls": [{"URL": "http://x"}], "unitSize": 3}, {"id": "n"}, {"id": "m", "downloadURL": "https://y"}]})
    assert files.dem_products(payload) == [{"product_id": "t", "download_url": "http://x", "size": 3}, {"product_id": "m", "download_url": "https://y", "size": 0}]


def test_settings_precedence_and_checks():
    own = config.build({"inference": {"window": 64, "overlap": 8}, "paths": {"out": "x"}}, {"inference": {"window": 32}})
    assert own.inference.window == 32 and own.inference.overlap == 8 and own.tiling.tile_size == 512 and own.paths["out"] == "x"
    for bad in ({"inference": {"overlap": 600}}, {"tiling": {"stride": 0}}, {"tiling": {"stride": 600}}, {"nothing": {}}, {"composite": {"seasons": ["WIN"]}}, {"sampling": {"ratio": 0}}, {"model": {"channels": 0}}, {"training": {"validation": 1.0}}, {"training": {"target_size": (0, 4)}}, {"training": {"resize": "crop"}}, {"topography": {"resolution": "5m"}}, {"topography": {"small": 0}}, {"inference": {"tolerance": -1}}):
        with pytest.raises(config.ConfigurationError):
            config.build(bad)


def test_composite_plan(spark):
    catalog = spark.sql("select id as item_id, 0 as tile_id, timestamp'2020-04-01' + make_interval(0, id * 3) as ts, 10.0D as cloud_cover, id as ord from range(3)")
    obs = spark.sql("select s.id as scene, 0 as row, c.id as col, timestamp'2020-04-01' + make_interval(0, s.id * 3) as ts, 4 as scl, 1000.0D * (c.id + 1) as dn from range(3) s cross join range(2) c cross join range(3) n")
    got = pipelines.composite_stack(catalog, obs, config.build({"composite": {"years": [2020]}})).orderBy("col").collect()
    assert [r["bands"] for r in got] == [pytest.approx([0.1] * 3), pytest.approx([0.2] * 3)]


def test_each_season_has_its_own_scenes(spark):
    """Three seasons of one area under a limit of scenes: none is left out."""
    catalog = spark.sql("select id as item_id, 0 as tile_id, timestamp'2020-04-01' + make_interval(0, cast(id / 4 as int) * 3) as ts, cast(id as double) as cloud_cover, id as ord from range(12)")
    obs = spark.sql("select s.id as scene, 0 as row, 0 as col, timestamp'2020-04-01' + make_interval(0, cast(s.id / 4 as int) * 3) as ts, 4 as scl, 1000.0D as dn from range(12) s")
    got = pipelines.composite_stack(catalog, obs, config.build({"composite": {"years": [2020], "max_scenes": 3}})).collect()
    assert [r["bands"] for r in got] == [pytest.approx([0.1] * 3)]


def test_streaming_matches_batch(spark, tmp_path):
    obs = spark.sql("select cast(id % 5 as int) as row, 0 as col, timestamp'2020-06-01' + make_interval(0, 0, 0, cast(id as int) % 50) as ts, 4 as scl, cast(id as double) * 300 + 1 as dn, id as scene from range(60)")
    for k in range(2):
        obs.where(f"scene % 2 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.distinct_observations(incremental.read_observations(spark, str(tmp_path / "in"), obs.schema), ["scene"])
    job = stream.writeStream.foreachBatch(incremental.refresh(str(tmp_path / "store"), str(tmp_path / "out"), block=2)).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    job.awaitTermination(120)
    for clip in (True, False):
        got = incremental.current(spark, str(tmp_path / "out"), clip)
        want = composite.seasonal_median(obs, clip=clip)
        assert sorted(got.select("row", "n_clear", "value").collect()) == sorted(want.select("row", "n_clear", "value").collect())
