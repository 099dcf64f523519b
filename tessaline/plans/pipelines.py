"""End-to-end plans: each is one lazy DataFrame plan over all areas, seasons and tiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import composite, extraction, focal, inference, raster, sampling, scenes, stack
from ..sources import files, manifests
from ..sources.manifests import Grid
from .config import ConfigurationError, Settings


def composite_stack(catalog: DataFrame, observations: DataFrame, settings: Settings) -> DataFrame:
    """row, col, bands: the seasons' medians of each season's best scenes, in order, for pixels that every season covers.

    The limit on scenes holds for each season on its own, over all its years, so no season is left without scenes for another.
    """
    own = settings.composite
    years = own.years or [r[0] for r in catalog.select(F.year("ts")).distinct().orderBy(F.year("ts")).collect()]  # a few years
    chosen = None
    for season in own.seasons:
        found = scenes.fetch_items(catalog, [(y, season) for y in years], own.cloud_cover)
        if own.max_scenes:
            found = scenes.best_scenes(found, own.max_scenes)
        found = found.select(F.col("item_id").alias("scene"))
        chosen = found if chosen is None else chosen.unionByName(found)
    seen = observations.join(chosen, "scene", "left_semi")
    if own.dilation:
        cloudy = seen.withColumn("cloudy", F.when(S.is_observed(F.col("scl"), F.col("dn")), 0).otherwise(1))
        spread = composite.dilated(cloudy, own.dilation, ["scene"])
        seen = spread.withColumn("scl", F.when(F.col("cloudy") == 1, 3).otherwise(F.col("scl"))).drop("cloudy")
    medians = composite.seasonal_median(seen, own.min_clear)
    whole = composite.complete(medians, ["row", "col"], own.seasons)
    return composite.concatenated(medians, ["row", "col"], own.seasons).join(whole, ["row", "col"], "left_semi")


def composite_areas(spark, catalog: DataFrame, observations: DataFrame, grids: dict[str, Grid], settings: Settings, out: str, created_utc: str) -> list[str]:
    """A composite, as a raster, and its manifest for each area (a column of both tables) that has scenes, and their index.

    The number of areas is that of the orders, not of the data; each area is a plan of its own, so that one without scenes or
    without whole pixels is left out and the others are written. The manifests' paths, in the areas' order.
    """
    from pathlib import Path

    paths = []
    for name, grid in grids.items():
        bands = composite_stack(catalog.where(F.col("area") == name), observations.where(F.col("area") == name), settings)
        if bands.isEmpty():
            continue
        folder = Path(out) / name
        folder.mkdir(parents=True, exist_ok=True)
        labels = settings.composite.seasons
        files.write_raster(bands, str(folder / "composite"), labels)
        source = manifests.Source("sentinel2", str(folder / "composite"), tuple(labels))
        (folder / "stack.json").write_text(manifests.manifest_json(grid, [source], created_utc), encoding="utf-8")
        paths.append(str(folder / "stack.json"))
    if paths:
        (Path(out) / "index.json").write_text(manifests.index_json(paths, created_utc), encoding="utf-8")
    return paths


def training_tiles(grid: DataFrame, labels: DataFrame, inventory: DataFrame, settings: Settings) -> DataFrame:
    own = settings.sampling
    return sampling.training_manifest(grid, labels, inventory, own.margin, own.ratio, own.seed)


def predicted_regions(pixels: DataFrame, height: int, width: int, scorer: Callable[[DataFrame], Column], settings: Settings, nodata: float | None = S.NODATA) -> tuple[DataFrame, DataFrame]:
    """The class of each pixel (row, col, class_id), and the boxes of its regions of at least min_area cells."""
    own = settings.inference
    ready = pixels.withColumn("valid", S.is_valid_pixel(F.col("bands"), nodata, 4)).withColumn("bands", F.transform("bands", lambda v: S.normalised(v)))
    scores = inference.window_scores(ready, height, width, own.window, own.overlap, scorer)
    mean = inference.averaged(scores, own.classes).join(ready.select("row", "col", "valid"), ["row", "col"])
    mask = inference.finalised(mean, F.col("valid"), own.threshold).select("row", "col", "class_id")
    return mask, inference.region_boxes(inference.regions(mask.where("class_id > 0"), width), own.min_area)


def model_input(spark, sources: list[tuple[DataFrame, int]], window: tuple[int, int, int, int], channels: int) -> DataFrame:
    """A window of the stack as bytes: row, col, bands (0 to 255)."""
    read = stack.read_window(spark, sources, *window)
    return read.select("row", "col", F.transform(S.prepared(F.col("bands"), channels), S.to_byte).alias("bands"))


def topography(dems: list[raster.Raster], grid: Grid, small: float = 30.0, large: float = 150.0) -> raster.Raster:
    """Terrain bands on a grid: the elevation tiles mosaicked, warped to the grid, and derived there; no tiles are an error."""
    if not dems:
        raise FileNotFoundError("There are no elevation tiles")
    surface = raster.warped(raster.mosaic(dems), grid)
    z = F.when(F.col("bands")[0] != grid.nodata, F.col("bands")[0])
    bands = focal.terrain_bands(surface.cells.select("row", "col", z.alias("z")), grid.transform[0], small, large, grid.nodata)
    return raster.Raster(bands, grid, ("Slope", "TPI_small", "TPI_large", "Depression_Depth"))


def training_pairs(spark, grid: DataFrame, labels: DataFrame, inventory: DataFrame, stacks: DataFrame, layers: list[raster.Layer], path: str, settings: Settings, overwrite: bool = False) -> int:
    """Balanced tiles of a grid, cut from their stacks with their labels below path; the number of tiles written."""
    chosen = training_tiles(grid, labels, inventory, settings)
    return extraction.extract(spark, chosen, stacks, layers, path, labels, overwrite)


def inferred(pixels: DataFrame, height: int, width: int, model: Callable, settings: Settings, channels: int, nodata: float | None = S.NODATA, first: int | None = None, byte_scale: bool = False) -> DataFrame:
    """row, col and class_id from a vectorised model over overlapping windows; pixels without data are class 0.

    first: the number of bands, from the first on, one of which must have data (a stack's base source); None asks all bands.
    """
    own = settings.inference
    ready = pixels.select("row", "col", S.is_valid_pixel(F.col("bands"), nodata, first).alias("valid"), S.prepared(F.col("bands"), channels, S.NODATA if nodata is None else nodata, byte_scale).alias("bands"))
    scores = inference.model_scores(ready, height, width, own.window, own.overlap, model, channels, own.classes)
    mean = inference.averaged(scores, own.classes).join(ready.select("row", "col", "valid"), ["row", "col"])
    return inference.finalised(mean, F.col("valid"), own.threshold).select("row", "col", "class_id")


def infer_stack(spark, layers: list[raster.Layer], grid: Grid, model: Callable, settings: Settings, channels: int | None = None) -> DataFrame:
    """The classes of a stack's cells; validity follows its imagery source, where it has one."""
    cells = raster.read_window(spark, layers, grid, 0, 0, grid.height, grid.width)
    imagery = next((len(x.labels) for x in layers if x.type == "naip"), None)
    n = raster.channels(tuple(label for x in layers for label in x.labels), channels)
    return inferred(cells, grid.height, grid.width, model, settings, n, S.NODATA, imagery)


def infer_raster(source: raster.Raster, model: Callable, settings: Settings, channels: int | None = None) -> DataFrame:
    """The classes of one raster's cells, scaled as models of the older tiles expect."""
    return inferred(source.cells, source.grid.height, source.grid.width, model, settings, raster.channels(source.labels, channels), source.grid.nodata, byte_scale=True)


def infer_to(mask: DataFrame, grid: Grid, settings: Settings, source: str, mask_path: str | None = None, vector_path: str | None = None, tolerance: float | None = None) -> tuple[str, str]:
    """Write a mask and the outlines of its regions of at least min_area cells, beside their source unless told; the two paths."""
    mask_to, vector_to = files.output_paths(source, "unet_predictions", mask_path, vector_path)
    files.write_raster(mask.select("row", "col", F.array(F.col("class_id").cast("double")).alias("bands")), mask_to, ["class"], 0.0)
    cells = inference.regions(mask.where("class_id > 0"), grid.width)
    large = cells.join(inference.region_boxes(cells, settings.inference.min_area).select("region"), "region", "left_semi")
    shapes = inference.outlines(large, settings.inference.tolerance if tolerance is None else tolerance, (grid.transform[2], grid.transform[5]), grid.transform[0])
    files.write_vectors(shapes.withColumnRenamed("rings", "geometry"), vector_to, int(grid.crs.split(":")[-1]))
    return mask_to, vector_to


def onnx_model(path: str) -> Callable:
    """A model for inferred() from an ONNX file, opened once per worker."""
    def run(array):
        try:
            import onnxruntime
        except ImportError as error:
            raise ConfigurationError("ONNX models need the package onnxruntime") from error
        if path not in _SESSIONS:
            _SESSIONS[path] = onnxruntime.InferenceSession(path)
        session = _SESSIONS[path]
        return session.run(None, {session.get_inputs()[0].name: array[None]})[0][0]

    return run


_SESSIONS: dict = {}
