"""Rasters as tables of cells on a grid: windows of stacks, resampling, reprojection, mosaics and clips."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, geometry as G, scalars as S
from ..sources import areas
from ..sources.manifests import Grid

# Fixed values.
IMAGERY_LABELS = ["Red", "Green", "Blue", "NIR"]


@dataclass(frozen=True)
class Layer:
    """One source of a stack: cells (row, col, bands; stack, where there are several stacks) and how its values are read."""

    cells: DataFrame
    labels: tuple[str, ...]
    nodata: float | None = S.NODATA
    scale_max: float | None = None
    scale_min: float | None = None
    band_scaling: dict[str, tuple[float, float]] | None = None
    type: str = "raster"

    def values(self, bands: Column) -> Column:
        """The bands as the stack shows them: nodata in its own value, the rest scaled.

        Bands with a range of their own use it, others of such a source stay as they are; else the source's range holds, from
        scale_min, or from 0, to scale_max. Ranges without extent scale nothing.
        """
        out = []
        for k, label in enumerate(self.labels):
            v = F.coalesce(F.get(bands, F.lit(k)).cast("double"), F.lit(S.NODATA))
            own = v
            if self.band_scaling:
                low, high = self.band_scaling.get(label, (0.0, 0.0))
                own = (v - low) / (high - low) if high > low else v
            elif self.scale_max is not None and self.scale_min is not None:
                own = (v - self.scale_min) / (self.scale_max - self.scale_min) if self.scale_max > self.scale_min else v
            elif self.scale_max is not None:
                own = v / self.scale_max
            missing = v == S.NODATA if self.nodata is None else (v == S.NODATA) | (v == self.nodata)
            out.append(F.when(missing, S.NODATA).otherwise(own))
        return F.array(*out)


def window_cells(windows: DataFrame) -> DataFrame:
    """windows (row_off, col_off, height, width: fractions allowed; grid_h, grid_w) once for each of their cells.

    row and col count from the window's corner; at_row and at_col are the grid's cell that lies there, null outside the grid.
    A window is as many cells high and wide as its size, rounded up. The grid's cells that it touches are laid from the whole
    cell that its corner rounds to (halves to even) on, and cut at its end. Windows without height or width are an error.
    """
    out = windows
    for off, size, most, name in (("row_off", "height", "grid_h", "row"), ("col_off", "width", "grid_w", "col")):
        first = F.greatest(F.floor(off), F.lit(0))
        beyond = F.least(F.ceil(F.col(off) + F.col(size)), F.col(most))
        n = F.when(F.ceil(size) > 0, F.ceil(size)).otherwise(F.raise_error(F.lit("window must have a positive height and width")).cast("long"))
        at = F.col(name) + first - F.rint(first - F.col(off)).cast("long")
        out = out.withColumn(name, F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
        out = out.withColumn(f"at_{name}", F.when((at >= first) & (at < beyond), at.cast("int")))
    return out


def read_windows(windows: DataFrame, layers: list[Layer], keys: list[str]) -> DataFrame:
    """keys, row, col and bands of each window's cells: the layers' bands in order, nodata where a layer has no cell.

    All joins are on the grid's cell, so the windows' cells are shuffled once and each layer once; nothing is broadcast.
    """
    at = ["stack", "at_row", "at_col"] if "stack" in windows.columns else ["at_row", "at_col"]
    out = window_cells(windows).select(*dict.fromkeys([*keys, "row", "col", *at]))
    lists = []
    for k, layer in enumerate(layers):
        names = [F.col(c.removeprefix("at_")).alias(c) for c in at]
        cells = layer.cells.select(*names, layer.values(F.col("bands")).alias(f"s{k}"))
        out = out.join(cells, at, "left")
        lists.append(F.coalesce(f"s{k}", F.array_repeat(F.lit(S.NODATA), len(layer.labels))))
    return out.select(*keys, "row", "col", F.concat(*lists).alias("bands"))


def read_window(spark: SparkSession, layers: list[Layer], grid: Grid, row_off: float, col_off: float, height: float, width: float) -> DataFrame:
    """row, col and bands of one window; only the cells that it touches are read from the layers."""
    if math.ceil(height) <= 0 or math.ceil(width) <= 0:
        raise ValueError("window must have a positive height and width")
    inside = F.col("row").between(math.floor(row_off), math.ceil(row_off + height) - 1) & F.col("col").between(math.floor(col_off), math.ceil(col_off + width) - 1)
    near = [replace(x, cells=x.cells.where(inside)) for x in layers]
    values = (row_off, col_off, height, width)
    one = spark.range(1).select(*(F.lit(float(v)).alias(n) for n, v in zip(("row_off", "col_off", "height", "width"), values)), F.lit(grid.height).alias("grid_h"), F.lit(grid.width).alias("grid_w"))
    return read_windows(one, near, [])


def window_of_bounds(grid: dict[str, Column]) -> dict[str, Column]:
    """The window of a box (minx, miny, maxx, maxy) on a north-up grid whose a, c, e and f are columns."""
    a, c, e, f = (grid[k] for k in "acef")
    return {
        "row_off": (F.col("maxy") - f) / e, "col_off": (F.col("minx") - c) / a,
        "height": (F.col("miny") - F.col("maxy")) / e, "width": (F.col("maxx") - F.col("minx")) / a,
    }


@dataclass(frozen=True)
class Raster:
    """Cells (row, col, bands), their grid and band labels; epsg is None where the reference system is unknown."""

    cells: DataFrame
    grid: Grid
    labels: tuple[str, ...]

    @property
    def epsg(self) -> int | None:
        return int(self.grid.crs.split(":")[-1]) if self.grid.crs else None

    @property
    def resolution(self) -> float:
        return self.grid.transform[0]


def grid_over(bounds: tuple[float, float, float, float], resolution: float, like: Grid, epsg: int) -> Grid:
    """The north-up grid from the upper left of the bounds on, whose cells cover them."""
    minx, miny, maxx, maxy = bounds
    size = lambda low, high: max(1, math.ceil((high - low) / resolution - 1e-9))
    return replace(like, crs=f"EPSG:{epsg}", transform=(resolution, 0.0, minx, 0.0, -resolution, maxy), width=size(minx, maxx), height=size(miny, maxy))


def interpolated(source: Raster, targets: DataFrame) -> DataFrame:
    """targets (row, col; y, x: fractional row and column of the source) with bands: the four neighbours' weighted mean by band.

    Neighbours that are missing or nodata are left out of a band's weights; a band without any is nodata.
    """
    r0, c0 = F.floor("y"), F.floor("x")
    fr, fc = F.col("y") - r0, F.col("x") - c0
    corner = lambda dr, dc: F.struct((r0 + dr).cast("int").alias("sr"), (c0 + dc).cast("int").alias("sc"), ((fr if dr else 1 - fr) * (fc if dc else 1 - fc)).alias("weight"))
    spread = targets.select("row", "col", F.explode(F.array(*(corner(dr, dc) for dr in (0, 1) for dc in (0, 1)))).alias("p")).select("row", "col", "p.*").where("weight > 0")
    met = spread.join(source.cells.select(F.col("row").alias("sr"), F.col("col").alias("sc"), "bands"), ["sr", "sc"], "left")
    nodata, aggregates = source.grid.nodata, []
    for k in range(len(source.labels)):
        v = F.get("bands", F.lit(k))
        held = F.when(v.isNotNull() & (v != nodata), F.col("weight"))
        aggregates += [F.sum(v * held).alias(f"v{k}"), F.sum(held).alias(f"w{k}")]
    sums = met.groupBy("row", "col").agg(*aggregates)
    return sums.select("row", "col", F.array(*(F.coalesce(F.col(f"v{k}") / F.col(f"w{k}"), F.lit(nodata)) for k in range(len(source.labels)))).alias("bands"))


def grid_rows(spark: SparkSession, grid: Grid) -> DataFrame:
    """All cells of a grid with their centres: row, col, px, py."""
    cells = spark.range(grid.height).select(F.col("id").cast("int").alias("row")).select("row", F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1))).alias("col"))
    x, y = S.pixel_centre(F.col("row"), F.col("col"), grid.transform[2], grid.transform[5], grid.transform[0])
    return cells.select("row", "col", x.alias("px"), y.alias("py"))


def contained(source: Raster, targets: DataFrame) -> DataFrame:
    """targets (row, col; y, x) with the bands of the source's cell that holds each; nodata outside."""
    at = targets.select("row", "col", F.floor(F.col("y") + 0.5).cast("int").alias("sr"), F.floor(F.col("x") + 0.5).cast("int").alias("sc"))
    met = at.join(source.cells.select(F.col("row").alias("sr"), F.col("col").alias("sc"), "bands"), ["sr", "sc"], "left")
    return met.select("row", "col", F.coalesce("bands", F.array_repeat(F.lit(source.grid.nodata), len(source.labels))).alias("bands"))


def warped(source: Raster, grid: Grid, kernel: str = "bilinear") -> Raster:
    """The source on another grid, bilinear or nearest; the grid may be of another reference system."""
    if source.epsg is None:
        raise ValueError("The raster lacks a reference system")
    target = int(grid.crs.split(":")[-1])
    cells = crs.moved(grid_rows(source.cells.sparkSession, grid), "px", "py", target, source.epsg)
    a, _, c, _, e, f = source.grid.transform
    # rounding keeps a point that falls on a cell's centre there
    placed = cells.select("row", "col", F.round((F.col("py") - f) / e - 0.5, 9).alias("y"), F.round((F.col("px") - c) / a - 0.5, 9).alias("x"))
    return Raster((interpolated if kernel == "bilinear" else contained)(source, placed), grid, source.labels)


def opened(source: Raster, grid: Grid, kind: str, resample: str = "bilinear", **scaling) -> Layer:
    """A stack's layer from a source: imagery stays on its own grid, which is the stack's; others are warped to it."""
    own = source if kind == "naip" else warped(source, replace(grid, nodata=source.grid.nodata), "bilinear" if resample == "bilinear" else "nearest")
    return Layer(own.cells, source.labels, source.grid.nodata, type=kind, **scaling)


def resampled(source: Raster, resolution: float) -> Raster:
    """The source in cells of another size, in metres; unchanged if the grid's size stays. Degrees and unknown systems are errors."""
    if source.epsg is None:
        raise ValueError("The raster lacks a reference system")
    if crs.is_geographic(source.epsg):
        raise ValueError("A raster in degrees can't be resampled to metres")
    grid = grid_over(source.grid.bounds(), resolution, source.grid, source.epsg)
    return source if (grid.width, grid.height) == (source.grid.width, source.grid.height) else warped(source, grid)


def projected_points(spark: SparkSession, points: list[tuple[float, float]], source: int, target: int) -> list[tuple[float, float]]:
    """A few points in another reference system."""
    rows = spark.createDataFrame([(k, float(px), float(py)) for k, (px, py) in enumerate(points)], "k int, x double, y double")
    return [(r["x"], r["y"]) for r in sorted(crs.moved(rows, "x", "y", source, target).collect())]


def edge_points(bounds: tuple[float, float, float, float], each: int = 21) -> list[tuple[float, float]]:
    """Points along the four sides of a box, whose projections bound its own."""
    minx, miny, maxx, maxy = bounds
    steps = [k / (each - 1) for k in range(each)]
    across = [(minx + t * (maxx - minx), y) for t in steps for y in (miny, maxy)]
    return across + [(x, miny + t * (maxy - miny)) for t in steps for x in (minx, maxx)]


def reprojected(source: Raster, epsg: int, resolution: float | None = None) -> Raster:
    """The source in another reference system, at a resolution or its own; unchanged if it is there already."""
    if source.epsg is None:
        raise ValueError("The raster lacks a reference system")
    if source.epsg == epsg:
        return source
    points = projected_points(source.cells.sparkSession, edge_points(source.grid.bounds()), source.epsg, epsg)
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return warped(source, grid_over((min(xs), min(ys), max(xs), max(ys)), resolution or source.resolution, source.grid, epsg))


def mosaic(rasters: list[Raster]) -> Raster:
    """One raster over all bounds; where several have a value for a band, the first one's counts."""
    first = rasters[0]
    boxes = [r.grid.bounds() for r in rasters]
    bounds = (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes))
    grid = grid_over(bounds, first.resolution, first.grid, first.epsg)
    cells = None
    for k, (raster, box) in enumerate(zip(rasters, boxes)):
        down, right = round((bounds[3] - box[3]) / first.resolution), round((box[0] - bounds[0]) / first.resolution)
        own = raster.cells.select((F.col("row") + down).alias("row"), (F.col("col") + right).alias("col"), "bands", F.lit(k).alias("ord"))
        cells = own if cells is None else cells.unionByName(own)
    firsts = []
    for k in range(len(first.labels)):
        v = F.get("bands", F.lit(k))
        firsts.append(F.coalesce(F.min_by(v, F.when(v.isNotNull() & (v != grid.nodata), F.col("ord"))), F.lit(grid.nodata)))
    return Raster(cells.groupBy("row", "col").agg(F.array(*firsts).alias("bands")), grid, first.labels)


def distinct_systems(rasters: list[Raster]) -> list[str]:
    return sorted({r.grid.crs or "" for r in rasters})


def prepared_reference(rasters: list[Raster], resolution: float | None = None, epsg: int | None = None) -> Raster:
    """One reference raster from one or more tiles: mosaicked, then resampled, then reprojected, as asked for.

    Tiles of several reference systems are reprojected first if a target is given; else they are an error, as are tiles of
    several cell sizes or band counts, and no tiles at all.
    """
    if not rasters:
        raise ValueError("No rasters were given")
    if epsg and len(distinct_systems(rasters)) > 1:
        rasters, epsg = [reprojected(r, epsg, resolution) for r in rasters], None
    if len(distinct_systems(rasters)) > 1:
        raise ValueError(f"Rasters of several reference systems: {', '.join(distinct_systems(rasters))}")
    if max(r.resolution for r in rasters) - min(r.resolution for r in rasters) > 1e-6:
        raise ValueError("Rasters of several cell sizes")
    if len({len(r.labels) for r in rasters}) > 1:
        raise ValueError("Rasters of several band counts")
    out = mosaic(rasters) if len(rasters) > 1 else rasters[0]
    if resolution is not None:
        out = resampled(out, resolution)
    if epsg:
        out = reprojected(out, epsg, resolution)
    return Raster(out.cells, out.grid, tuple(IMAGERY_LABELS[: len(out.labels)]))


def clipped(source: Raster, rings: list[list[tuple[float, float]]], epsg: int = 4326) -> Raster:
    """The part of a raster within an area (rings; holes run the other way): cropped to its cells, nodata where a centre lies outside.

    The area is projected into the raster's reference system, whose absence is an error, as is an area beside the raster.
    """
    if source.epsg is None:
        raise ValueError("The raster lacks a reference system")
    spark = source.cells.sparkSession
    own = [projected_points(spark, ring, epsg, source.epsg) for ring in rings]
    a, _, c, _, e, f = source.grid.transform
    xs, ys = [p[0] for r in own for p in r], [p[1] for r in own for p in r]
    left, right = max(0, math.floor((min(xs) - c) / a)), min(source.grid.width, math.ceil((max(xs) - c) / a))
    top, bottom = max(0, math.floor((max(ys) - f) / e)), min(source.grid.height, math.ceil((min(ys) - f) / e))
    if left >= right or top >= bottom:
        raise ValueError("The area doesn't meet the raster")
    x, y = S.pixel_centre(F.col("row"), F.col("col"), c, f, a)
    inside = F.lit(False)
    for ring in own:
        inside = inside != G.in_ring(x, y, F.array(*(F.struct(F.lit(px).alias("x"), F.lit(py).alias("y")) for px, py in ring)))
    kept = source.cells.where(F.col("row").between(top, bottom - 1) & F.col("col").between(left, right - 1)).withColumn("inside", inside)
    blank = F.array_repeat(F.lit(source.grid.nodata), len(source.labels))
    cells = kept.select((F.col("row") - top).alias("row"), (F.col("col") - left).alias("col"), F.when(F.col("inside"), F.col("bands")).otherwise(blank).alias("bands"))
    grid = replace(source.grid, transform=(a, 0.0, c + left * a, 0.0, e, f + top * e), width=right - left, height=bottom - top)
    return Raster(cells, grid, source.labels)


def footprints(grids: DataFrame, epsg: int, target: int = 4326) -> DataFrame:
    """grids (id, minx, miny, maxx, maxy, of one reference system) with ring: their corners in degrees, and that ring's box."""
    corners = [("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy")]
    points = []
    for x, y in corners:
        px, py = crs.project(F.col(x), F.col(y), epsg, target)
        points.append(F.struct(px.alias("x"), py.alias("y")))
    out = grids.select("id", F.array(*points).alias("ring"))
    side = lambda f, of: f(F.transform("ring", lambda p: p[of]))
    return out.select("id", "ring", side(F.array_min, "x").alias("minx"), side(F.array_min, "y").alias("miny"), side(F.array_max, "x").alias("maxx"), side(F.array_max, "y").alias("maxy"))


def channels(labels: tuple[str, ...], override: int | None = None) -> int:
    """The number of channels of a model's input: as told, or as many as there are bands."""
    return len(labels) if override is None else override


def grown_polygons(spark: SparkSession, rings: list[list[tuple[float, float]]], metres: float = 0.0) -> list[list[list[tuple[float, float]]]]:
    """The single polygons of an area in degrees; for a distance, each grown by it, round, in the UTM zone of its middle.

    Grown polygons lose their holes, and are grown from their hull.
    """
    out = []
    for own in areas.polygons(rings):
        if metres <= 0:
            out.append(own)
            continue
        minx, miny, maxx, maxy = areas.bounds(own)
        zone = min(60, int(((minx + maxx) / 2 + 180) // 6) + 1) + (32600 if miny + maxy >= 0 else 32700)
        there = projected_points(spark, own[0], 4326, zone)
        out.append([projected_points(spark, areas.rounded(there, metres), zone, 4326)])
    return out


def acquisition_ring(labels: DataFrame, metres: float = 1000.0, epsg: int = 5070) -> list[tuple[float, float]]:
    """The box around all labels (boxes in metres), grown by a distance, round, as a ring in degrees; no labels are an error."""
    box = labels.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
    if box[0] is None:
        raise ValueError("There are no labels")
    return projected_points(labels.sparkSession, areas.rounded(areas.box(*box), metres), epsg, 4326)
