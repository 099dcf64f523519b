"""Training tiles cut from stacks, with their burned labels, as pairs of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, geometry as G, scalars as S
from . import raster as R, tiles as T


def tile_name(number: Column) -> Column:
    return F.format_string("tile_%05d", number.cast("long"))


def manifest_boxes(grids: DataFrame) -> DataFrame:
    """grids (stack, a, c, e, f, grid_w, grid_h) with id, ord and the box that each covers."""
    return grids.withColumns({
        "id": F.col("stack"), "ord": F.col("stack"), "minx": F.col("c"), "maxy": F.col("f"),
        "maxx": F.col("c") + F.col("a") * F.col("grid_w"), "miny": F.col("f") + F.col("e") * F.col("grid_h"),
    })


def placed(tiles: DataFrame, grids: DataFrame) -> DataFrame:
    """tiles (id, box) with the first stack, in order, that they touch, and their window there; others are left out.

    The window is what the box covers on the stack's grid, in fractions of cells.
    """
    match = T.first_match(tiles, manifest_boxes(grids)).withColumnRenamed("manifest_ord", "stack")
    met = tiles.join(match, "id").join(grids, "stack")
    return met.withColumns(R.window_of_bounds({k: F.col(k) for k in "acef"})).withColumn("tile", tile_name(F.col("id")))


def unplaced(tiles: DataFrame, grids: DataFrame) -> DataFrame:
    """The tiles that touch no stack, for a report."""
    return T.anti(tiles, manifest_boxes(grids))


def images(windows: DataFrame, layers: list[R.Layer]) -> DataFrame:
    """tile, row, col and bands of placed() tiles; the layers' cells name their stack."""
    return R.read_windows(windows, layers, ["tile"])


def masks(windows: DataFrame, shapes: DataFrame) -> DataFrame:
    """tile, row, col and label: 1 where a cell's centre lies in a shape, else 0.

    shapes: box (minx to maxy) and, if they are no boxes, ring (an array of x, y). Cells are matched by the cells of the
    spatial index, so a tile meets the shapes near it only.
    """
    x = F.col("c") + (F.col("col_off") + F.col("col") + 0.5) * F.col("a")
    y = F.col("f") + (F.col("row_off") + F.col("row") + 0.5) * F.col("e")
    cells = R.window_cells(windows).select("tile", "row", "col", x.alias("x"), y.alias("y"))
    points = cells.select("tile", "row", "col", F.col("x").alias("minx"), F.col("x").alias("maxx"), F.col("y").alias("miny"), F.col("y").alias("maxy"))
    inside = G.overlaps("a", "b")
    if "ring" in shapes.columns:
        inside = inside & G.in_ring(F.col("a.minx"), F.col("a.miny"), F.col("b.ring"))
    keys = ["tile", "row", "col"]
    hit = T.pairs(points, shapes, inside).select(*(F.col(f"a.{k}").alias(k) for k in keys)).distinct().withColumn("label", F.lit(1))
    return cells.select(*keys).join(hit, keys, "left").withColumn("label", F.coalesce("label", F.lit(0)))


def extract(spark: SparkSession, tiles: DataFrame, grids: DataFrame, layers: list[R.Layer], path: str, shapes: DataFrame | None = None, overwrite: bool = False) -> int:
    """Write the image and label of each tile, by tile, below path; the number of tiles written.

    path/tiles holds each tile's name, box, window and grid, path/images and path/labels its cells. Without overwrite, tiles
    that are there already stay. Every tile is one partition of either table, so a pair is read by its name.
    """
    windows = placed(tiles, grids)
    there = _existing(spark, f"{path}/tiles")
    if there is not None and not overwrite:
        windows = windows.join(there.select("tile"), "tile", "left_anti")
    names = ["tile", "id", "stack", "minx", "miny", "maxx", "maxy", "row_off", "col_off", "height", "width", "grid_h", "grid_w", "a", "c", "e", "f"]
    fresh = {"partitionOverwriteMode": "dynamic"}
    windows.select(*names).write.mode("overwrite").parquet(f"{path}/next")
    todo = spark.read.parquet(f"{path}/next")
    write = lambda df, name: df.repartition("tile").write.mode("overwrite").options(**fresh).partitionBy("tile").parquet(f"{path}/{name}")
    write(images(todo, layers), "images")
    if shapes is not None:
        write(masks(todo, shapes), "labels")
    write(todo, "tiles")
    n = todo.count()
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/next")
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
    return n


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own) else None


def rewrite(spark: SparkSession, path: str, layers: list[R.Layer]) -> int:
    """Read all tiles' images below path again from the stack, as bytes of normalised values, in place; their number, 0 if none.

    Each tile keeps its size; its window starts at the stack's cell that holds the tile's corner. A tile is replaced as its
    partition is committed.
    """
    known = _existing(spark, f"{path}/tiles")
    if known is None or known.isEmpty():
        return 0
    corner = {"row_off": F.floor((F.col("maxy") - F.col("f")) / F.col("e")).cast("double"), "col_off": F.floor((F.col("minx") - F.col("c")) / F.col("a")).cast("double")}
    cells = images(known.withColumns(corner), layers).withColumn("bands", F.transform("bands", lambda v: S.to_byte(S.normalised(v)).cast("double")))
    cells.repartition("tile").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(f"{path}/images")
    return known.count()


def extents(spark: SparkSession, path: str) -> DataFrame:
    """tile and box of the stored tiles, by name; no rows where there are none."""
    known = _existing(spark, f"{path}/tiles")
    if known is None:
        return spark.createDataFrame([], "tile string, minx double, miny double, maxx double, maxy double")
    return known.select("tile", "minx", "miny", "maxx", "maxy").orderBy("tile")


def prepared_labels(labels: DataFrame, epsg: int | None, target: int | None) -> DataFrame:
    """labels (id, ring) in the tiles' reference system, with their boxes.

    No labels, or labels without a reference system, are an error. Without a target, or where it is theirs, they stay.
    """
    if labels.isEmpty():
        raise ValueError("The labels hold no shapes")
    if epsg is None:
        raise ValueError("The labels lack a reference system")
    ring = F.col("ring")
    if target is not None and target != epsg:
        def moved(p):
            x, y = crs.project(p["x"], p["y"], epsg, target)
            return F.struct(x.alias("x"), y.alias("y"))

        ring = F.transform("ring", moved)
    out = labels.withColumn("ring", ring)
    side = lambda f, of: f(F.transform("ring", lambda p: p[of]))
    return out.withColumns({"minx": side(F.array_min, "x"), "miny": side(F.array_min, "y"), "maxx": side(F.array_max, "x"), "maxy": side(F.array_max, "y")})


def labels_by_system(tiles: DataFrame, labels: DataFrame) -> DataFrame:
    """tiles (id, epsg) with the label set of their reference system (epsg, labels); one that none has is null."""
    return tiles.join(labels, "epsg", "left")
