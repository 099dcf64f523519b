"""Neighbourhood operators on gridded surfaces, as separable windows along rows and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def along():
    return Window.partitionBy("row").orderBy("col")


def across():
    return Window.partitionBy("col").orderBy("row")


def _gradient(window, at: str, cell: float) -> Column:
    """Central difference inside, one-sided at the grid's edge; missing neighbours make it missing."""
    before, after = F.lag("z").over(window), F.lead("z").over(window)
    first, last = F.lag(at).over(window).isNull(), F.lead(at).over(window).isNull()
    return F.when(first & last, 0.0).when(first, (after - F.col("z")) / cell).when(last, (F.col("z") - before) / cell).otherwise((after - before) / (2 * cell))


def slope(surface: DataFrame, cell: float) -> DataFrame:
    """surface with slope in degrees."""
    step = surface.withColumn("gx", _gradient(along(), "col", cell)).withColumn("gy", _gradient(across(), "row", cell))
    return step.withColumn("slope", F.degrees(F.atan(F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))))).drop("gx", "gy")


def _box_sum(window, at: str, value: str, radius: int) -> Column:
    """Sum over 2 * radius + 1 cells, the edge cells standing for those beyond the edge."""
    near, whole = window.rowsBetween(-radius, radius), window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    low, high = F.min(at).over(whole), F.max(at).over(whole)
    beyond_low, beyond_high = F.greatest(F.lit(0), low + radius - F.col(at)), F.greatest(F.lit(0), F.col(at) + radius - high)
    return F.sum(value).over(near) + beyond_low * F.first(value).over(whole) + beyond_high * F.last(value).over(whole)


def box_mean(surface: DataFrame, radius: int, out: str = "box_mean") -> DataFrame:
    """surface with the mean of the square of cells around each, missing ones left out, edges replicated.

    Two passes with frames of 2 * radius + 1 cells instead of one with their square.
    """
    if radius <= 0:
        return surface.withColumn(out, F.col("z"))
    step = surface.withColumn("v", F.coalesce("z", F.lit(0.0))).withColumn("k", F.when(F.col("z").isNotNull(), 1).otherwise(0))
    for window, at in ((along(), "col"), (across(), "row")):
        step = step.withColumns({"v": _box_sum(window, at, "v", radius), "k": _box_sum(window, at, "k", radius)})
    return step.withColumn(out, F.when(F.col("k") > 0, F.col("v") / F.col("k"))).drop("v", "k")


def position_index(surface: DataFrame, radius: float, cell: float, out: str = "tpi") -> DataFrame:
    """surface with the difference between each cell and the mean around it, the radius being a distance."""
    return box_mean(surface, int(max(radius / cell, 1)), "around").withColumn(out, F.col("z") - F.col("around")).drop("around")


def depression_depth(surface: DataFrame) -> DataFrame:
    """surface with depth: how far a 3 x 3 closing lies above each cell."""
    by_row, by_col = along().rowsBetween(-1, 1), across().rowsBetween(-1, 1)
    step = surface.withColumn("c", F.max("z").over(by_row)).withColumn("c", F.max("c").over(by_col))
    step = step.withColumn("c", F.min("c").over(by_row)).withColumn("c", F.min("c").over(by_col))
    return step.withColumn("depth", F.when(F.col("z").isNotNull(), F.greatest(F.col("c") - F.col("z"), F.lit(0.0)))).drop("c")


def terrain_bands(surface: DataFrame, cell: float, small: float, large: float, nodata: float = -9999.0) -> DataFrame:
    """row, col and bands: slope, position index at two radii, depression depth; nodata where the surface has none."""
    step = position_index(position_index(slope(surface, cell), small, cell, "tpi_small"), large, cell, "tpi_large")
    step = depression_depth(step)
    shown = [F.when(F.col("z").isNull() | F.col(c).isNull(), F.lit(nodata)).otherwise(F.col(c)) for c in ("slope", "tpi_small", "tpi_large", "depth")]
    return step.select("row", "col", F.array(*shown).alias("bands"))
