"""Multi-source stacks on one grid, and resampling onto it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def grid_cells(spark, row_off: int, col_off: int, h: int, w: int) -> DataFrame:
    """The cells of a window."""
    return spark.range(row_off, row_off + h).select(F.col("id").cast("int").alias("row")).crossJoin(spark.range(col_off, col_off + w).select(F.col("id").cast("int").alias("col")))


def read_window(spark, sources: list[tuple[DataFrame, int]], row_off: int, col_off: int, h: int, w: int, nodata: float = S.NODATA) -> DataFrame:
    """row, col, bands over a window: the sources' bands (each with its count) in order, nodata where a source has no cell.

    The window is a range predicate on every source, so a stored raster is pruned before the join.
    """
    if h <= 0 or w <= 0:
        raise ValueError("window must have a positive height and width")
    inside = F.col("row").between(row_off, row_off + h - 1) & F.col("col").between(col_off, col_off + w - 1)
    out = grid_cells(spark, row_off, col_off, h, w)
    names = []
    for k, (source, count) in enumerate(sources):
        out = out.join(source.where(inside).select("row", "col", F.col("bands").alias(f"s{k}")), ["row", "col"], "left")
        names.append(F.coalesce(F.col(f"s{k}"), F.array_repeat(F.lit(nodata), count)))
    return out.select("row", "col", F.concat(*names).alias("bands"))


def aligned(sources: list[tuple[DataFrame, int]], nodata: float = S.NODATA) -> DataFrame:
    """row, col, bands for every cell that any source has."""
    cells = sources[0][0].select("row", "col")
    for source, _ in sources[1:]:
        cells = cells.unionByName(source.select("row", "col"))
    out = cells.distinct()
    names = []
    for k, (source, count) in enumerate(sources):
        out = out.join(source.select("row", "col", F.col("bands").alias(f"s{k}")), ["row", "col"], "left")
        names.append(F.coalesce(F.col(f"s{k}"), F.array_repeat(F.lit(nodata), count)))
    return out.select("row", "col", F.concat(*names).alias("bands"))


def bilinear(source: DataFrame, targets: DataFrame) -> DataFrame:
    """targets (id, y, x: fractional row and column of pixel centres) with value: the four neighbours' weighted mean.

    Missing neighbours are left out of the weights; without any the value is null.
    """
    corners = [(dr, dc) for dr in (0, 1) for dc in (0, 1)]
    r0, c0 = F.floor("y"), F.floor("x")
    fr, fc = F.col("y") - r0, F.col("x") - c0
    parts = F.array(*(F.struct((r0 + dr).cast("int").alias("row"), (c0 + dc).cast("int").alias("col"), ((fr if dr else 1 - fr) * (fc if dc else 1 - fc)).alias("weight")) for dr, dc in corners))
    spread = targets.select("id", F.explode(parts).alias("p")).select("id", "p.*").where("weight > 0")
    met = spread.join(source.where(F.col("z").isNotNull()).select("row", "col", "z"), ["row", "col"], "left")
    held = F.when(F.col("z").isNotNull(), F.col("weight"))
    return met.groupBy("id").agg((F.sum(F.col("z") * F.col("weight")) / F.sum(held)).alias("value"))


def nearest(source: DataFrame, targets: DataFrame) -> DataFrame:
    """targets (id, y, x) with value: that of the containing cell."""
    at = targets.select("id", F.floor(F.col("y") + 0.5).cast("int").alias("row"), F.floor(F.col("x") + 0.5).cast("int").alias("col"))
    return at.join(source.select("row", "col", F.col("z").alias("value")), ["row", "col"], "left").select("id", "value")


def uniform(tiles: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row: whether all tiles agree in CRS and band count, and in resolution up to the tolerance."""
    return tiles.agg((F.count_distinct("crs") <= 1).alias("same_crs"), (F.max("res") - F.min("res") <= tolerance).alias("same_res"), (F.count_distinct("bands") <= 1).alias("same_bands"))
