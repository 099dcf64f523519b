"""Seasonal composites: per-pixel medians of clear observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

TOLERANCE = 1e-3


def seasonal_median(obs: DataFrame, min_clear: int = 3, strict: bool = True, keys: list[str] | None = None, clip: bool = True) -> DataFrame:
    """keys, season, n_clear and value for each pixel and season that was observed.

    value is the exact, interpolating median of the clear observations' reflectance, null below min_clear. strict also drops
    observations without data. Where any value of a season leaves [0, 1] by more than TOLERANCE, the season is clipped.
    Observations outside the seasons are left out. Each (pixel, season) is one small group; the count shuffles partial sums.
    """
    keys = keys or ["row", "col"]
    seen = obs.withColumn("season", S.season_of(F.col("ts"))).where(F.col("season").isNotNull())
    clear = S.is_observed(F.col("scl"), F.col("dn")) if strict else S.is_clear(F.col("scl"))
    value = F.when(clear, S.reflectance(F.col("dn")))
    out = seen.groupBy(*keys, "season").agg(F.count_if(clear).alias("n_clear"), F.median(value).alias("value"))
    out = out.withColumn("value", F.when(F.col("n_clear") >= min_clear, F.col("value")))
    return clipped_where_exceeded(out, ["season"]) if clip else out


def clipped_where_exceeded(df: DataFrame, keys: list[str]) -> DataFrame:
    """Clip a group's values to [0, 1] if any of them exceeds it by more than TOLERANCE; else leave all of them.

    The range of a group is a partial aggregate that is joined back as one row per group, so a group of any size is spread.
    """
    span = df.groupBy(*keys).agg(F.max("value").alias("top"), F.min("value").alias("bottom"))
    exceeded = (F.col("top") > 1 + TOLERANCE) | (F.col("bottom") < -TOLERANCE)
    joined = df.join(F.broadcast(span) if keys == ["season"] else span, keys)  # one row per season
    return joined.withColumn("value", F.when(exceeded, S.clipped(F.col("value"))).otherwise(F.col("value"))).drop("top", "bottom")


def count_statistics(composite: DataFrame, keys: list[str]) -> DataFrame:
    """Least, mean and most clear observations per group."""
    return composite.groupBy(*keys).agg(F.min("n_clear").alias("least"), F.avg("n_clear").alias("mean"), F.max("n_clear").alias("most"))


def value_range(composite: DataFrame, keys: list[str]) -> DataFrame:
    return composite.groupBy(*keys).agg(F.min("value").alias("lowest"), F.max("value").alias("highest"), F.count("value").alias("n_valid"))


def complete(composite: DataFrame, keys: list[str], seasons: list[str]) -> DataFrame:
    """Keys that hold a value in every one of the seasons."""
    held = composite.where(F.col("value").isNotNull() & F.col("season").isin(seasons))
    return held.groupBy(*keys).agg(F.count_distinct("season").alias("n")).where(F.col("n") == len(seasons)).select(*keys)


def concatenated(composite: DataFrame, keys: list[str], order: list[str], nodata: float = S.NODATA) -> DataFrame:
    """keys and bands: the seasons' values in order, nodata where missing, for pixels that any season holds."""
    wide = composite.groupBy(*keys).agg(*(F.max(F.when(F.col("season") == s, F.col("value"))).alias(s) for s in order))
    return wide.select(*keys, F.array(*(F.coalesce(F.col(s), F.lit(nodata)) for s in order)).alias("bands"))


def dilated(masked: DataFrame, radius: int, scene: list[str], flag: str = "cloudy") -> DataFrame:
    """masked with the flag spread by a square of the radius, within each scene: two separable passes along rows and columns."""
    along = Window.partitionBy(*scene, "row").orderBy("col").rangeBetween(-radius, radius)
    across = Window.partitionBy(*scene, "col").orderBy("row").rangeBetween(-radius, radius)
    return masked.withColumn(flag, F.max(flag).over(along)).withColumn(flag, F.max(flag).over(across))


def mosaicked(tiles: DataFrame, value: str = "value", order: str = "tile_ord") -> DataFrame:
    """One value per cell: that of the first tile, by order, that has one."""
    return tiles.groupBy("row", "col").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))


def chunk_medians(obs: DataFrame, height: int, width: int, chunk: int, min_clear: int = 3, nodata: float = S.NODATA) -> DataFrame:
    """chunk_row, chunk_col, row, col, season, n_clear and value for every cell of a grid and every season that obs holds.

    Cells of chunks without observations, or with too few clear ones, are nodata; their count is 0 where nothing was seen. A
    season is clipped as a whole. Chunks are keys of the one plan, not rounds of a loop.
    """
    spark = obs.sparkSession
    medians = seasonal_median(obs, min_clear)
    seasons = medians.select("season").distinct()
    cells = spark.range(height).select(F.col("id").cast("int").alias("row")).select("row", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("col"))
    whole = cells.crossJoin(F.broadcast(seasons)).join(medians, ["row", "col", "season"], "left")  # three seasons at most
    at = lambda c: F.floor(F.col(c) / chunk).cast("int").alias(f"chunk_{c}")
    return whole.select(at("row"), at("col"), "row", "col", "season", F.coalesce("n_clear", F.lit(0)).alias("n_clear"), F.coalesce("value", F.lit(nodata)).alias("value"))
