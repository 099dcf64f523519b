"""Per-scene samples of a composite's corner pixels, for a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# The columns of the report, in the order that its readers expect.
REPORT = ["season_raster", "season_label", "years", "pixel_name", "band", "band_label", "source_type", "item_id", "observation_datetime", "asset_id", "raw_value", "scaled_value", "median_value", "lon", "lat", "row", "col"]


def report(pixels: DataFrame, observed: DataFrame, medians: DataFrame, season: str, years: list[int], band: str, asset: str) -> DataFrame:
    """One row per pixel's median and one per observation of it, in REPORT's columns, sorted.

    pixels: pixel_name, row, col, lon, lat. observed: row, col, item_id, ts, raw, nodata. medians: row, col, value.
    """
    base = F.broadcast(pixels).join(medians.select("row", "col", F.col("value").alias("median_value")), ["row", "col"], "left")  # a few named pixels
    shared = {
        "season_raster": F.lit(f"s2_{season.lower()}"), "season_label": F.lit(season), "years": F.array_join(F.array(*map(F.lit, years)), ","),
        "band": F.lit(band), "band_label": S.band_label(F.lit(season), F.lit(band)), "asset_id": F.lit(asset),
    }
    raw = F.when(F.abs(F.col("raw") - F.col("nodata")) <= 1e-8 + 1e-5 * F.abs("nodata"), None).otherwise(F.col("raw"))
    seen = base.join(observed, ["row", "col"]).withColumns(
        {"source_type": F.lit("observation"), "item_id": F.col("item_id").cast("string"), "observation_datetime": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "raw_value": raw, "scaled_value": S.sampled(F.col("raw"), F.col("nodata"))}
    )
    medians_only = base.withColumns({"source_type": F.lit("median"), "item_id": F.lit(None).cast("string"), "observation_datetime": F.lit(None).cast("string"), "raw_value": F.lit(None).cast("double"), "scaled_value": F.col("median_value")})
    rows = [df.withColumns(shared).select(*REPORT) for df in (seen, medians_only)]
    return rows[0].unionByName(rows[1]).orderBy("pixel_name", "band", "source_type", "observation_datetime", "item_id")
