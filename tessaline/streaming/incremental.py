"""New observations as a stream: duplicate scenes are dropped within a watermark, and touched pixels are computed anew.

An addition of this engine: batch plans give the same medians.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import composite


def read_observations(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def distinct_observations(stream: DataFrame, keys: list[str], delay: str = "30 days") -> DataFrame:
    """The first arrival of each observation; state older than the delay goes."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def refresh(store: str, out: str, min_clear: int = 3, block: int = 64):
    """A foreachBatch function: add a batch to the store and write the medians of the pixels it touches, by batch.

    Observations are stored by block of rows and by batch id, so a batch that is run again after a failure replaces itself, and
    only the blocks that a batch touches are read back. Whether a season is clipped depends on its values alone, so each touched
    pixel's unclipped median is stored, the latest batch of a pixel counts, and the season's range is taken over all of them:
    the medians, read by current(), are those of a batch plan.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        here = batch.withColumn("block", F.floor(F.col("row") / block).cast("int")).withColumn("batch", F.lit(batch_id))
        fresh = {"partitionOverwriteMode": "dynamic"}
        here.write.mode("overwrite").options(**fresh).partitionBy("block", "batch").parquet(store)
        everything = spark.read.parquet(store)
        mine = everything.where(F.col("batch") == batch_id).select("block", "row", "col").distinct()
        blocks = [r[0] for r in mine.select("block").distinct().collect()]  # rows of the raster over the block's size, at most
        near = everything.where(F.col("block").isin(blocks) & (F.col("batch") <= batch_id))  # partition filters
        touched = near.join(mine, ["block", "row", "col"], "left_semi")
        medians = composite.seasonal_median(touched, min_clear, clip=False)
        medians.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return apply


def current(spark: SparkSession, out: str, clip: bool = True) -> DataFrame:
    """row, col, season, n_clear and value from all batches that refresh() has written: the latest of each pixel, clipped by season."""
    every = spark.read.parquet(out)
    latest = every.groupBy("row", "col", "season").agg(F.max_by(F.struct("n_clear", "value"), "batch").alias("m"))
    medians = latest.select("row", "col", "season", "m.n_clear", "m.value")
    return composite.clipped_where_exceeded(medians, ["season"]) if clip else medians
