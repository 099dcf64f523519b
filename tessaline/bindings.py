"""The driver's tables as the abstractions of this engine: scenes, observations, rasters, boxes and tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRID_COLUMNS, STACK_COLUMNS = 50, 25
EXTENT = (-1000, 10000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene catalog: item_id, tile_id, ts, cloud_cover, ord (first-seen order)."""
    t = table(spark, sf_dir, "orders")
    return t.select(
        F.col("o_orderkey").alias("item_id"), (F.col("o_custkey") % 12).alias("tile_id"), F.col("o_orderdate").alias("ts"), (F.col("o_totalprice") / 5000.0).alias("cloud_cover"), F.col("o_orderkey").alias("ord")
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation cube in long form: row, col, ts, scl (scene class), dn (digital number)."""
    t = table(spark, sf_dir, "lineitem")
    cell = F.col("l_partkey")
    return t.select(
        F.floor(cell / GRID_COLUMNS).cast("int").alias("row"),
        (cell % GRID_COLUMNS).cast("int").alias("col"),
        F.col("l_shipdate").alias("ts"),
        ((F.col("l_orderkey") + F.col("l_linenumber") * 7) % 12).cast("int").alias("scl"),
        (F.col("l_extendedprice") / 10.0).alias("dn"),
        F.col("l_orderkey").alias("scene"),
    )


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-band surface with holes: row, col, z."""
    t = table(spark, sf_dir, "part")
    cell = F.col("p_partkey")
    z = F.when(cell % 37 == 0, None).otherwise(F.col("p_retailprice") + F.col("p_size"))
    return t.select(F.floor(cell / GRID_COLUMNS).cast("int").alias("row"), (cell % GRID_COLUMNS).cast("int").alias("col"), z.alias("z"))


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-band raster: row, col, bands (29 values), logits (2 values), label."""
    t = table(spark, sf_dir, "embeddings")
    cell = F.col("vec_id")
    wide = F.col("embedding").cast("array<double>")
    return t.select(
        F.floor(cell / STACK_COLUMNS).cast("int").alias("row"), (cell % STACK_COLUMNS).cast("int").alias("col"), F.slice(wide, 1, 29).alias("bands"), F.slice(wide, 63, 2).alias("logits"), F.col("label").alias("label")
    )


def boxes(df: DataFrame, key: str, centre_x: str) -> DataFrame:
    """Boxes around centres spread over the extent: id, minx, miny, maxx, maxy."""
    half, x, y = 20 + F.col(key) % 30, F.col(centre_x), (F.col(key) * 7919) % 10000
    return df.select(F.col(key).alias("id"), (x - half).alias("minx"), (y - half).cast("double").alias("miny"), (x + half).alias("maxx"), (y + half).cast("double").alias("maxy"))


def label_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(table(spark, sf_dir, "supplier"), "s_suppkey", "s_acctbal")


def inventory_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'"), "c_custkey", "c_acctbal")


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label boxes' inscribed rings, a corner in the middle of each side."""
    t = label_boxes(spark, sf_dir)
    x, y = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    points = ((x, F.col("miny")), (F.col("maxx"), y), (x, F.col("maxy")), (F.col("minx"), y))
    return t.withColumn("ring", F.array(*(F.struct(px.alias("x"), py.alias("y")) for px, py in points)))


# The same, as DuckDB SQL.
SCENES = "scenes AS (SELECT o_orderkey AS item_id, o_custkey % 12 AS tile_id, o_orderdate AS ts, o_totalprice / 5000.0::DOUBLE AS cloud_cover, o_orderkey AS ord FROM orders)"
OBSERVATIONS = """obs AS (SELECT CAST(l_partkey // 50 AS INT) AS row, CAST(l_partkey % 50 AS INT) AS col, l_shipdate AS ts,
 CAST((l_orderkey + l_linenumber * 7) % 12 AS INT) AS scl, l_extendedprice / 10.0::DOUBLE AS dn, l_orderkey AS scene FROM lineitem)"""
ELEVATION = "dem AS (SELECT CAST(p_partkey // 50 AS INT) AS row, CAST(p_partkey % 50 AS INT) AS col, CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_retailprice + p_size END AS z FROM part)"
STACK = "stack AS (SELECT CAST(vec_id // 25 AS INT) AS row, CAST(vec_id % 25 AS INT) AS col, CAST(embedding[1:29] AS DOUBLE[]) AS bands, CAST(embedding[63:64] AS DOUBLE[]) AS logits, label FROM embeddings)"
LABEL_BOXES = """lab AS (SELECT s_suppkey AS id, s_acctbal - (20 + s_suppkey % 30) AS minx, CAST((s_suppkey * 7919) % 10000 - (20 + s_suppkey % 30) AS DOUBLE) AS miny,
 s_acctbal + (20 + s_suppkey % 30) AS maxx, CAST((s_suppkey * 7919) % 10000 + (20 + s_suppkey % 30) AS DOUBLE) AS maxy FROM supplier)"""
INVENTORY_BOXES = """inv AS (SELECT c_custkey AS id, c_acctbal - (20 + c_custkey % 30) AS minx, CAST((c_custkey * 7919) % 10000 - (20 + c_custkey % 30) AS DOUBLE) AS miny,
 c_acctbal + (20 + c_custkey % 30) AS maxx, CAST((c_custkey * 7919) % 10000 + (20 + c_custkey % 30) AS DOUBLE) AS maxy FROM customer WHERE c_mktsegment = 'BUILDING')"""
GRID = "grid AS (SELECT i * 22 + j AS id, -1000.0::DOUBLE + i * 512 AS minx, -1000.0::DOUBLE + j * 512 AS miny, -1000.0::DOUBLE + (i + 1) * 512 AS maxx, -1000.0::DOUBLE + (j + 1) * 512 AS maxy FROM range(22) a(i), range(22) b(j))"
