"""Raster and vector tables on disk, and small reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_rasters(paths: list[str | Path], suffixes: tuple[str, ...] = (".tif", ".tiff")) -> list[Path]:
    """Files as they are and folders' files by suffix and name, each resolved path once, in order."""
    found: dict[Path, None] = {}
    for p in map(Path, paths):
        if p.is_dir():
            for suffix in suffixes:
                for f in sorted(x for x in p.iterdir() if x.suffix.lower() == suffix):
                    found.setdefault(f.resolve())
        elif p.is_file():
            found.setdefault(p.resolve())
        else:
            raise FileNotFoundError(p)
    return list(found)


def write_raster(cells: DataFrame, path: str, band_labels: list[str], nodata: float = -9999.0, block: int = 512) -> None:
    """Cells (row, col, bands) as Parquet by block, missing values as nodata; labels must match the bands.

    Blocks are range-partitioned, so a later window read touches the files of its blocks only. Labels travel in the schema.
    """
    count = cells.select(F.size("bands").alias("n")).agg(F.min("n"), F.max("n")).first()
    if count[0] is not None and (count[0] != len(band_labels) or count[1] != len(band_labels)):
        raise ValueError(f"{len(band_labels)} labels for {count[0]} to {count[1]} bands")
    wide = cells.select("row", "col", *(F.coalesce(F.col("bands")[k], F.lit(nodata)).cast("float").alias(f"b{k}", metadata={"label": n, "nodata": nodata}) for k, n in enumerate(band_labels)))
    blocks = wide.withColumn("block_row", F.floor(F.col("row") / block).cast("int"))
    blocks.repartitionByRange("block_row", "col").sortWithinPartitions("row", "col").write.mode("overwrite").partitionBy("block_row").parquet(path)


def read_raster(spark: SparkSession, path: str, block: int = 512, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """row, col, bands; a window (row, col, height, width) becomes partition and row-group filters."""
    wide = spark.read.parquet(path)
    if window:
        r, c, h, w = window
        wide = wide.where(F.col("block_row").between(r // block, (r + h - 1) // block) & F.col("row").between(r, r + h - 1) & F.col("col").between(c, c + w - 1))
    names = sorted((n for n in wide.columns if n[0] == "b" and n[1:].isdigit()), key=lambda n: int(n[1:]))
    return wide.select("row", "col", F.array(*(F.col(n).cast("double") for n in names)).alias("bands"))


def band_labels(spark: SparkSession, path: str) -> list[str]:
    fields = [f for f in spark.read.parquet(path).schema if f.name[0] == "b" and f.name[1:].isdigit()]
    return [f.metadata["label"] for f in sorted(fields, key=lambda f: int(f.name[1:]))]


def write_report(rows: DataFrame, path: str, columns: list[str]) -> None:
    """A CSV with a header; an empty report is an error."""
    if rows.isEmpty():
        raise ValueError("The report has no rows")
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_vectors(rows: DataFrame, path: str, epsg: int) -> None:
    """A vector table as Parquet, with its reference system beside it in the schema."""
    rows.select(*(F.col(c).alias(c, metadata={"epsg": epsg}) if c in ("geometry", "minx") else F.col(c) for c in rows.columns)).write.mode("overwrite").parquet(path)


def output_paths(source: str, suffix: str, raster: str | None = None, vector: str | None = None) -> tuple[str, str]:
    """Where predictions go unless told: a folder `predictions` beside the source."""
    own = Path(source)
    base = own.parent / "predictions" / f"{own.stem}_{suffix}"
    return raster or f"{base}.tif", vector or f"{base}.gpkg"


def dem_products(payload: str) -> list[dict]:
    """Products of an inventory's answer: product_id, download_url, size; items without an address are left out."""
    items = json.loads(payload).get("items", [])
    out = []
    for item in items:
        urls = item.get("downloadURL") or item.get("urls") or []
        urls = [urls] if isinstance(urls, (str, dict)) else urls
        usable = [u if isinstance(u, str) else u.get("url") or u.get("URL") for u in urls]
        usable = [u for u in usable if u and u.startswith("http")]
        if usable:
            name = item.get("title") or item.get("entityId") or item.get("id") or "dem_tile"
            out.append({"product_id": name, "download_url": usable[0], "size": int(item.get("sizeInBytes") or item.get("unitSize") or 0)})
    return out


def clear_folder(spark: SparkSession, path: str) -> None:
    """An empty folder at path, whatever was there; a failure is an error."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = own.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(own) and not system.delete(own, True):
        raise OSError(f"Can't clear {path}")
    system.mkdirs(own)
