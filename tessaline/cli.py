"""Command line: python -m tessaline.cli {composite, sample, topography, infer} ...; tables and rasters are Parquet folders."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from .plans import config


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tessaline", description=__doc__)
    out.add_argument("--config", help="YAML file of settings; options override it")
    steps = out.add_subparsers(dest="step", required=True)

    composite = steps.add_parser("composite", help="seasonal medians of the best scenes")
    composite.add_argument("--catalog", required=True)
    composite.add_argument("--observations", required=True)
    composite.add_argument("--out", required=True)
    composite.add_argument("--seasons", nargs="+")
    composite.add_argument("--years", nargs="+", type=int)
    composite.add_argument("--cloud-cover", type=float)
    composite.add_argument("--min-clear", type=int)
    composite.add_argument("--dilation", type=int)
    composite.add_argument("--max-scenes", type=int)

    sample = steps.add_parser("sample", help="a balanced manifest of training tiles")
    for name in ("grid", "labels", "inventory", "out"):
        sample.add_argument(f"--{name}", required=True)
    sample.add_argument("--ratio", type=float)
    sample.add_argument("--margin", type=float)
    sample.add_argument("--seed", type=int)

    topography = steps.add_parser("topography", help="terrain bands of a surface")
    topography.add_argument("--surface", required=True, help="row, col, z")
    topography.add_argument("--cell", type=float, required=True)
    topography.add_argument("--small", type=float)
    topography.add_argument("--large", type=float)
    topography.add_argument("--out", required=True)

    infer = steps.add_parser("infer", help="classes of a raster by an ONNX model")
    infer.add_argument("--raster", required=True)
    infer.add_argument("--manifest", required=True, help="the manifest with the raster's grid")
    infer.add_argument("--model", required=True)
    infer.add_argument("--mask")
    infer.add_argument("--vectors")
    infer.add_argument("--window", type=int)
    infer.add_argument("--overlap", type=int)
    infer.add_argument("--classes", type=int)
    infer.add_argument("--threshold", type=float)
    infer.add_argument("--min-area", type=int)
    infer.add_argument("--channels", type=int)
    infer.add_argument("--tolerance", type=float)
    return out


def settings_of(args: argparse.Namespace) -> config.Settings:
    """Settings from the file, if one is named, and the options given, which count more."""
    sections = {"composite": ["seasons", "years", "cloud_cover", "min_clear", "dilation", "max_scenes"], "sample": ["ratio", "margin", "seed"], "topography": ["small", "large"], "infer": ["window", "overlap", "classes", "threshold", "min_area", "tolerance"]}
    names = {"composite": "composite", "sample": "sampling", "topography": "topography", "infer": "inference"}
    given = {n: getattr(args, n) for n in sections.get(args.step, []) if getattr(args, n) is not None}
    explicit = {names[args.step]: given} if given else {}
    return config.load(args.config, explicit) if args.config else config.build(None, explicit)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    own = settings_of(args)
    from pyspark.sql import SparkSession

    from .operators import focal, raster
    from .plans import pipelines
    from .sources import files, manifests

    spark = SparkSession.builder.appName(f"tessaline {args.step}").getOrCreate()
    read = spark.read.parquet
    if args.step == "composite":
        bands = pipelines.composite_stack(read(args.catalog), read(args.observations), own)
        files.write_raster(bands, args.out, own.composite.seasons)
    elif args.step == "sample":
        pipelines.training_tiles(read(args.grid), read(args.labels), read(args.inventory), own).write.mode("overwrite").parquet(args.out)
    elif args.step == "topography":
        files.write_raster(focal.terrain_bands(read(args.surface), args.cell, own.topography.small, own.topography.large), args.out, ["Slope", "TPI_small", "TPI_large", "Depression_Depth"])
    else:
        content = json.loads(Path(args.manifest).read_text(encoding="utf-8"))["grid"]
        grid = manifests.Grid(content["crs"], tuple(content["transform"]), content["width"], content["height"], content.get("nodata", manifests.NODATA))
        source = raster.Raster(files.read_raster(spark, args.raster), grid, tuple(files.band_labels(spark, args.raster)))
        mask = pipelines.infer_raster(source, pipelines.onnx_model(args.model), own, args.channels or own.model.channels)
        print(*pipelines.infer_to(mask, grid, own, args.raster, args.mask, args.vectors), sep="\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
