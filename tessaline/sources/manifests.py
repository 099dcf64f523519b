"""Stack manifests and their indexes, as JSON through Spark's reader or from the driver's disk."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODATA = -9999.0
SOURCE = (
    "type string, path string, band_labels array<string>, scale_max double, scale_min double, band_scaling map<string,array<double>>, nodata double, resample string, dtype string, description string"
)
GRID = "crs string, transform array<double>, width int, height int, pixel_size array<double>, dtype string, nodata double"
INDEX = "version int, created_utc string, count int, manifests array<string>"


def schema(ddl: str = "manifest"):
    from pyspark.sql.types import StructType

    colon = lambda fields: ", ".join(f.replace(" ", ":", 1) for f in fields.split(", "))
    if ddl == "index":
        return StructType.fromDDL(INDEX)
    return StructType.fromDDL(f"version int, created_utc string, grid struct<{colon(GRID)}>, sources array<struct<{colon(SOURCE)}>>")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """The sources (see sources_of) of the manifests at a path; manifest is the file."""
    raw = spark.read.schema(schema()).option("multiLine", True).json(path).withColumn("manifest", F.input_file_name())
    return sources_of(raw)


def sources_of(raw: DataFrame) -> DataFrame:
    """One row per source of manifests (manifest, grid, sources): manifest, grid, place (order in the stack), the source with its defaults.

    A manifest without transform, width, height, or a source without type or path, is an error; one without a grid is none.
    """
    rows = raw.where(F.col("grid").isNotNull()).select("manifest", "grid", F.posexplode("sources").alias("place", "s"))
    lacking = F.col("grid.transform").isNull() | F.col("grid.width").isNull() | F.col("grid.height").isNull() | F.col("s.type").isNull() | F.col("s.path").isNull()
    checked = F.when(lacking, F.raise_error(F.concat(F.lit("Incomplete manifest: "), F.col("manifest"))).cast("int")).otherwise(F.col("place"))
    return rows.select(
        "manifest",
        "grid",
        checked.alias("place"),
        F.col("s.type").alias("type"),
        F.col("s.path").alias("path"),
        F.coalesce("s.band_labels", F.array().cast("array<string>")).alias("band_labels"),
        "s.scale_max",
        "s.scale_min",
        F.col("s.band_scaling").alias("band_scaling"),
        F.coalesce("s.nodata", F.lit(NODATA)).alias("nodata"),
        F.coalesce("s.resample", F.lit("bilinear")).alias("resample"),
        "s.dtype",
        "s.description",
    )


@dataclass(frozen=True)
class Grid:
    crs: str
    transform: tuple[float, ...]
    width: int
    height: int
    nodata: float = NODATA
    dtype: str = "float32"

    def bounds(self) -> tuple[float, float, float, float]:
        a, _, c, _, e, f = self.transform
        return c, f + e * self.height, c + a * self.width, f


@dataclass(frozen=True)
class Source:
    type: str
    path: str
    band_labels: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)


def manifest_json(grid: Grid, sources: list[Source], created_utc: str) -> str:
    """A manifest: the grid, then the sources in stack order."""
    a, e = grid.transform[0], grid.transform[4]
    content = {
        "version": 1,
        "created_utc": created_utc,
        "grid": {"crs": grid.crs, "transform": list(grid.transform), "width": grid.width, "height": grid.height, "pixel_size": [a, -e], "dtype": grid.dtype, "nodata": grid.nodata},
        "sources": [{"type": s.type, "path": s.path, "band_labels": list(s.band_labels), **s.extra} for s in sources],
    }
    return json.dumps(content, indent=2)


def index_json(paths: list[str], created_utc: str) -> str:
    return json.dumps({"version": 1, "created_utc": created_utc, "count": len(paths), "manifests": list(paths)}, indent=2)


def _content(path: Path):
    try:
        return json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None


def resolve(path: str | Path) -> list[Path]:
    """The manifests that a file, a folder or an index leads to, each once, in order.

    Folders are read by lower-cased name, with their subfolders; an index's entries are relative to it; unreadable JSON and
    files of another kind are passed over; cycles end. Nothing found is an error.
    """
    start = Path(path)
    if not start.exists():
        raise FileNotFoundError(f"No such manifest, index or folder: {start}")
    found: dict[Path, None] = {}
    seen: set[Path] = set()
    todo = [start.resolve()]
    while todo:
        at = todo.pop(0)
        if at in seen:
            continue
        seen.add(at)
        if at.is_dir():
            inside = sorted((p for p in at.iterdir() if p.is_dir() or p.suffix.lower() == ".json"), key=lambda p: p.name.lower())
            todo = [p.resolve() for p in inside] + todo
            continue
        content = _content(at)
        if not isinstance(content, dict):
            continue
        if isinstance(entries := content.get("manifests"), list) and all(isinstance(x, str) for x in entries):
            todo = [(at.parent / x).resolve() for x in entries] + todo
        elif isinstance(content.get("grid"), dict) and isinstance(content.get("sources"), list):
            found[at] = None
    if not found:
        raise FileNotFoundError(f"No stack manifest below {start}")
    return list(found)
