"""Planar geometry as expressions: boxes are four columns, rings are arrays of (x, y)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlaps(a: str, b: str) -> Column:
    """Whether the closed boxes of two aliases touch or overlap."""
    return (F.col(f"{a}.minx") <= F.col(f"{b}.maxx")) & (F.col(f"{a}.maxx") >= F.col(f"{b}.minx")) & (F.col(f"{a}.miny") <= F.col(f"{b}.maxy")) & (F.col(f"{a}.maxy") >= F.col(f"{b}.miny"))


def distance(a: str, b: str) -> Column:
    """Distance between two boxes, 0 where they touch."""
    dx = F.greatest(F.lit(0.0), F.col(f"{a}.minx") - F.col(f"{b}.maxx"), F.col(f"{b}.minx") - F.col(f"{a}.maxx"))
    dy = F.greatest(F.lit(0.0), F.col(f"{a}.miny") - F.col(f"{b}.maxy"), F.col(f"{b}.miny") - F.col(f"{a}.maxy"))
    return F.sqrt(dx * dx + dy * dy)


def grown(df: DataFrame, metres: float) -> DataFrame:
    """Boxes grown on every side."""
    return df.withColumns({"minx": F.col("minx") - metres, "miny": F.col("miny") - metres, "maxx": F.col("maxx") + metres, "maxy": F.col("maxy") + metres})


def total_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def clipped_box(a: str, b: str) -> dict[str, Column]:
    """The common part of two boxes."""
    return {f: (F.greatest if f.startswith("min") else F.least)(F.col(f"{a}.{f}"), F.col(f"{b}.{f}")) for f in ("minx", "miny", "maxx", "maxy")}


def ring_area(ring: Column) -> Column:
    """Area within a ring (shoelace)."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    crosses = F.zip_with(ring, following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(crosses, F.lit(0.0), lambda a, c: a + c)) / 2


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies within a ring (crossings of a ray)."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    crossing = lambda p, q: ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"])
    hits = F.zip_with(ring, following, lambda p, q: F.when((p["y"] > y) != (q["y"] > y), F.when(crossing(p, q), 1).otherwise(0)).otherwise(0))
    return F.aggregate(hits, F.lit(0), lambda a, c: a + c) % 2 == 1


def rounded_ring(distance: float, segments: int = 16) -> Column:
    """The ring around a box (minx, miny, maxx, maxy) at a distance, each corner an arc of so many segments.

    For no distance, the box itself.
    """
    corners = [("maxx", "miny", -90), ("maxx", "maxy", 0), ("minx", "maxy", 90), ("minx", "miny", 180)]
    points = []
    for x, y, start in corners:
        for k in range(segments + 1) if distance > 0 else [0]:
            angle = math.radians(start + 90 * k / segments)
            dx, dy = (distance * math.cos(angle), distance * math.sin(angle)) if distance > 0 else (0.0, 0.0)
            points.append(F.struct((F.col(x) + dx).alias("x"), (F.col(y) + dy).alias("y")))
    return F.array(*points)


def ring_meets_box(ring: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Whether a ring's area and a box share a point: a vertex in the box, a corner in the ring, or sides that cross.

    A side crosses the box if the box's corners don't all lie on one side of its line, and their boxes touch.
    """
    vertex = F.exists(ring, lambda p: (p["x"] >= minx) & (p["x"] <= maxx) & (p["y"] >= miny) & (p["y"] <= maxy))
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    sides = F.zip_with(ring, following, lambda p, q: F.struct(p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy")))

    def crosses(s):
        near = (F.least(s["px"], s["qx"]) <= maxx) & (F.greatest(s["px"], s["qx"]) >= minx) & (F.least(s["py"], s["qy"]) <= maxy) & (F.greatest(s["py"], s["qy"]) >= miny)
        turn = lambda x, y: (s["qx"] - s["px"]) * (y - s["py"]) - (s["qy"] - s["py"]) * (x - s["px"])
        turns = F.array(turn(minx, miny), turn(maxx, miny), turn(maxx, maxy), turn(minx, maxy))
        return near & (F.array_min(turns) <= 0) & (F.array_max(turns) >= 0)

    return vertex | in_ring(minx, miny, ring) | F.exists(sides, crosses)
