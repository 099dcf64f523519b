"""Areas of interest from text: bounding boxes, JSON, GeoJSON and WKT, as lists of polygon rings.

A hole is a ring that runs clockwise, an outer ring runs the other way, whatever the source's order; so signed areas add up, and a
point lies in an area if it lies in an odd number of its rings.
"""

from __future__ import annotations

import json
import math
import re
from pathlib import Path

Ring = list[tuple[float, float]]


def box(minx: float, miny: float, maxx: float, maxy: float) -> Ring:
    return [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy)]


def _open(ring) -> Ring:
    points = [(float(p[0]), float(p[1])) for p in ring]
    return points[:-1] if len(points) > 1 and points[0] == points[-1] else points


def signed_area(ring: Ring) -> float:
    """Area within a ring, negative if it runs clockwise (a hole)."""
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1])) / 2


def polygon(rings) -> list[Ring]:
    """The outer ring, anticlockwise, and its holes, clockwise."""
    out = []
    for k, ring in enumerate(map(_open, rings)):
        out.append(ring if (signed_area(ring) >= 0) == (k == 0) else ring[::-1])
    return out


def area(rings: list[Ring]) -> float:
    """Area of all rings, less their holes."""
    return sum(map(signed_area, rings))


def contains(rings: list[Ring], x: float, y: float) -> bool:
    """Whether a point lies inside, and in no hole."""
    inside = False
    for ring in rings:
        for p, q in zip(ring, ring[1:] + ring[:1]):
            if (p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0]:
                inside = not inside
    return inside


def _geometry(content: dict) -> list[Ring]:
    if content.get("type") == "FeatureCollection":
        return [r for f in content["features"] for r in _geometry(f)]
    own = content.get("geometry", content)
    kind, coordinates = own.get("type"), own.get("coordinates")
    if kind == "Polygon":
        return polygon(coordinates)
    if kind == "MultiPolygon":
        return [r for p in coordinates for r in polygon(p)]
    if kind == "GeometryCollection":
        return [r for g in own["geometries"] for r in _geometry(g)]
    if kind in ("Point", "MultiPoint", "LineString", "MultiLineString"):
        return [hull(_flat(coordinates))]
    raise ValueError(f"Unsupported geometry: {kind}")


def _flat(coordinates) -> Ring:
    if coordinates and isinstance(coordinates[0], (int, float)):
        return [(float(coordinates[0]), float(coordinates[1]))]
    return [p for c in coordinates for p in _flat(c)]


def _wkt(text: str) -> list[Ring]:
    kind = text.split("(", 1)[0].strip().upper()
    if kind not in ("POLYGON", "MULTIPOLYGON"):
        raise ValueError(f"Unsupported area: {text[:40]}")
    body = text[text.index("(") :]
    polygons = re.findall(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)", body)
    points = lambda g: [tuple(map(float, p.split()[:2])) for p in g.split(",")]
    rings = [r for p in polygons for r in polygon([points(g) for g in re.findall(r"\(([^()]*)\)", p)])]
    if not rings:
        raise ValueError(f"Empty area: {text[:40]}")
    return rings


def hull(points: Ring) -> Ring:
    """Convex hull (monotone chain)."""
    own = sorted(set(points))
    if len(own) < 3:
        return own

    def half(sequence):
        out: Ring = []
        for p in sequence:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(own) + half(own[::-1])


def parse(text: str) -> list[Ring]:
    """The polygons of an area: `minx,miny,maxx,maxy`, a JSON list of four, a GeoJSON geometry, feature or collection, or WKT."""
    own = text.strip()
    if not own:
        raise ValueError("The area is empty")
    if own[0] in "[{":
        content = json.loads(own)
        if isinstance(content, list):
            if len(content) != 4:
                raise ValueError("A list must hold minx, miny, maxx, maxy")
            return [box(*map(float, content))]
        return _geometry(content)
    if own.count(",") == 3 and "(" not in own:
        return [box(*map(float, own.split(",")))]
    return _wkt(own)


def bounds(rings: list[Ring]) -> tuple[float, float, float, float]:
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    return min(xs), min(ys), max(xs), max(ys)


def grown_box(rings: list[Ring], metres: float) -> Ring:
    """The box around an area in degrees, grown by a distance; not at all for a distance of 0 or less."""
    import math

    minx, miny, maxx, maxy = bounds(rings)
    if metres <= 0:
        return box(minx, miny, maxx, maxy)
    dy = metres / 111320.0
    dx = metres / (111320.0 * math.cos(math.radians((miny + maxy) / 2)))
    return box(minx - dx, miny - dy, maxx + dx, maxy + dy)


def cleaned(rings: list[Ring]) -> list[Ring]:
    """Rings without repeated points; what has no area is dropped. Nothing left is an error. Sides that cross are not untangled."""
    out = []
    for ring in rings:
        own = [p for k, p in enumerate(ring) if p != ring[k - 1]]
        if len(own) > 2 and abs(signed_area(own)) > 0:
            out.append(own)
    if not out:
        raise ValueError("The area holds no polygon")
    return out


def polygons(rings: list[Ring]) -> list[list[Ring]]:
    """The single polygons of an area: each outer ring with the holes that follow it."""
    out: list[list[Ring]] = []
    for ring in cleaned(rings):
        if signed_area(ring) > 0 or not out:
            out.append([ring])
        else:
            out[-1].append(ring)
    return out


def read(source: str) -> list[Ring]:
    """An area from text, or from a file of such text; binary vector files and empty files are errors."""
    own = Path(source)
    try:
        there = own.is_file()
    except OSError:  # a long text is no path
        there = False
    if not there:
        return cleaned(parse(source))
    if own.suffix.lower() in (".gpkg", ".shp"):
        raise ValueError(f"{own.suffix} files need another reader; give the area as text, JSON or WKT")
    return cleaned(parse(own.read_text(encoding="utf-8")))


def rounded(ring: Ring, distance: float, segments: int = 16) -> Ring:
    """A convex ring, grown by a distance with arcs of so many segments for each right angle; others are grown from their hull.

    For no distance, the ring itself.
    """
    if distance <= 0:
        return ring
    arc = [(distance * math.cos(k * math.pi / 2 / segments), distance * math.sin(k * math.pi / 2 / segments)) for k in range(4 * segments)]
    return hull([(x + dx, y + dy) for x, y in hull(ring) for dx, dy in arc])
