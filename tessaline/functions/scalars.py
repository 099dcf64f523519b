"""Per-pixel and per-record expressions, all of them Catalyst built-ins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BANDS = ["B03", "B04", "B05", "B06", "B08", "B11", "B12"]
ASSETS = ["green", "red", "rededge1", "rededge2", "nir", "swir16", "swir22"]
SCALE = 1 / 10000
NODATA = -9999.0
SEASONS = {"SPR": (3, 1, 5, 31), "SUM": (6, 1, 8, 31), "FAL": (9, 1, 11, 30)}
MASKED_CLASSES = [3, 8, 9, 10, 11]
METRES_PER_DEGREE = 111320.0


def reflectance(dn: Column) -> Column:
    """Digital numbers to reflectance."""
    return dn * SCALE


def season_of(ts: Column) -> Column:
    """SPR, SUM or FAL by month; null in winter."""
    month = F.month(ts)
    out = F.lit(None).cast("string")
    for name, (first, _, last, _) in reversed(SEASONS.items()):
        out = F.when(month.between(first, last), name).otherwise(out)
    return out


def season_start(year: Column, season: Column) -> Column:
    """First day of a season; an unknown season is an error that lists the known ones."""
    return _season_date(year, season, 0)


def season_end(year: Column, season: Column) -> Column:
    return _season_date(year, season, 2)


def _season_date(year: Column, season: Column, at: int) -> Column:
    out = F.raise_error(F.concat(F.lit(f"Unsupported season; expected one of {', '.join(SEASONS)}: "), season)).cast("date")
    for name, bounds in SEASONS.items():
        out = F.when(season == name, F.make_date(year, F.lit(bounds[at]), F.lit(bounds[at + 1]))).otherwise(out)
    return out


def is_clear(scl: Column, masked: list[int] | None = None) -> Column:
    """Whether a scene class is usable; an empty list masks nothing, None the usual classes."""
    own = MASKED_CLASSES if masked is None else masked
    return ~scl.isin(own) if own else F.lit(True)


def is_observed(scl: Column, first_band: Column) -> Column:
    """The stricter test: usable class, data present in class and first band."""
    return is_clear(scl) & (scl != 0) & first_band.isNotNull() & ~F.isnan(first_band.cast("double")) & (first_band != 0)


def clipped(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Into [low, high]; null stays null, which least() and greatest() alone would not keep."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def source_scaled(value: Column, lowest: Column, highest: Column, scale_max: Column, scale_min: Column, nodata: float = NODATA) -> Column:
    """A band's own range if it has one, else the source's; nodata stays; nothing is clipped."""
    own = F.when(highest > lowest, (value - lowest) / (highest - lowest)).otherwise(value)
    whole = F.when(scale_min.isNotNull() & (scale_max > scale_min), (value - scale_min) / (scale_max - scale_min)).otherwise(value / scale_max)
    scaled = F.when(highest.isNotNull() & lowest.isNotNull(), own).when(scale_max.isNotNull(), whole).otherwise(value)
    return F.when(value == nodata, value).otherwise(scaled)


def normalised(value: Column, nodata: float = NODATA) -> Column:
    """Missing, nodata, NaN and -inf to 0, +inf to 1, the rest clipped to [0, 1]."""
    bad = value.isNull() | (value == nodata) | F.isnan(value)
    return F.when(bad, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def to_byte(value: Column) -> Column:
    """[0, 1] to 0..255 by truncation."""
    return F.floor(clipped(value) * 255.0).cast("int")


def from_byte(value: Column) -> Column:
    return value / 255.0


def fitted_channels(bands: Column, channels: int) -> Column:
    """Exactly `channels` bands: cut, or padded with zeros."""
    return F.slice(F.concat(bands, F.array_repeat(F.lit(0.0), channels)), 1, channels)


def prepared(bands: Column, channels: int, nodata: float = NODATA, byte_scale: bool = False) -> Column:
    """A window's pixel as model input: channels fitted, values normalised, optionally divided by 255."""
    return F.transform(fitted_channels(bands, channels), lambda v: normalised(v, nodata) / (255.0 if byte_scale else 1.0))


def softmax(logits: Column) -> Column:
    exps = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(exps, lambda e: e / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b))


def class_of(probabilities: Column, threshold: float | None = None) -> Column:
    """Class 1 from the threshold on, or the likeliest class, the lowest of equals."""
    if threshold is not None:
        return F.when(F.size(probabilities) >= 2, (probabilities[1] >= threshold).cast("int")).otherwise(0)
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def is_valid_pixel(bands: Column, nodata: float | None, first: int | None = None) -> Column:
    """With `first`: any of the first bands has data; else all bands have. Without nodata every pixel is valid."""
    if nodata is None:
        return F.lit(True)
    if first:
        return F.exists(F.slice(bands, 1, first), lambda v: v != nodata)
    return F.forall(bands, lambda v: v != nodata)


def band_label(season: Column, band: Column) -> Column:
    return F.concat_ws("_", F.lit("S2"), season, band)


def tile_of(item_id: Column) -> Column:
    """The second part of a scene's name, or `unknown`."""
    return F.coalesce(F.try_element_at(F.split(item_id, "_"), F.lit(2)), F.lit("unknown"))


def epsg_of(crs: Column) -> Column:
    return F.element_at(F.split(crs, ":"), -1).cast("int")


def dtype_scale(dtype: Column) -> Column:
    """The largest value of an integer type; null for others."""
    out = F.lit(None).cast("double")
    for name, bits in {"uint8": 8, "uint16": 16, "uint32": 32, "int8": 7, "int16": 15, "int32": 31}.items():
        out = F.when(dtype == name, float(2**bits - 1)).otherwise(out)
    return out


def pixel_centre(row: Column, col: Column, minx: float, maxy: float, size: float) -> tuple[Column, Column]:
    return minx + (col + 0.5) * size, maxy - (row + 0.5) * size


def cell_of(x: Column, y: Column, transform: tuple[float, ...]) -> tuple[Column, Column]:
    """Row and column of a point, by the inverse of a north-up affine transform."""
    a, _, c, _, e, f = transform
    return F.floor((y - f) / e).cast("int"), F.floor((x - c) / a).cast("int")


def chunk_size(minx: Column, miny: Column, maxx: Column, maxy: Column, resolution: float = 10.0, least: int = 256, most: int = 1024) -> Column:
    """A quarter of the longer side of a box in degrees, in pixels, as the nearest power of two in [least, most]."""
    width = F.floor((maxx - minx) * METRES_PER_DEGREE * F.cos(F.radians((miny + maxy) / 2)) / resolution)
    height = F.floor((maxy - miny) * METRES_PER_DEGREE / resolution)
    quarter = F.floor(F.greatest(width, height) / 4)
    power = F.pow(F.lit(2.0), F.rint(F.log2(quarter.cast("double"))))
    return F.when(quarter <= 0, least).otherwise(F.greatest(F.lit(least), F.least(F.lit(most), power.cast("int")))).cast("int")


def sampled(value: Column, nodata: Column, scale: float = SCALE) -> Column:
    """Null where the value is the nodata value, up to rounding; else scaled."""
    close = F.abs(value - nodata) <= 1e-8 + 1e-5 * F.abs(nodata)
    return F.when(nodata.isNotNull() & close, None).otherwise(value * scale)


def corner(name: Column, width: int, height: int) -> Column:
    """(row, col) of the corner ll, lr, ul or ur; other names are an error."""
    at = lambda r, c: F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"))
    return F.when(name == "ul", at(0, 0)).when(name == "ur", at(0, width - 1)).when(name == "ll", at(height - 1, 0)).when(name == "lr", at(height - 1, width - 1)).otherwise(
        F.raise_error(F.concat(F.lit("Unknown pixel: "), name)).cast("struct<row:int,col:int>")
    )


def safe_filename(product_id: Column) -> Column:
    return F.concat(F.translate(product_id, " /\\:", "_---"), F.lit(".tif"))


def duration(seconds: Column) -> Column:
    """Hours and minutes, minutes and seconds, or one smaller unit."""
    whole = F.floor(seconds).cast("long")
    return (
        F.when(seconds >= 3600, F.format_string("%dh%02dm", F.floor(whole / 3600), F.floor(whole % 3600 / 60)))
        .when(seconds >= 60, F.format_string("%dm%02ds", F.floor(whole / 60), whole % 60))
        .when(seconds >= 1, F.format_string("%.1fs", seconds))
        .when(seconds >= 1e-3, F.format_string("%.1fms", seconds * 1e3))
        .when(seconds >= 1e-6, F.format_string("%.1fus", seconds * 1e6))
        .otherwise(F.format_string("%.1fns", seconds * 1e9))
    )


def target_size(text: Column) -> Column:
    """[height, width] from `a by b`, `a x b`, `a*b`, `a,b` or one number; null where blank."""
    parts = F.filter(F.split(F.lower(F.trim(text)), r"\s*(?:by|x|\*|,)\s*|\s+"), lambda p: p != "")
    numbers = F.transform(parts, lambda p: p.cast("int"))
    return F.when(F.size(parts) == 0, None).when(F.size(parts) == 1, F.array(numbers[0], numbers[0])).otherwise(numbers)


def is_true(text: Column) -> Column:
    return F.lower(F.trim(text)).isin("1", "true", "yes", "y")


def first_url(urls: Column) -> Column:
    """The first usable address of an array of (lower, upper) records: those under a lower- and an upper-case key."""
    usable = F.filter(F.transform(urls, lambda u: F.coalesce(u["lower"], u["upper"])), lambda u: u.isNotNull() & F.startswith(u, F.lit("http")))
    return F.try_element_at(usable, F.lit(1))


def nearest_overview(overviews: Column, scale: Column) -> Column:
    """The factor closest to scale, the first of equals."""
    ranked = F.transform(overviews, lambda v, i: F.struct(F.abs(v - scale).alias("d"), i.alias("i"), v.alias("v")))
    return F.array_min(ranked)["v"]


def power_of_two(n: int) -> int:
    return 2 ** round(math.log2(n))
