"""Windows, grids and spatial joins of boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G

#: Side of the cells by which boxes are matched.
CELL = 1024.0


def offsets(size: Column, window: Column, overlap: Column) -> Column:
    """Starts of overlapping windows that cover `size`, the last one flush with the end."""
    last = size - window
    regular = F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.greatest(window - overlap, F.lit(1)))
    return F.when(last <= 0, F.array(F.lit(0))).otherwise(F.array_sort(F.array_distinct(F.concat(regular, F.array(last)))))


def windows(spark: SparkSession, height: int, width: int, window: int, overlap: int) -> DataFrame:
    """row_off, col_off, h and w of each window over a raster."""
    one = spark.range(1)
    out = one.select(F.explode(offsets(F.lit(height), F.lit(window), F.lit(overlap))).alias("row_off"))
    out = out.select("row_off", F.explode(offsets(F.lit(width), F.lit(window), F.lit(overlap))).alias("col_off"))
    return out.select("row_off", "col_off", F.lit(min(window, height)).alias("h"), F.lit(min(window, width)).alias("w"))


def training_grid(spark: SparkSession, height: int, width: int, tile: int, stride: int, buffer: int = 0) -> DataFrame:
    """windows() that advance by the stride, each grown by the buffer and cut at the raster's edges."""
    out = windows(spark, height, width, tile, tile - stride)
    low, high = lambda c: F.greatest(F.col(c) - buffer, F.lit(0)), lambda c, n, most: F.least(F.col(c) + F.col(n) + buffer, F.lit(most))
    return out.select(low("row_off").alias("row_off"), low("col_off").alias("col_off"), (high("row_off", "h", height) - low("row_off")).alias("h"), (high("col_off", "w", width) - low("col_off")).alias("w"))


def assigned(pixels: DataFrame, height: int, width: int, window: int, overlap: int) -> DataFrame:
    """pixels with row_off and col_off, once for each window that holds them.

    The starts that hold a coordinate follow from it in closed form, so no pixel meets a window that doesn't hold it, and the
    cost per pixel doesn't grow with the raster. Pixels outside the raster are in no window.
    """
    out = pixels
    for at, size, name in (("row", height, "row_off"), ("col", width, "col_off")):
        out = out.withColumn(name, F.explode(holding(F.col(at), size, window, overlap)))
    return out


def holding(at: Column, size: int, window: int, overlap: int) -> Column:
    """The starts, among offsets(), of the windows that hold a coordinate."""
    last, step = size - window, max(window - overlap, 1)
    if last <= 0:
        return F.when(at.between(0, size - 1), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    at = at.cast("long")
    first = F.greatest(F.lit(0), F.ceil((at - window + 1) / step))
    final = F.least(F.floor(at / step), F.lit(last // step))
    none = F.array().cast("array<long>")
    regular = F.when(first <= final, F.transform(F.sequence(first, F.greatest(first, final)), lambda k: k * step)).otherwise(none)
    flush = F.when((at >= last) & F.lit(last % step != 0), F.array(F.lit(last).cast("long"))).otherwise(none)
    found = F.filter(F.concat(regular, flush), lambda o: (o <= at) & (at < o + window))
    return F.when(at.between(0, size - 1), found).otherwise(none).cast("array<int>")


def metre_grid(bounds: DataFrame, step: float) -> DataFrame:
    """id and box of each tile from the lower left of the bounds on, x outer; the last tiles may overhang."""
    count = lambda low, high: F.greatest(F.ceil((F.col(high) - F.col(low)) / step).cast("int"), F.lit(0))
    cells = bounds.withColumns({"nx": count("minx", "maxx"), "ny": count("miny", "maxy")}).where("nx > 0 and ny > 0")
    cells = cells.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    x, y = F.col("minx") + F.col("i") * step, F.col("miny") + F.col("j") * step
    return cells.select((F.col("i").cast("long") * F.col("ny") + F.col("j")).alias("id"), x.alias("minx"), y.alias("miny"), (x + step).alias("maxx"), (y + step).alias("maxy"))


def chunks(spark: SparkSession, height: int, width: int, chunk: int) -> DataFrame:
    """Chunk grid: row_off, col_off, h, w; edge chunks are cut."""
    out = spark.range(0, height, chunk).select(F.col("id").cast("int").alias("row_off")).crossJoin(spark.range(0, width, chunk).select(F.col("id").cast("int").alias("col_off")))
    return out.select("row_off", "col_off", F.least(F.lit(chunk), F.lit(height) - F.col("row_off")).alias("h"), F.least(F.lit(chunk), F.lit(width) - F.col("col_off")).alias("w"))


def in_cells(df: DataFrame, margin: float = 0.0) -> DataFrame:
    """df once for each cell that its box, grown by the margin, touches: cx, cy."""
    span = lambda low, high: F.sequence(F.floor((F.col(low) - margin) / CELL), F.floor((F.col(high) + margin) / CELL))
    return df.withColumn("cx", F.explode(span("minx", "maxx"))).withColumn("cy", F.explode(span("miny", "maxy")))


def pairs(a: DataFrame, b: DataFrame, predicate: Column, margin: float = 0.0) -> DataFrame:
    """The rows of both sides (aliases a and b) whose boxes share a cell and satisfy the predicate; a pair may repeat.

    An equi-join on cells, which hashes and splits like any other, instead of comparing all boxes with all.
    """
    left, right = in_cells(a).alias("a"), in_cells(b, margin).alias("b")
    return left.join(right, (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy")) & predicate)


def touching(a: DataFrame, b: DataFrame, margin: float = 0.0) -> DataFrame:
    """The distinct ids of a whose box touches a box of b, or lies less than a positive margin from one.

    Where b has a column ring and there is no margin, its rings decide instead of their boxes.
    """
    near = G.distance("a", "b") < margin if margin > 0 else G.overlaps("a", "b")
    if "ring" in b.columns and margin <= 0:
        near = near & G.ring_meets_box(F.col("b.ring"), *(F.col(f"a.{c}") for c in ("minx", "miny", "maxx", "maxy")))
    return pairs(a, b, near, margin).select(F.col("a.id").alias("id")).distinct()


def semi(a: DataFrame, b: DataFrame, margin: float = 0.0) -> DataFrame:
    return a.join(touching(a, b, margin), "id", "left_semi")


def anti(a: DataFrame, b: DataFrame, margin: float = 0.0) -> DataFrame:
    return a.join(touching(a, b, margin), "id", "left_anti")


def interior_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """The distinct ids of a whose interior meets the interior of a box of b."""
    strict = (F.col("a.minx") < F.col("b.maxx")) & (F.col("a.maxx") > F.col("b.minx")) & (F.col("a.miny") < F.col("b.maxy")) & (F.col("a.maxy") > F.col("b.miny"))
    return pairs(a, b, strict).select(F.col("a.id").alias("id")).distinct()


def safe(tiles: DataFrame, labels: DataFrame, inventory: DataFrame, margin: float) -> DataFrame:
    """Tiles at least `margin` from every label and clear of every inventory box.

    Equal to lying within the area less the grown labels and the inventory, without building that geometry.
    """
    return anti(tiles, labels, margin).join(interior_overlap(tiles, inventory), "id", "left_anti")


def first_match(tiles: DataFrame, manifests: DataFrame) -> DataFrame:
    """id and the first manifest, by ord, whose box touches the tile; tiles without one are left out."""
    return pairs(tiles, manifests, G.overlaps("a", "b")).groupBy(F.col("a.id").alias("id")).agg(F.min("b.ord").alias("manifest_ord"))


def match_counts(tiles: DataFrame, other: DataFrame, name: str) -> DataFrame:
    """id and how many boxes of the other side touch the tile; tiles with none are left out."""
    return pairs(tiles, other, G.overlaps("a", "b")).groupBy(F.col("a.id").alias("id")).agg(F.count_distinct("b.id").alias(name))


def burned(pixels: DataFrame, shapes: DataFrame) -> DataFrame:
    """pixels (id, x, y) with burned: 1 where the centre lies in a box of shapes, else 0."""
    points = pixels.select("id", F.col("x").alias("minx"), F.col("x").alias("maxx"), F.col("y").alias("miny"), F.col("y").alias("maxy"))
    hit = touching(points, shapes).withColumn("burned", F.lit(1))
    return pixels.join(hit, "id", "left").withColumn("burned", F.coalesce("burned", F.lit(0)))


def ranked_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("rank = 1").drop("rank")
