"""Set operations on boxes: unions and differences as disjoint rectangles, their connected parts, and small ones left out.

Areas are cut at the borders of the matching cells, so no step compares all boxes, and the rectangles of a cell are found by
sorting within it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tiles as T
from .store import components, store

#: Parts of at most this area are slivers.
SLIVER = 900.0
SIDES = ["minx", "miny", "maxx", "maxy"]


def cut_to_cells(boxes: DataFrame) -> DataFrame:
    """cx, cy and box: each box once for each cell whose interior it meets, cut to it. Boxes without extent have none."""
    own = boxes.where("maxx > minx and maxy > miny").select(*(F.col(c).cast("double").alias(c) for c in SIDES))
    low = lambda c, cell: F.greatest(c, F.col(cell) * T.CELL)
    high = lambda c, cell: F.least(c, (F.col(cell) + 1) * T.CELL)
    cut = T.in_cells(own).select("cx", "cy", low("minx", "cx").alias("minx"), low("miny", "cy").alias("miny"), high("maxx", "cx").alias("maxx"), high("maxy", "cy").alias("maxy"))
    return cut.where("maxx > minx and maxy > miny")


def strips(cut: DataFrame) -> DataFrame:
    """cx, cy, x0, x1: in each cell the strips between one vertical side and the next."""
    sides = cut.select("cx", "cy", F.explode(F.array("minx", "maxx")).alias("x0")).distinct()
    along = Window.partitionBy("cx", "cy").orderBy("x0")
    return sides.withColumn("x1", F.lead("x0").over(along)).where("x1 is not null")


def covered(cut: DataFrame, strip: DataFrame) -> DataFrame:
    """cx, cy, x0, x1, y0, y1: in each strip the stretches that boxes cover, one after another."""
    met = strip.alias("s").join(cut.alias("b"), (F.col("s.cx") == F.col("b.cx")) & (F.col("s.cy") == F.col("b.cy")) & (F.col("b.minx") <= F.col("s.x0")) & (F.col("b.maxx") >= F.col("s.x1")))
    keys = ["cx", "cy", "x0", "x1"]
    rows = met.select(*(F.col(f"s.{c}").alias(c) for c in keys), F.col("b.miny").alias("miny"), F.col("b.maxy").alias("maxy"))
    order = Window.partitionBy(*keys).orderBy("miny", "maxy")
    far = F.max("maxy").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("far", far)
    run = F.sum(F.when(F.col("far").isNull() | (F.col("miny") > F.col("far")), 1).otherwise(0)).over(order)
    return opened.withColumn("run", run).groupBy(*keys, "run").agg(F.min("miny").alias("y0"), F.max("maxy").alias("y1")).drop("run")


def rectangles(df: DataFrame) -> DataFrame:
    return df.select("cx", "cy", F.col("x0").alias("minx"), F.col("y0").alias("miny"), F.col("x1").alias("maxx"), F.col("y1").alias("maxy"))


def union(boxes: DataFrame) -> DataFrame:
    """The union of boxes as disjoint rectangles (cx, cy and box)."""
    cut = cut_to_cells(boxes)
    return rectangles(covered(cut, strips(cut)))


def difference(area: DataFrame, holes: DataFrame) -> DataFrame:
    """What the boxes of area cover and those of holes don't, as disjoint rectangles (cx, cy and box)."""
    own, other = cut_to_cells(area), cut_to_cells(holes)
    other = other.join(own.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")
    strip = strips(own.unionByName(other))
    keys = ["cx", "cy", "x0", "x1"]
    outer, inner = covered(own, strip), covered(other, strip).select(*keys, F.col("y0").alias("h0"), F.col("y1").alias("h1"))
    met = outer.join(inner, keys, "left").where("h0 is null or (h0 < y1 and h1 > y0)")
    free = outer.join(met.select(*keys, "y0").distinct(), [*keys, "y0"], "left_anti").select(*keys, "y0", "y1")  # all its holes lie beside it
    order = Window.partitionBy(*keys, "y0", "y1").orderBy("h0")
    low = F.greatest(F.col("y0"), F.coalesce(F.lag("h1").over(order), F.col("y0")))
    last = F.lead("h0").over(order).isNull()
    gaps = met.select(*keys, low.alias("from"), F.when(F.col("h0").isNull(), F.col("y1")).otherwise(F.col("h0")).alias("to"), F.when(last & F.col("h0").isNotNull(), F.col("h1")).alias("after"), "y1")
    before = gaps.where("to > from").select(*keys, F.col("from").alias("y0"), F.col("to").alias("y1"))
    after = gaps.where("after is not null and y1 > after").select(*keys, F.col("after").alias("y0"), "y1")
    return rectangles(before.unionByName(after).unionByName(free))


def parts(pieces: DataFrame) -> DataFrame:
    """pieces (disjoint rectangles) with part: the number of the connected part, of sides that share more than a point."""
    with store(pieces.sparkSession, keep=1) as own:
        named = own.put(pieces.select(F.monotonically_increasing_id().alias("id"), *SIDES), "pieces")
        wide = (F.col("a.minx") < F.col("b.maxx")) & (F.col("a.maxx") > F.col("b.minx")) & (F.col("a.miny") <= F.col("b.maxy")) & (F.col("a.maxy") >= F.col("b.miny"))
        high = (F.col("a.minx") <= F.col("b.maxx")) & (F.col("a.maxx") >= F.col("b.minx")) & (F.col("a.miny") < F.col("b.maxy")) & (F.col("a.maxy") > F.col("b.miny"))
        edges = T.pairs(named, named, (F.col("a.id") < F.col("b.id")) & (wide | high)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
        labels = components(edges, own).select(F.col("node").alias("id"), "label")
        return own.put(named.join(labels, "id", "left").select(*SIDES, F.coalesce("label", "id").alias("part")), "parts")


def area_of(pieces: DataFrame, *keys: str) -> DataFrame:
    return pieces.groupBy(*keys).agg(F.sum((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))).alias("area"))


def without_slivers(parted: DataFrame, least: float = SLIVER) -> DataFrame:
    """The rectangles of the parts whose area is above `least`."""
    return parted.join(area_of(parted, "part").where(F.col("area") > least).select("part"), "part", "left_semi")


def safe_zone(area: DataFrame, labels: DataFrame, inventory: DataFrame, margin: float = 100.0, least: float = SLIVER) -> DataFrame:
    """The connected parts, above `least` in area, of an area less its labels, grown by the margin, and the inventory.

    Rectangles with their part. Labels grow as squares, so at a label's corners the zone keeps a little more distance than the
    margin; tiles.safe() decides by the exact distance. Without labels and inventory the whole area is safe.
    """
    grown = labels.select(F.col("minx") - margin, F.col("miny") - margin, F.col("maxx") + margin, F.col("maxy") + margin).toDF(*SIDES)
    return without_slivers(parts(difference(area, grown.unionByName(inventory.select(*SIDES)))), least)


def union_bounds(boxes: DataFrame) -> DataFrame | None:
    """One row: the box around all boxes; None if there are none."""
    out = boxes.agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))
    return None if boxes.isEmpty() else out
