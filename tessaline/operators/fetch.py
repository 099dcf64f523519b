"""Stacks of scenes: checks on their items, and one record per scene of what a chunk's read gave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G, scalars as S


def asset(assets: Column, key: str) -> Column:
    """What an item has under an asset's name; null where it has none."""
    return F.try_element_at(assets, F.lit(key))


def checked_system(items: DataFrame, target: str | int | None = None, assets: list[str] | None = None) -> int:
    """The reference system of a stack: the target's, or the first item's (item_id, ord, epsg, assets).

    No items, a first item without a system where no target is given, or without one of the assets, are errors.
    """
    first = items.orderBy("ord").limit(1).collect()
    if not first:
        raise ValueError("There are no scenes to stack")
    missing = [a for a in assets or [] if a not in (first[0]["assets"] or {})]
    if missing:
        raise ValueError(f"The first scene lacks the asset {missing[0]}")
    if target:
        return int(str(target).split(":")[-1])
    if first[0]["epsg"] is None:
        raise ValueError("The first scene lacks a reference system")
    return int(first[0]["epsg"])


def stacked_bands(items: DataFrame, readings: DataFrame, target: str | int | None = None, names: list[str] | None = None) -> tuple[DataFrame, int]:
    """(item_id, time_index, row, col, bands), and the stack's reference system.

    readings: item_id, row, col and dn, a map from asset to digital number. bands are reflectances in the fixed order of the
    bands, 0 where a reading is missing. time_index counts the items in their order.
    """
    names = names or S.ASSETS
    epsg = checked_system(items, target, names)
    values = F.array(*(S.reflectance(F.coalesce(asset(F.col("dn"), a).cast("double"), F.lit(0.0))) for a in names))
    return readings.join(timed(items), "item_id").select("item_id", "time_index", "row", "col", values.alias("bands")), epsg


def stacked_classes(items: DataFrame, readings: DataFrame, target: str | int | None = None, name: str = "scl") -> tuple[DataFrame, int]:
    """(item_id, time_index, row, col, scl), and the stack's reference system: scene classes, unscaled, 0 where missing."""
    epsg = checked_system(items, target, [name])
    scl = F.coalesce(asset(F.col("dn"), name), F.lit(0)).cast("int")
    return readings.join(timed(items), "item_id").select("item_id", "time_index", "row", "col", scl.alias("scl")), epsg


def timed(items: DataFrame) -> DataFrame:
    """item_id and time_index: its place among the items, by counts of the blocks of 4096 orders before its own.

    Orders are ranked within blocks; only the blocks' counts meet in one task.
    """
    from pyspark.sql import Window

    block = F.floor(F.col("ord") / 4096).alias("block")
    own = items.select("item_id", "ord", block)
    counts = own.groupBy("block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = own.join(counts.select("block", before.alias("before")), "block")
    rank = F.row_number().over(Window.partitionBy("block").orderBy("ord", "item_id")) - 1
    return placed.select("item_id", (F.col("before") + rank).alias("time_index"))


def fetched(items: DataFrame, chunk: tuple[float, float, float, float], names: list[str]) -> DataFrame:
    """One record per item (item_id, time_index, box, assets) for a chunk's box: item_id, time_index, success and error.

    A scene beside the chunk, or without one of the assets, is a record with its reason and not an error. Records are not
    ordered; time_index says their order.
    """
    minx, miny, maxx, maxy = map(float, chunk)
    beside = ~((F.col("minx") < maxx) & (F.col("maxx") > minx) & (F.col("miny") < maxy) & (F.col("maxy") > miny))
    lacking = F.lit(False)
    for n in names:
        lacking = lacking | asset(F.col("assets"), n).isNull()
    error = F.when(beside, "no overlap").when(lacking, "asset missing")
    return items.select("item_id", "time_index", error.isNull().alias("success"), error.alias("error"))


def successes(records: DataFrame) -> DataFrame:
    """The records of scenes that were read."""
    return records.where("success")


def fetched_values(records: DataFrame, readings: DataFrame, names: list[str]) -> DataFrame:
    """(item_id, time_index, row, col, bands) of the scenes that were read: reflectances, null where a reading is missing."""
    values = F.array(*(S.reflectance(asset(F.col("dn"), n).cast("double")) for n in names))
    return readings.join(successes(records).select("item_id", "time_index"), "item_id").select("item_id", "time_index", "row", "col", values.alias("bands"))


def first_nonempty(products: DataFrame, key: str, priority: str = "priority", address: str = "url") -> DataFrame:
    """The products of each key's first dataset, by priority, that has any; products without an address don't count."""
    usable = products.where(F.col(address).isNotNull())
    best = usable.groupBy(key).agg(F.min(priority).alias(priority))
    return usable.join(best, [key, priority], "left_semi")


def catalog_tiles(catalog: DataFrame, area: tuple[float, float, float, float], year: int | None = None, most: int | None = None) -> DataFrame:
    """The tiles of a catalog (id, year, box) that touch an area, of a year if one is given, the first `most` of them by id."""
    minx, miny, maxx, maxy = map(float, area)
    found = catalog.where((F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))
    if year is not None:
        found = found.where(F.col("year") == year)
    return found if most is None else found.orderBy("id").limit(most)


def clipped_shapes(shapes: DataFrame, area: tuple[float, float, float, float]) -> DataFrame:
    """Boxes (id and box) that share more than a side with an area, cut to it; an empty table stays one."""
    minx, miny, maxx, maxy = (F.lit(float(v)) for v in area)
    cut = {"minx": F.greatest("minx", minx), "miny": F.greatest("miny", miny), "maxx": F.least("maxx", maxx), "maxy": F.least("maxy", maxy)}
    return shapes.where((F.col("minx") < maxx) & (F.col("maxx") > minx) & (F.col("miny") < maxy) & (F.col("maxy") > miny)).withColumns(cut)


def paired(left: DataFrame, right: DataFrame, key: str, value: str, default, strict: bool = False) -> DataFrame:
    """left with the value of its partner and whether it has one; without one the default, or, if strict, an error that names it."""
    joined = left.join(right.select(key, value), key, "left")
    missing = F.raise_error(F.concat(F.lit("No partner for "), F.col(key).cast("string"))).cast("int") if strict else F.lit(default)
    return joined.withColumn("paired", F.col(value).isNotNull()).withColumn(value, F.coalesce(value, missing))


def area_seasons(areas: DataFrame, seasons: list[str]) -> DataFrame:
    """Each area once for each season."""
    return areas.select("*", F.explode(F.array(*map(F.lit, seasons))).alias("season"))


def progress(events: DataFrame, keys: list[str], order: list[str], amount: str, whole: float | None = None) -> DataFrame:
    """events with done and total so far, by key; with `whole` also the rate per second since the key's first event, and what is left.

    rate and left are null while no time has passed.
    """
    from pyspark.sql import Window

    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = events.withColumns({"done": F.count("*").over(upto), "total": F.sum(amount).over(upto)})
    if whole is None:
        return out
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    passed = at - F.min(at).over(upto)
    rate = F.try_divide(F.col("done") * 1e6, passed)
    return out.withColumn("rate", rate).withColumn("left", F.try_divide(F.lit(float(whole)) - F.col("done"), F.col("rate")))


def boxes_in(shapes: DataFrame, other: DataFrame) -> DataFrame:
    """Each box of shapes (id) cut by each box of other that it touches: id, other, box."""
    from . import tiles as T

    box = G.clipped_box("a", "b")
    return T.pairs(shapes, other, G.overlaps("a", "b")).select(F.col("a.id").alias("id"), F.col("b.id").alias("other"), *(c.alias(n) for n, c in box.items())).distinct()
