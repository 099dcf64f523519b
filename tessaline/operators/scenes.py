"""Scene selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def fetch_items(catalog: DataFrame, seasons: list[tuple[int, str]], cloud_cover: float) -> DataFrame:
    """Distinct scenes inside the inclusive season windows, with less cloud than the limit; the last of an id's records counts.

    A handful of literal windows becomes one predicate, which reaches the scan.
    """
    inside = F.lit(False)
    for year, season in seasons:
        first_month, first_day, last_month, last_day = S.SEASONS[season]
        inside = inside | F.to_date("ts").between(F.make_date(F.lit(year), F.lit(first_month), F.lit(first_day)), F.make_date(F.lit(year), F.lit(last_month), F.lit(last_day)))
    found = catalog.where(inside & (F.col("cloud_cover") < cloud_cover))
    names = [c for c in found.columns if c != "item_id"]
    latest = found.groupBy("item_id").agg(F.max(F.struct("ord", *(c for c in names if c != "ord"))).alias("r"), F.min("ord").alias("first_ord"))
    return latest.select("item_id", *(F.col(f"r.{c}").alias(c) for c in names if c != "ord"), F.col("first_ord").alias("ord"))


def best_scenes(items: DataFrame, most: int | None) -> DataFrame:
    """At most `most` scenes (item_id, tile_id, cloud_cover, ord, place), spread over tiles, clearest first.

    Each tile first gives its clearest max(1, most // (2 * tiles)) scenes, tiles being asked in first-seen order until `most`
    are taken; the clearest others fill up. Missing cloud cover counts as 100. Without a limit, or with no more scenes than it,
    all stay as they are, and place follows their first-seen order (null without a limit, where nothing is ranked).

    Tile counts are one row per tile. Only the first `most` of a tile, and of all others, can be chosen, so both rankings
    keep that many rows per group before they meet; no window runs over the catalog in one task.
    """
    ranked = items.withColumn("cover", F.coalesce("cloud_cover", F.lit(100.0)))
    if most is None:
        return ranked.withColumn("place", F.lit(None).cast("long")).drop("cover")
    of_tile = Window.partitionBy("tile_id").orderBy("cover", "ord")
    top = ranked.withColumn("rank", F.row_number().over(of_tile)).where(F.col("rank") <= most)
    tiles = items.groupBy("tile_id").agg(F.count("*").alias("n"), F.min("ord").alias("tile_ord"))
    whole = tiles.agg(F.count("*").alias("tiles"), F.sum("n").alias("total"))
    shares = tiles.crossJoin(F.broadcast(whole))  # whole is one row
    share = F.least(F.greatest(F.lit(1), F.floor(F.lit(most) / (F.col("tiles") * 2))), F.col("n"))
    before = Window.orderBy("tile_ord").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("share", share).withColumn("taken", F.coalesce(F.sum("share").over(before), F.lit(0)))
    shares = shares.withColumn("share", F.least("share", F.greatest(F.lit(most) - F.col("taken"), F.lit(0))))
    pool = top.join(shares.select("tile_id", "share", "tile_ord", "total"), "tile_id").withColumn("first_pass", F.col("rank") <= F.col("share"))
    # at most `most` rows of each tile remain; the fill takes the clearest of those not chosen
    chosen = pool.where("first_pass").withColumn("turn", F.lit(0))
    fill = pool.where("not first_pass").orderBy("cover", "ord").limit(most).withColumn("turn", F.lit(1))
    rest = fill.withColumn("fill_rank", F.row_number().over(Window.orderBy("cover", "ord")))
    missing = F.broadcast(chosen.agg((F.lit(most) - F.count("*")).alias("missing")))  # one row
    picked = chosen.unionByName(rest.crossJoin(missing).where("fill_rank <= missing").drop("fill_rank", "missing"))
    whole_order = F.when(F.col("total") <= most, F.col("ord"))  # nothing to choose: the order stays
    tie = [whole_order, F.col("cover"), F.col("turn"), F.when(F.col("turn") == 0, F.col("tile_ord")), F.when(F.col("turn") == 0, F.col("rank")), F.col("ord")]
    sorted_ = picked.withColumn("place", F.row_number().over(Window.orderBy(*tie)))  # at most `most` rows
    return sorted_.select("item_id", "tile_id", "cloud_cover", "ord", "place")


def tile_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("tile_id").agg(F.count("*").alias("n"))


def deduplicated(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first record, by order, of each key."""
    names = [c for c in df.columns if c not in (key, order)]
    first = df.groupBy(key).agg(F.min(F.struct(order, *names)).alias("r"))
    return first.select(key, F.col(f"r.{order}").alias(order), *(F.col(f"r.{c}").alias(c) for c in names))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column; each task sends each value once."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()
