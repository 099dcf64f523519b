"""Balanced sampling of tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tiles as T


def shuffled(key: Column, seed: int) -> Column:
    """A repeatable order of integer keys, by arithmetic that every engine does alike and that can't overflow."""
    return (F.pmod(key.cast("long"), F.lit(2147483648)) * 2654435761 + seed) % 4294967296


def balanced(positives: DataFrame, candidates: DataFrame, ratio: float, seed: int = 42, keep_all_without_positives: bool = True) -> DataFrame:
    """id and class_label: all positives, and a seeded draw of int(positives * ratio) candidates without replacement.

    Fewer candidates are all taken. Without positives all candidates are kept, or none. The draw is a top-k by a hash, which
    each task cuts to k before they meet.
    """
    n = positives.count()
    most = int(n * ratio)
    drawn = candidates.orderBy(shuffled(F.col("id"), seed), "id").limit(most) if n else candidates if keep_all_without_positives else candidates.limit(0)
    return positives.select("id", F.lit(1).alias("class_label")).unionByName(drawn.select("id", F.lit(0).alias("class_label")))


def training_manifest(grid: DataFrame, labels: DataFrame, inventory: DataFrame, margin: float, ratio: float, seed: int = 42) -> DataFrame:
    """id, box and class_label of a balanced training set: tiles that touch a label, and safe tiles drawn among the others."""
    positive = T.semi(grid, labels)
    negative = T.safe(grid.join(positive, "id", "left_anti"), labels, inventory, margin)
    chosen = balanced(positive, negative, ratio, seed, keep_all_without_positives=False)
    return grid.join(chosen, "id")


def sampling_totals(positives: DataFrame, negatives: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: num_pos, num_neg, num_removed."""
    counted = universe.join(positives.select("id", F.lit(1).alias("p")), "id", "left").join(negatives.select("id", F.lit(1).alias("n")), "id", "left")
    return counted.agg(F.count("p").alias("num_pos"), F.count("n").alias("num_neg"), F.count_if(F.col("p").isNull() & F.col("n").isNull()).alias("num_removed"))


def label_cover(pixels: DataFrame, tiles: int = 256) -> DataFrame:
    """One row: the share of tiles that are nearly all foreground, the mean cover of non-empty ones, and the number of tiles.

    The first `tiles` tiles by name are looked at, as a report.
    """
    cover = pixels.groupBy("tile").agg(F.avg(F.when(F.col("v") > 0, 1.0).otherwise(0.0)).alias("cover")).orderBy("tile").limit(tiles)
    return cover.agg(
        F.coalesce(F.avg(F.when(F.col("cover") >= 0.999, 1.0).otherwise(0.0)), F.lit(0.0)).alias("all_one"),
        F.coalesce(F.avg(F.when(F.col("cover") > 0, F.col("cover"))), F.lit(0.0)).alias("mean_cover"),
        F.count("*").alias("n"),
    )


def best_area(boxes: DataFrame, least_labels: int = 2) -> DataFrame:
    """The candidate box with the most inventory, among those with enough labels and a high enough ratio of the two."""
    fit = boxes.where((F.col("n_labels") >= least_labels) & (F.col("n_inventory") > F.col("n_labels")) & (F.col("n_inventory") / F.col("n_labels") > 1.5))
    return fit.orderBy(F.desc("n_inventory"), "id").limit(1)


def challenge_boxes(labels: DataFrame, size: float, most: int = 50, seed: int = 42) -> DataFrame:
    """Candidate boxes (id and box) of a size around the middles of at most `most` labels, drawn by a repeatable order."""
    drawn = labels.orderBy(shuffled(F.col("id"), seed), "id").limit(most)
    x, y = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    return drawn.select("id", (x - size / 2).alias("minx"), (y - size / 2).alias("miny"), (x + size / 2).alias("maxx"), (y + size / 2).alias("maxy"))


def challenge_area(labels: DataFrame, inventory: DataFrame, size: float, least_labels: int = 2, most: int = 50, seed: int = 42) -> DataFrame:
    """The candidate box with the most inventory for its labels (see best_area), with both counts; no row if none fits.

    All candidates are scored at once; a search that stops at the first good one would do less here, not more.
    """
    boxes = challenge_boxes(labels, size, most, seed)
    counted = boxes.join(T.match_counts(boxes, labels, "n_labels"), "id").join(T.match_counts(boxes, inventory, "n_inventory"), "id")
    return best_area(counted, least_labels)
