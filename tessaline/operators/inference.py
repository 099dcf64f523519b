"""Overlapped sliding-window scoring, and regions of its mask."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import tiles as T
from .store import components, store


def window_scores(pixels: DataFrame, height: int, width: int, window: int, overlap: int, scorer) -> DataFrame:
    """row, col, row_off, col_off and probabilities: scorer(pixels in windows) -> a column of logits, under a softmax."""
    placed = T.assigned(pixels, height, width, window, overlap)
    return placed.withColumn("probabilities", S.softmax(scorer(placed)))


def block_function(cells: DataFrame, block: int, function: Callable[[np.ndarray], np.ndarray], value: str, out: str = "value") -> DataFrame:
    """row, col and out: a function of two-dimensional arrays applied to each block of block by block cells.

    Missing cells are NaN and stay out of the result. A block is one bounded group; blocks don't see their neighbours.
    """

    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        top, left = int(frame["row"].min()), int(frame["col"].min())
        array = np.full((int(frame["row"].max()) - top + 1, int(frame["col"].max()) - left + 1), np.nan)
        at = frame["row"].to_numpy() - top, frame["col"].to_numpy() - left
        array[at] = frame["v"].to_numpy(dtype=np.float64, na_value=np.nan)
        return pd.DataFrame({"row": frame["row"], "col": frame["col"], out: np.asarray(function(array), dtype=np.float64)[at]})

    placed = cells.select("row", "col", F.col(value).cast("double").alias("v"), F.floor(F.col("row") / block).alias("br"), F.floor(F.col("col") / block).alias("bc"))
    return placed.groupBy("br", "bc").applyInPandas(apply, f"row int, col int, {out} double")


def model_scores(pixels: DataFrame, height: int, width: int, window: int, overlap: int, model: Callable[[np.ndarray], np.ndarray], channels: int, classes: int) -> DataFrame:
    """row, col, row_off, col_off and probabilities from a vectorised model: (channels, h, w) of a window to logits (classes, h, w).

    pixels: row, col and bands, prepared for the model; missing cells are zeros. Each window is one group of at most
    window * window cells, handed to the model as one array; the model travels to the workers with the plan.
    """
    h, w = min(window, height), min(window, width)

    def apply(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        row_off, col_off = key
        at = frame["row"].to_numpy() - row_off, frame["col"].to_numpy() - col_off
        array = np.zeros((channels, h, w), dtype=np.float32)
        array[:, at[0], at[1]] = np.stack(frame["bands"].to_numpy()).T.astype(np.float32)
        logits = np.asarray(model(array), dtype=np.float64)
        if logits.ndim != 3 or logits.shape[0] != classes:
            raise TypeError(f"The model gave an array of shape {logits.shape}")
        e = np.exp(logits - logits.max(axis=0))
        found = (e / e.sum(axis=0))[:, at[0], at[1]]
        return pd.DataFrame({"row": frame["row"], "col": frame["col"], "row_off": row_off, "col_off": col_off, "probabilities": list(found.T)})

    placed = T.assigned(pixels.select("row", "col", "bands"), height, width, window, overlap)
    return placed.groupBy("row_off", "col_off").applyInPandas(apply, "row int, col int, row_off int, col_off int, probabilities array<double>")


def averaged(scores: DataFrame, classes: int = 2) -> DataFrame:
    """row, col, n and probabilities: the mean over the windows that hold a pixel."""
    sums = [F.sum(F.col("probabilities")[k]).alias(f"p{k}") for k in range(classes)]
    out = scores.groupBy("row", "col").agg(F.count("*").alias("n"), *sums)
    return out.select("row", "col", "n", F.array(*(F.col(f"p{k}") / F.greatest(F.col("n"), F.lit(1e-6)) for k in range(classes))).alias("probabilities"))


def finalised(mean: DataFrame, valid: Column, threshold: float | None = None) -> DataFrame:
    """mean with class_id; pixels without windows or without data are class 0."""
    return mean.withColumn("class_id", F.when(valid & (F.col("n") > 0), S.class_of(F.col("probabilities"), threshold)).otherwise(0))


def regions(mask: DataFrame, width: int, diagonal: bool = False) -> DataFrame:
    """row, col and region (least cell number of its component) of the cells of mask.

    Cells that follow one another in a row are one run, so a region is a graph of its runs, with an edge where runs of
    neighbouring rows touch; its components are found by star contraction. Repeated cells count once; an empty mask gives no
    rows. The labels of the runs stay stored in the folder that all executors share, for the result to read.
    """
    along = Window.partitionBy("row").orderBy("col")
    cells = mask.select("row", "col").distinct()
    starts = cells.withColumn("start", F.when(F.col("col") - F.lag("col").over(along) == 1, None).otherwise(F.col("col")))
    runs = starts.select("row", "col", (F.col("row").cast("long") * width + F.last("start", True).over(along)).alias("run"))
    with store(mask.sparkSession, keep=1) as own:
        placed = own.put(runs, "runs")
        steps = [-1, 0, 1] if diagonal else [0]
        below = placed.select((F.col("row") + 1).alias("row"), F.explode(F.array(*(F.col("col") + k for k in steps))).alias("col"), F.col("run").alias("a"))
        edges = below.join(placed.select("row", "col", F.col("run").alias("b")), ["row", "col"]).select("a", "b").distinct()
        labels = components(edges, own).withColumnRenamed("node", "run")
        found = placed.join(labels, "run", "left").select("row", "col", F.coalesce("label", "run").alias("region"))
        return own.put(found, "regions")


def region_boxes(cells: DataFrame, least_cells: int) -> DataFrame:
    """region, its number of cells and its box, for regions of at least so many cells."""
    out = cells.groupBy("region").agg(F.count("*").alias("area"), F.min("row").alias("row_min"), F.min("col").alias("col_min"), F.max("row").alias("row_max"), F.max("col").alias("col_max"))
    return out.where(F.col("area") >= least_cells)


def outlines(cells: DataFrame, tolerance: float = 0.0, origin: tuple[float, float] = (0.0, 0.0), size: float = 1.0) -> DataFrame:
    """region, area and rings (arrays of x, y) of regions (row, col, region): their outer borders and those of their holes.

    Sides between a cell of a region and one that isn't are found by joins on neighbours; only these sides are gathered by
    region, and chained into rings that keep the region on their left, so holes run clockwise. Cells that touch at a corner
    alone are in separate rings. Rings are simplified up to a tolerance, as distances from the line between kept points; what
    collapses is dropped. origin is the grid's upper left.
    """
    x0, y0 = origin
    here = cells.select("row", "col", "region")
    sides = None
    # by direction: the neighbour, and the side's two corners (row, col) with the cell on the left
    for dr, dc, start, end in ((-1, 0, (0, 1), (0, 0)), (1, 0, (1, 0), (1, 1)), (0, -1, (0, 0), (1, 0)), (0, 1, (1, 1), (0, 1))):
        near = here.select((F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), "region")
        edge = here.join(near, ["row", "col", "region"], "left_anti")
        own = edge.select("region", (F.col("row") + start[0]).alias("r0"), (F.col("col") + start[1]).alias("c0"), (F.col("row") + end[0]).alias("r1"), (F.col("col") + end[1]).alias("c1"))
        sides = own if sides is None else sides.unionByName(own)

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        ahead: dict = {}
        for a, b in sorted(zip(zip(frame["r0"].tolist(), frame["c0"].tolist()), zip(frame["r1"].tolist(), frame["c1"].tolist()))):
            ahead.setdefault(a, []).append(b)
        rings = []
        while ahead:
            start = min(ahead)
            ring, at, last = [], start, None
            while True:
                ring.append(at)
                options = ahead[at]
                # where two rings meet, the turn to the left keeps them apart
                turn = lambda b: 0 if last is None else (at[0] - last[0]) * (b[1] - at[1]) - (at[1] - last[1]) * (b[0] - at[0])  # noqa: B023, E731
                ahead_ = max(options, key=turn)
                options.remove(ahead_)
                if not options:
                    del ahead[at]
                last, at = at, ahead_
                if at == start:
                    break
            points = simplified([(x0 + c * size, y0 - r * size) for r, c in ring], tolerance)
            if len(points) > 2:
                rings.append([{"x": x, "y": y} for x, y in points])
        return pd.DataFrame({"region": [int(frame["region"].iloc[0])], "rings": [rings]})

    found = sides.groupBy("region").applyInPandas(chain, "region long, rings array<array<struct<x:double,y:double>>>")
    return found.join(here.groupBy("region").agg((F.count("*") * size * size).alias("area")), "region").select("region", "area", "rings")


def simplified(ring: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """A closed ring without points that lie within the tolerance of the line between the kept ones (on it, for 0)."""
    if len(ring) < 4:
        return ring
    first = ring.index(min(ring))
    own = ring[first:] + ring[:first]
    far = max(range(len(own)), key=lambda k: (own[k][0] - own[0][0]) ** 2 + (own[k][1] - own[0][1]) ** 2)
    own = [*own, own[0]]
    keep = {0, far, len(own) - 1}
    todo = [(0, far), (far, len(own) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        (ax, ay), (bx, by) = own[a], own[b]
        long = max(((bx - ax) ** 2 + (by - ay) ** 2) ** 0.5, 1e-12)
        off = [abs((bx - ax) * (ay - y) - (ax - x) * (by - ay)) / long for x, y in own[a + 1 : b]]
        most = max(range(len(off)), key=off.__getitem__)
        if off[most] > max(tolerance, 1e-9):
            keep.add(a + 1 + most)
            todo += [(a, a + 1 + most), (a + 1 + most, b)]
    return [own[k] for k in sorted(keep)[:-1]]
