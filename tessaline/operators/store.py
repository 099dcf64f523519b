"""Tables between the rounds of an iterative operator, in the folder that all executors share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset (tests), one below the warehouse."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    return own.rstrip("/") if own else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_rounds"


class Store:
    """Writes tables and deletes them again."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """df as a Parquet table, read again: its lineage and its size estimate start anew."""
        path = f"{folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        """Delete all tables but the last `keep` ones."""
        gone, self.paths = self.paths[: len(self.paths) - keep], self.paths[len(self.paths) - keep :]
        for path in gone:
            own = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            own.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(own, True)


@contextmanager
def store(spark: SparkSession, keep: int = 0):
    """A Store whose tables go at the end, but for the last `keep`, which the result reads; all go after a failure."""
    own = Store(spark)
    try:
        yield own
    except BaseException:
        own.drop()
        raise
    own.drop(keep)


def components(edges: DataFrame, own: Store) -> DataFrame:
    """(node, label) for each node of edges (a, b) that isn't the smallest of its component: label is that smallest node.

    Star contraction: in turn, a node's larger neighbours and its smaller ones are hung on the least of its neighbourhood,
    until each node hangs on one that hangs on none. Rounds grow with the logarithm of the longest path. A node's least
    neighbour is a partial aggregate that is joined back, so nodes with very many edges split like any skewed key. Each round is
    stored; the ones before it are deleted.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, first = own.put(pairs, "pairs"), len(own.paths) - 1
    while True:
        several = now.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low < high")
        if several.isEmpty() and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = own.put(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "larger")
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        rest = hung.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = own.put(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "smaller")
        done = own.paths[first:-1]
        own.paths, last = own.paths[:first], own.paths[-1]
        old = Store(own.spark)
        old.paths = done
        old.drop()
        own.paths.append(last)
