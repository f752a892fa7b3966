"""Connected components of a graph given as edges, by alternating large and small stars.

Every round is two joins on aggregated minima; a hub's edges are never gathered in one place.
Rounds are written to the shared folder, so a lost executor costs no lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwright.sources.checkpoints import scratch_folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the folder all executors share and read again; it goes when Spark ends."""
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Scratch:
    """Stored tables of one job that go when its result is stored, so that disks hold less."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folders = spark, []

    def stored(self, df: DataFrame) -> DataFrame:
        folder = scratch_folder(self.spark)
        self.folders.append(folder)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def clear(self) -> None:
        context = self.spark.sparkContext
        for folder in self.folders:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.folders.clear()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``(u, v)``, u > v, hooked to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        hooked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hooked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return hooked.where("u > v").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node hangs on one other node, which hangs on none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("below"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("below")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("below").alias("below"))
    return ends.where("up > 1 or (up = 1 and below = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for nodes ``a``, ``b`` of the edges.

    Loops and repeated edges change nothing; no edges give no rows.
    """
    scratch = Scratch(edges.sparkSession)
    now = scratch.stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    while not _is_done(now):
        now = scratch.stored(_star(_star(now, large=True), large=False))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = stored(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))
    scratch.clear()
    return found
