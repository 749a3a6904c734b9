"""Helpers that several corpus operators use."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.sources.tables import stored

__all__ = ["TEST_FOLD", "components", "fold", "free_name", "picked", "small_batches", "stored", "table", "width"]

FOLDS = 3
TEST_FOLD = 1
BATCH_ROWS = 10_000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; rows of fold 1 are never learned from. Null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, unless they find it by themselves."""
    package = Path(__file__).resolve().parents[1]
    context, name = spark.sparkContext, f"{package.name}.zip"
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(package.parent) in found or any(Path(f).name == name for f in context.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(), name)
    with zipfile.ZipFile(path, "w") as packed:
        for source in package.rglob("*.py"):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Before Python code runs in tasks: bound the rows and bytes of the batches that a worker is sent."""
    shipped(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def width(spark: SparkSession) -> int:
    """Number of tasks that a shuffle is dealt to."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def picked(ids: DataFrame, by: str, rows: int) -> DataFrame:
    """(by, doc_id, total) of at most ``rows`` ids of each group, those with the smallest hash; ``total`` is the size of the group.

    Ids whose hash lies beyond about twice the wanted share are left out before the window, so no group meets whole in one task.
    ``ids`` holds distinct (by, doc_id); the table of group sizes is as small as the number of groups.
    """
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(1 << 40)
    near = ids.withColumn("share", share).join(F.broadcast(ids.groupBy(by).agg(F.count("*").alias("total"))), by).where(F.col("share") * F.col("total") <= 2 * rows + 100)
    order = W.partitionBy(by).orderBy("share", "doc_id")
    return near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows).select(by, "doc_id", "total")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet (names are compared without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Connected components of an undirected graph as rows (id, component), component the smallest id reachable.

    Alternates the large-star and small-star rewirings, which keep the components and move every vertex
    towards the smallest vertex it can reach; the number of rounds grows with the logarithm of the longest path. Minima are taken with
    partial aggregation, so a vertex with many neighbours is no hot group; each round's edges are written to the
    shared folder. Vertices without an edge do not appear.
    """
    now = stored(_pairs(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), f"{name}-edges")
    mark = None
    while True:
        now = stored(_small_star(_large_star(now)), f"{name}-edges")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    heads = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(heads)


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges, the larger end first."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a vertex to the vertex's smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return _pairs(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a vertex and its smaller neighbours to the smallest of them."""
    least = _least(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _pairs(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def missed(n: int, p: float, least: int) -> float:
    """Chance that fewer than ``least`` of ``n`` independent trials of chance ``p`` succeed."""
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(least))
