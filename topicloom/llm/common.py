"""Helpers shared by the operators: tables, the shared folder, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share (``spark.checkpoint.dir``).

    Only a local master may do without the setting; it then gets a scratch folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="tl-shared-")
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def texts(column, rows: int = 256):
    """The strings of an Arrow column, a few rows in memory at a time."""
    for i in range(0, len(column), rows):
        yield from column.slice(i, rows).to_pylist()


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so
    a lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected graph.

    ``edges`` has two long columns (a, b).  Returns (v, comp), comp being the
    smallest vertex of v's component, for every vertex with an edge to another
    one.  Alternating large-star and small-star steps (Kiveris et al. 2014); each
    step only needs the smallest neighbour of a vertex, so aggregation happens
    before the shuffle, and no vertex's neighbours are ever gathered."""
    cur = land(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), name)
    while not _is_star(cur):
        both = cur.unionByName(cur.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        first = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(first, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(first.select("v", F.col("m").alias("u")))
            .distinct()
        )
        cur = land(small, name)
    roots = cur.select(F.col("u").alias("v"), F.col("u").alias("comp")).distinct()
    return cur.select("v", F.col("u").alias("comp")).unionByName(roots)


def _is_star(edges: DataFrame) -> bool:
    """Every vertex v has one edge, to a u that has none of its own."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("u").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()
