"""What the operators share: tables, text rules, cuts of the lineage and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ASCII_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Settings of Python tasks: Arrow batches that stay small with long texts, and workers that
    find this package where it lies, if it isn't installed."""
    root, found = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in found.get("PYTHONPATH", "").split(os.pathsep):
        found["PYTHONPATH"] = os.pathsep.join(filter(None, [root, found.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def lower_ascii(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.  Unset (local tests): a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='phasewise-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: nothing above it runs again, and a lost
    executor costs only the tasks it was running."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_cut(df: DataFrame) -> None:
    """Remove the files of a table made by `cut`, once nothing reads them any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


LINKS_A_TASK = 50_000


def _tasks(spark: SparkSession, links: int) -> int:
    """How many tasks read what a shuffle of so many links deals out: one for every LINKS_A_TASK, and
    as many as there are cores at least."""
    return max(spark.sparkContext.defaultParallelism, -(-links // LINKS_A_TASK))


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .coalesce(tasks).distinct().coalesce(tasks))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.coalesce(tasks).union(least.select("u", F.col("m").alias("v")).coalesce(tasks)).distinct().coalesce(tasks)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v): the smallest id that can be reached.

    Alternates large and small stars until nothing moves; every round is a few shuffles of at
    most one row per link and is cut, so the plan stays short.  Links of a node to itself are
    allowed and keep the node; null ends must be removed before.  Links and result are worked out
    once, and a shuffle of few links is read by few tasks, however many partitions it has: the
    driver plans every stage and keeps figures of every task.
    """
    given = cut(edges.select("u", "v").distinct(), "links")
    alone = given.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    now, before, tasks = given.where("u != v"), None, _tasks(edges.sparkSession, 0)
    while (mark := _mark(now)) != before and mark[0]:
        old, tasks = now, _tasks(now.sparkSession, mark[0])
        now = cut(_small_star(_large_star(now, tasks), tasks), "links")
        if before:  # the first links are read again at the end
            delete_cut(old)
        before = mark
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = cut(stars.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component")).coalesce(tasks), "components")
    for done in {given, now} if before else {given}:
        delete_cut(done)
    return found
