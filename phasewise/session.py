"""Session settings the operators are designed for."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Run-time SQL settings only: each can be changed on a session somebody else built.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One participant may own a third of all rows.  Without this AQE gives up on splitting
    # a hot join partition whenever a later aggregation reuses the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the run-time settings to a session the caller owns."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


# Bytes of shuffled data that one task gets, compressed.  A task sorts and hashes many times that:
# ids and days of a study compress to a fiftieth of what rows of them take in memory.
TASK_BYTES = 16 << 20
INPUT_BYTES_A_PARTITION = 2 << 20
LARGE_TABLES = ("lineitem", "orders", "events")


def _input_bytes(spark: SparkSession, folder: str, names: Sequence[str]) -> int:
    """Size of the files of some tables, from their listing; no file is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        listed = files.load(f"{folder}/{{{','.join(names)}}}.parquet")
        return listed.agg(F.sum("length")).first()[0] or 0
    except AnalysisException:  # none of them is there
        return 0


def _as_bytes(size: str) -> int:
    """A size as Spark's settings have it: 64m, 65536k, 67108864b."""
    digits, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(digits) << 10 * " kmgtp".index(unit or " ")


def deal(spark: SparkSession, folder: str, names: Sequence[str] = LARGE_TABLES) -> SparkSession:
    """Shuffles in partitions that grow in number with the input and not in size.

    Spark merges them again up to ``TASK_BYTES``, so small inputs do not get small tasks.  A
    smaller size that the caller has set stays, and so does a larger number of partitions.
    """
    sizes = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if _as_bytes(spark.conf.get(sizes)) > TASK_BYTES:
        spark.conf.set(sizes, str(TASK_BYTES))
    wanted = -(-_input_bytes(spark, folder, names) // INPUT_BYTES_A_PARTITION)
    spark.conf.set(number, str(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def local_session(app: str = "phasewise", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        # Plans here are built from many small expressions; recording the Python line of each
        # takes longer than planning them.  A static setting: clusters give it at submission.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
