"""Sinks."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewise.operators.ranks import ordinals


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    order: tuple[str, ...] = (),
    ordinal: str | None = None,
) -> None:
    """Overwrite a table; ``order`` sorts it, which is the only place a global sort pays.  Files
    keep no order of their own once they are read side by side, so ``ordinal`` names a column
    for the place of each row."""
    if order and ordinal:
        df = ordinals(df, order, ordinal).orderBy(ordinal)
    elif order:
        df = df.orderBy(*order)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    writer.save(path)


def write_dated(df: DataFrame, path: str, run_date: datetime.date | None = None) -> None:
    """Add a result set under its run date, replacing an earlier run of the same date."""
    day = run_date or datetime.date.today()
    (
        df.withColumn("run_date", F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The result set of the latest run date; only that partition is read."""
    runs = spark.read.parquet(path)
    latest = runs.select(F.max("run_date").alias("run_date"))
    return runs.join(F.broadcast(latest), "run_date", "left_semi").drop("run_date")
