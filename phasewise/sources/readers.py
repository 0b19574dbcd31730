"""Sources: database tables, CSV exports, raw wearable documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from phasewise.functions.columns import rename_by_patterns
from phasewise.operators.joins import fold_full_join
from phasewise.operators.sets import stack_cohorts
from phasewise.sources.schemas import MINUTE_DOCUMENT

# Spellings of a missing cell in the CSV exports.
MISSING_CELLS = ("", "NA", "NaN", "NaT")


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A parquet table with a declared schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a partitioned JDBC scan, so that executors read slices side by side."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **scan) -> DataFrame:
    """A database table; filters and column choice are pushed into the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **scan)).load()


def blanks_to_null(df: DataFrame, missing: Sequence[str] = MISSING_CELLS) -> DataFrame:
    """Text cells spelling a missing value become NULL."""
    text = {c for c, t in df.dtypes if t == "string"}
    return df.select(
        *[
            F.when(~F.trim(F.col(f"`{c}`")).isin(*missing), F.col(f"`{c}`")).alias(c)
            if c in text else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


REJECT = "__reject"


def csv_with_rejects(
    spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False
) -> DataFrame:
    """A CSV export with a declared schema, every record of it, and why a record is rejected.

    Cells are read as text, missing spellings removed, then cast.  Quotes inside quoted cells are
    doubled, as spreadsheets and data-frame tools write them; commas need quotes, and so do
    line breaks, which call for ``multi_line`` (a file is then read by one task).  Ids
    declared as text keep leading zeros.  Columns are matched by name, so the file may hold
    more of them in another order.

    ``__reject`` is NULL for good records.  Else it is a struct of ``line``, the record as it stands
    in the file where its number of cells is wrong, and ``cells``, the names of the columns whose text does not
    fit their type.  Both come from the scan that reads the rows.
    """
    declared = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns  # the first line of the file
    whole = StructType([StructField(n, StringType()) for n in (*names, "__line")])
    text = spark.read.options(**options, columnNameOfCorruptRecord="__line").schema(whole).csv(path)
    clean = blanks_to_null(text)
    here = [f for f in declared.fields if f.name in names]
    kept = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in here}
    misfits = [
        F.when(F.col(f"`{f.name}`").isNotNull() & kept[f.name].isNull(), F.lit(f.name)) for f in here
    ]
    # A record of the wrong length says nothing about its cells.
    torn = F.col("__line").isNotNull()
    bad = F.filter(F.array(*misfits), lambda c: c.isNotNull()) if misfits else F.array().cast("array<string>")
    reject = F.when(torn, F.struct(F.col("__line").alias("line"), F.array().cast("array<string>").alias("cells"))).when(
        F.size(bad) > 0, F.struct(F.lit(None).cast("string").alias("line"), bad.alias("cells")))
    return clean.select(*[kept[f.name].alias(f.name) for f in here], reject.alias(REJECT))


def reject_kind() -> Column:
    """``good``, ``torn`` for a wrong number of cells or a document that can't be parsed, else the
    names of the columns that do not fit."""
    kind = F.when(F.col(REJECT).isNull(), "good").when(F.col(f"{REJECT}.line").isNotNull(), "torn")
    return kind.otherwise(F.array_join(f"{REJECT}.cells", ", "))


def reject_counts(df: DataFrame) -> DataFrame:
    """Number of records by :func:`reject_kind`."""
    return df.groupBy(reject_kind().alias("kind")).agg(F.count("*").alias("n"))


def read_csv(
    spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False
) -> DataFrame:
    """The records of a CSV export that have the right number of cells; a cell that does not fit its
    type is NULL.  See :func:`csv_with_rejects`, which keeps what this leaves out."""
    rows = csv_with_rejects(spark, path, schema, multi_line)
    return rows.filter(F.col(f"{REJECT}.line").isNull()).drop(REJECT)


def read_cohorts(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema: str | StructType,
    renames: Sequence[tuple[str, str]] = (),
    reader: Callable[[SparkSession, str, str | StructType], DataFrame] = read_csv,
) -> DataFrame:
    """One file per cohort, column names harmonised, stacked with a ``cohort`` column."""
    frames = {
        cohort: rename_by_patterns(reader(spark, path, schema), renames)
        for cohort, path in paths.items()
    }
    return stack_cohorts(frames)


def read_and_join(
    spark: SparkSession, paths: Sequence[str], schemas: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Several files full-joined on common keys."""
    frames = [read_csv(spark, p, s) for p, s in zip(paths, schemas, strict=True)]
    return fold_full_join(frames, keys, null_safe=True)


def phase_averages(df: DataFrame, overall: str = "overall") -> DataFrame:
    """Averages per phase: without the overall rows, phase as a number named study_phase."""
    if "phase" not in df.columns:
        return df
    return (
        df.filter(F.col("phase") != overall)
        .withColumn("phase", F.col("phase").try_cast("int"))
        .withColumnRenamed("phase", "study_phase")
    )


def documents_with_rejects(
    raw: DataFrame, document: str = "json", pid: str = "pid"
) -> DataFrame:
    """Raw wearable documents, one per row, parsed: pid, ``d`` and why a document is rejected.

    ``__reject`` is as in :func:`csv_with_rejects`: ``line`` is the text of a document that is
    not JSON of the declared layout, ``cells`` names a missing ``date`` or ``dataset``.
    """
    layout = MINUTE_DOCUMENT.removesuffix(">") + ",__line:string>"
    parsed = F.from_json(document, layout, {"columnNameOfCorruptRecord": "__line"})
    rows = raw.select(F.col(pid).alias("pid"), F.col(document).alias("__text"), parsed.alias("d"))
    torn = F.col("d").isNull() | F.col("d.__line").isNotNull()
    gaps = F.filter(
        F.array(*[F.when(F.col(f"d.{c}").isNull(), F.lit(c)) for c in ("date", "dataset")]),
        lambda c: c.isNotNull(),
    )
    reject = F.when(torn, F.struct(F.coalesce("__text", F.lit("")).alias("line"), F.array().cast("array<string>").alias("cells"))).when(
        F.size(gaps) > 0, F.struct(F.lit(None).cast("string").alias("line"), gaps.alias("cells")))
    return rows.select("pid", "d", reject.alias(REJECT))


def minutes_from_json(raw: DataFrame, document: str = "json", pid: str = "pid") -> DataFrame:
    """Raw wearable documents, one per row, to a typed minute series.

    The document layout (``schemas.MINUTE_DOCUMENT``) is this library's own.  Rejected documents
    (:func:`documents_with_rejects`) give no rows.
    """
    good = documents_with_rejects(raw, document, pid).filter(F.col(REJECT).isNull())
    rows = good.select("pid", "d.date", F.explode("d.dataset").alias("m"))
    stamp = F.concat_ws(" ", F.col("date"), F.col("m.time")).try_cast("timestamp_ntz")
    return rows.select(
        "pid",
        stamp.alias("ts"),
        F.col("m.heartrate").alias("heartrate"),
        F.col("m.steps").alias("steps"),
        F.col("m.calories").alias("calories"),
        F.col("m.mets").alias("mets"),
        F.col("m.level").alias("activity_level"),
    )
