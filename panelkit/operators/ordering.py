"""Places in a sorted order without a sort in one task.

Rows are dealt out by ranges of (group, order): Spark takes the range bounds from the
rows themselves, so the parts are of about equal size however the values are spread, and a
last column of the range, unique per row, lets rows that are equal otherwise fall into
several parts. The dealt rows are written once under ``spark.checkpoint.dir`` with their
part and their number in it; counts per (part, group) then give every part its start. A
task that runs again after a lost executor reads the written rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import scratch_path

PART, AT = "_part", "_at"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back. Its shuffle files go once it stands: later steps read
    what was written, and the disk need not hold both until the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, group: list[str], order: list[Column], name: str = "ordered") -> DataFrame:
    """``df`` written in the order of (group, order), with PART and AT, a row's number: numbers of a part
    follow each other. Rows equal in group and order come in any order."""
    by = [*[F.col(c) for c in group], *order]
    rows = df.withColumn(AT, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*by, F.col(AT)).sortWithinPartitions(*by, F.col(AT))
    rows = rows.withColumn(AT, F.monotonically_increasing_id()).withColumn(PART, F.shiftright(AT, 33))
    return written(rows, name)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def starts(rows: DataFrame, group: list[str]) -> DataFrame:
    """Per (part, group) of dealt rows: the first number, and the group's rows in earlier parts."""
    runs = rows.groupBy(PART, *group).agg(F.min(AT).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy(PART)) - F.col("_n")
    return runs.withColumn("_before", before)


def positions(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """``df`` with every row's place in its group, 1 for the first by ``order`` (``row_number``)."""
    rows = dealt(df, group, order)
    runs = starts(rows, group).select(F.col(PART).alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_first", "_before")
    on = F.col(PART) == F.col("_p")
    for i, c in enumerate(group):
        on = on & same(F.col(c), F.col(f"_g{i}"))
    place = (F.col(AT) - F.col("_first") + F.col("_before") + 1).cast("bigint")
    return rows.join(runs, on).select(*[F.col(c) for c in df.columns if c != out], place.alias(out))
