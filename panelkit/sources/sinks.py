"""Writers: partitioned Parquet with dynamic overwrite, CSV, appends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def write_partitioned(df: DataFrame, path: str, partition_col: str = "month_key",
                      sort_cols: list[str] | None = None, buckets: int = 8) -> None:
    """Parquet partitioned by ``partition_col``; re-running replaces only the
    partitions present in ``df`` (dynamic overwrite), so reruns never duplicate.

    Each partition value is spread over up to ``buckets`` tasks by a hash of the
    sort columns (of all plain columns where none are given), in one pass over
    ``df``; each task writes sorted files into few partition folders."""
    keys = [partition_col, *(sort_cols or [])]
    plain = sort_cols or [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in plain]), F.lit(buckets))
    out = df.repartition(F.col(partition_col), spread).sortWithinPartitions(*keys)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def _typed(df: DataFrame, columns: list[str] | dict[str, str]) -> DataFrame:
    """The columns of a fixed list (extra ones ignored, missing ones null). A dict gives their types; without one a
    missing column is a string."""
    types = columns if isinstance(columns, dict) else {}
    return df.select(*[(F.col(c).cast(types[c]) if c in types else F.col(c)).alias(c) if c in df.columns
                       else F.lit(None).cast(types.get(c, "string")).alias(c) for c in columns])


def append_records(df: DataFrame, path: str, columns: list[str] | dict[str, str], fmt: str = "parquet") -> None:
    """Append rows under a fixed column list (extra columns ignored, missing ones null)."""
    _typed(df, columns).write.mode("append").format(fmt).option("header", True).save(path)


NOTES = "_batches"  # folder inside an appended table: a note per whole batch


def append_batch(df: DataFrame, path: str, columns: list[str] | dict[str, str], batch: str) -> None:
    """Append the rows of a named batch once: written again, it takes its own place and adds nothing.

    The rows go to a folder of the batch, and a note follows when they are whole. :func:`read_appended` reads noted batches
    only, so one that was cut off is not seen until it is written again."""
    if not batch or "/" in batch:
        raise ValueError("a batch needs a name without '/'")
    path = path.rstrip("/")
    _typed(df, columns).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    df.sparkSession.range(1).select(F.lit(batch).alias("name")).write.mode("overwrite").parquet(f"{path}/{NOTES}/note={batch}")


def read_appended(spark: SparkSession, path: str, columns: list[str] | dict[str, str]) -> DataFrame:
    """The rows of all whole batches of :func:`append_batch`."""
    path = path.rstrip("/")
    noted = [r["name"] for r in spark.read.parquet(f"{path}/{NOTES}").select("name").distinct().collect()]  # names, not rows
    return spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in noted]).select(*columns)
