"""State of a stream as tables: a snapshot, and what later batches added.

A batch appends its rows as ``delta/batch_id=N`` (replaced as a whole when Spark repeats the
batch). Every ``compact_every`` batches the snapshot and the deltas after it are merged into
``snapshot/upto=N``, which counts from the moment its note stands under ``commits``: a run
that is cut off before leaves the older snapshot and all deltas, and the next compaction
writes the folder anew. Reading takes the newest noted snapshot and the deltas after it, so
it costs the state and a bounded number of batches, however many there were.

Snapshots and deltas are partitioned by a hash bucket of the keys; a reader that names its
buckets reads only their files. Superseded folders are left for the caller to clear.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BATCH = "batch_id"
BUCKET = "bucket"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


@dataclass(frozen=True)
class KeyedState:
    """Rows by ``keys`` (null keys count as equal) under ``path``. ``merge`` reduces the rows of a snapshot and of
    deltas, which carry BATCH, to one per key; by default the first key columns alone matter."""
    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    compact_every: int = 20
    merge: Callable[[DataFrame], DataFrame] | None = None

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int"))

    def snapshot_batch(self, spark: SparkSession, before: int | None = None) -> int:
        """The last batch in the newest noted snapshot (of those before batch ``before``), or -1."""
        notes = read_or_none(spark, f"{self.path}/commits")
        if notes is None:
            return -1
        if before is not None:
            notes = notes.where(F.col("upto") < before)
        found = notes.agg(F.max("upto")).first()[0]
        return -1 if found is None else found

    def read(self, spark: SparkSession, schema: StructType, before: int | None = None, buckets: list[int] | None = None,
             snapshot_before: int | None = None) -> DataFrame:
        """One row per key as of the batches before ``before`` (all by default); of ``buckets`` alone if named.
        ``snapshot_before`` takes a snapshot of an earlier batch, so that a newer one can be written."""
        wide = StructType([*schema.fields, StructField(BATCH, IntegerType()), StructField(BUCKET, IntegerType())])
        out = spark.createDataFrame([], wide)
        for p in self._parts(spark, self.snapshot_batch(spark, before if snapshot_before is None else snapshot_before), before, buckets):
            if p is not None:
                out = out.unionByName(p.select(*wide.fieldNames()))
        return self._merged(out).select(*schema.fieldNames())

    def _parts(self, spark: SparkSession, upto: int, before: int | None, buckets: list[int] | None) -> list[DataFrame | None]:
        """The snapshot of batch ``upto``, and the deltas after it and before ``before``."""
        whole = read_or_none(spark, f"{self.path}/snapshot/upto={upto}") if upto >= 0 else None
        deltas = read_or_none(spark, f"{self.path}/delta")
        if deltas is not None:
            later = F.col(BATCH) > upto
            deltas = deltas.where(later if before is None else later & (F.col(BATCH) < before))
        if buckets is None:
            return [whole, deltas]
        mine = F.col(BUCKET).isin(buckets) if buckets else F.lit(False)
        return [None if p is None else p.where(mine) for p in (whole, deltas)]

    def _merged(self, rows: DataFrame) -> DataFrame:
        return self.merge(rows) if self.merge else rows.dropDuplicates(list(self.keys))

    def append(self, rows: DataFrame, batch: int) -> None:
        """The rows of a batch, in one file a bucket; then a compaction, if one is due. No more tasks than buckets: the plan of a
        micro-batch is not adaptive, and each empty task reports to the driver."""
        self.bucketed(rows).repartition(self.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/delta/{BATCH}={batch}")
        if batch % self.compact_every == self.compact_every - 1:
            self.compact(rows.sparkSession, rows.schema, batch)

    def compact(self, spark: SparkSession, schema: StructType, batch: int) -> None:
        """Merge all batches up to ``batch`` into a snapshot, and note it."""
        whole = self.bucketed(self.read(spark, schema, before=batch + 1, snapshot_before=batch)).withColumn(BATCH, F.lit(batch))
        whole.repartition(self.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/snapshot/upto={batch}")
        self._note(spark, batch)

    def _note(self, spark: SparkSession, batch: int) -> None:
        spark.range(1).select(F.lit(batch).alias("note")).write.mode("overwrite").parquet(f"{self.path}/commits/upto={batch}")


def newest(keys: tuple[str, ...], values: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge by the row of the latest batch."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(BATCH)).alias("_v")).select(*keys, "_v.*")
    return merge
