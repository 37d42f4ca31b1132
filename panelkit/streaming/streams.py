"""Structured Streaming forms of the chunked runs.

Each function starts a streaming query over landed Parquet files, runs it with
``trigger(availableNow=True)`` (all data present now, in bounded micro-batches,
then stop) and returns a batch DataFrame over the sink. ``out`` and
``checkpoint`` name the sink and the query's progress; called again with the
same two, a run reads only what landed since. They belong together: a new
checkpoint needs a new sink. Left out, both are fresh folders under
``spark.checkpoint.dir``, so the run stands alone.

Results that a batch writes go to a folder of that batch's number, replaced as
a whole when Spark repeats the batch after a failure; no earlier result is
touched. What a batch must know of earlier ones (keys, running groups, events of the
last seconds) is kept as tables of bounded reads, see :mod:`.state`.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..operators import incremental as I
from ..sources.sinks import scratch_path
from .state import BATCH, BUCKET, KeyedState, newest, read_or_none

# folders beside the batches of a sink; readers of the sink skip them
KEYS = "_keys"
CARRIED = "_carried"
NEWEST = "_newest"
# columns of the panes of sliding windows: start, first window (both microseconds), newest event
PANE, FIRST, SEEN = "_pane", "_first", "_seen"


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream over Parquet files (schema taken from them): a folder, or a path
    ending in ``.parquet``, which may be one file or a folder without partitions."""
    schema = spark.read.parquet(path).schema
    if path.endswith(".parquet"):
        # a plain file path would be taken as the partition base folder, so it
        # is named through a glob that matches nothing else
        path = f"{path[:-1]}[{path[-1]}]"
    r = spark.readStream.format("parquet").schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _places(spark: SparkSession, name: str, out: str | None, checkpoint: str | None) -> tuple[str, str]:
    if (out is None) != (checkpoint is None):
        raise ValueError("name both the sink and its checkpoint, or neither")
    return out or scratch_path(spark, f"{name}-out"), checkpoint or scratch_path(spark, f"{name}-ckpt")


def run_append(df: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Append-mode stream into a file sink; returns the sink as a batch DataFrame."""
    spark = df.sparkSession
    out, checkpoint = _places(spark, name, out, checkpoint)
    q = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.format(fmt).load(out)


def run_once_per_key(df: DataFrame, keys: list[str], name: str, out: str | None = None,
                     checkpoint: str | None = None, buckets: int = 64, compact_every: int = 20) -> DataFrame:
    """Append one row per key over all batches and restarts, however late it
    arrives: each batch drops the keys that earlier batches wrote. The done keys
    are a table beside the sink, in hash buckets: a batch reads the buckets its own
    keys fall into and no rows of the sink; nothing expires. Null keys count as
    equal. Of a batch's rows with one key the least by all other columns stays."""
    spark = df.sparkSession
    out, checkpoint = _places(spark, name, out, checkpoint)
    done = KeyedState(f"{out.rstrip('/')}/{KEYS}", tuple(keys), buckets, compact_every)
    rest = [c for c in df.columns if c not in keys]

    def sink(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        once = batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*") if rest else batch.dropDuplicates(keys)
        fresh = done.bucketed(once)
        if epoch > 0:
            batch.persist()
            mine = [r[0] for r in done.bucketed(batch.select(*keys)).select(BUCKET).distinct().collect()]  # at most ``buckets``
            schema = StructType([f for f in df.schema.fields if f.name in keys])
            known = done.read(session, schema, before=epoch, buckets=mine).select(*[F.col(k).alias(f"_d_{k}") for k in keys])
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_d_{k}"))
            fresh = fresh.join(known, same, "left_anti")
        fresh.select(*df.columns).write.mode("overwrite").parquet(f"{out}/{BATCH}={epoch}")
        batch.unpersist()
        # the keys go in after the rows: a batch that is cut off between the two is repeated and writes both anew
        done.append(session.read.schema(df.schema).parquet(f"{out}/{BATCH}={epoch}").select(*keys), epoch)

    q = (df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    found = read_or_none(spark, out)
    return (spark.createDataFrame([], df.schema) if found is None else found).select(*df.columns)


def run_update(df: DataFrame, keys: list[str], name: str, out: str | None = None,
               checkpoint: str | None = None, buckets: int = 8, compact_every: int = 20) -> DataFrame:
    """Update-mode aggregate: every batch writes only the groups it changed; the
    result is each group's newest row, read from the last snapshot and the batches
    after it."""
    spark = df.sparkSession
    out, checkpoint = _places(spark, name, out, checkpoint)
    # a window is a struct: groups are told apart by all their columns, compared as values
    state = KeyedState(out, tuple(keys), buckets, compact_every, newest(tuple(keys), [c for c in df.columns if c not in keys]))

    def sink(batch: DataFrame, epoch: int) -> None:
        state.append(batch, epoch)

    q = (df.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return state.read(spark, df.schema).select(*df.columns)


def stream_enrich(stream: DataFrame, lookup: DataFrame, on: list[str], keys: list[str] | None = None,
                  name: str = "stream_enrich", out: str | None = None, checkpoint: str | None = None, **state) -> DataFrame:
    """Stream-static left join (enrich each arriving row), appended to Parquet.
    With ``keys`` a row whose key was enriched before is skipped."""
    rows = stream.join(lookup, on, "left")
    if keys:
        return run_once_per_key(rows, keys, name, out, checkpoint, **state)
    return run_append(rows, name, out, checkpoint)


def stream_counts(stream: DataFrame, keys: list, name: str, aggs: list | None = None,
                  out: str | None = None, checkpoint: str | None = None, **state) -> DataFrame:
    """Running counts (and optional aggregates) folded over all micro-batches."""
    a = aggs or [F.count(F.lit(1)).alias("count")]
    grouped = stream.groupBy(*keys).agg(*a)
    return run_update(grouped, grouped.columns[:len(keys)], name, out, checkpoint, **state)


def stream_dedupe(stream: DataFrame, keys: list[str], name: str = "stream_dedupe",
                  out: str | None = None, checkpoint: str | None = None, **state) -> DataFrame:
    """Each key once across batches and restarts, late rows included."""
    return run_once_per_key(stream, keys, name, out, checkpoint, **state)


def _span_micros(spark: SparkSession, text: str) -> int:
    """Microseconds of an interval text, as ``window`` and ``withWatermark`` take it."""
    base = "timestamp_ntz'1970-01-01 00:00:00'"
    return spark.sql(f"SELECT ({base} + cast(:text AS interval)) - {base}", args={"text": text}).first()[0] // dt.timedelta(microseconds=1)


def stream_window_counts(stream: DataFrame, key: str, ts: str, length: str, slide: str, delay: str,
                         threshold: int, name: str = "stream_window_counts",
                         out: str | None = None, checkpoint: str | None = None, buckets: int = 8, compact_every: int = 20) -> DataFrame:
    """Sliding event-time windows per key; windows reaching ``threshold``.

    The watermark bounds the state: a window that ended ``delay`` before the
    newest event of earlier batches is dropped from it, and so are events that
    arrive for it later; its last written count stays in the result.

    Windows overlap, so the stream keeps and writes the counts of the panes they are made of (as long as the greatest
    common divisor of length and slide), one group an event at most instead of one per window; the result adds each window's
    panes up. A pane stays in the state until its last window is dropped. An event that comes when some windows of its pane have
    been dropped counts in the later ones alone: the sink keeps a pane's counts under the first window they hold for."""
    spark = stream.sparkSession
    out, checkpoint = _places(spark, name, out, checkpoint)
    long, step, late = (_span_micros(spark, x) for x in (length, slide, delay))
    wide = math.gcd(long, step)
    # the first and the last window of a pane, by their starts
    least = F.col(PANE) + (wide - long)
    first, last = least + F.pmod(-least, F.lit(step)), F.col(PANE) - F.pmod(F.col(PANE), F.lit(step))
    keys = (key, PANE, FIRST)
    state = KeyedState(out, keys, buckets, compact_every, newest(keys, ["n", SEEN]))
    panes = (stream.withWatermark(ts, f"{late + long - wide} microseconds")
             .groupBy(F.col(key), F.window(ts, f"{wide} microseconds").alias("_w"))
             .agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias(SEEN)))
    kept = panes.select(F.col(key), F.unix_micros("_w.start").alias(PANE), F.col("n"), F.unix_micros(SEEN).alias(SEEN))
    schema = StructType([stream.schema[key], *[StructField(c, LongType()) for c in (PANE, FIRST, "n", SEEN)]])

    def seen(session: SparkSession, epoch: int) -> int:
        """The newest event, in microseconds, of the batches up to ``epoch``."""
        found = read_or_none(session, f"{out}/{NEWEST}/{BATCH}={epoch}") if epoch >= 0 else None
        return -(1 << 62) if found is None else found.first()[0]

    def sink(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        # Spark holds events of a batch against the watermark that the batch before it worked with: that of the batches before both
        passed = max(seen(session, epoch - 2) // 1000 - late // 1000, 0) * 1000
        opened = F.lit((passed - long) // step * step + step)  # the first window that ends after the watermark
        state.append(batch.withColumn(FIRST, F.greatest(first, opened)).where(F.col(FIRST) <= last).select(*schema.fieldNames()), epoch)
        rows = read_or_none(session, f"{out}/delta/{BATCH}={epoch}")
        top = None if rows is None else rows.agg(F.max(SEEN)).first()[0]
        so_far = seen(session, epoch - 1)
        session.range(1).select(F.lit(so_far if top is None else max(top, so_far)).cast("bigint").alias(SEEN)).write.mode("overwrite").parquet(
            f"{out}/{NEWEST}/{BATCH}={epoch}")

    q = (kept.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    # a pane's counts hold for the windows up to the first of its next counts; a key's rows are as many as the panes it has events in
    after = F.lead(FIRST).over(Window.partitionBy(key, PANE).orderBy(FIRST))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # not fewer: a row becomes as many as its pane has windows
    rows = state.read(spark, schema).repartition(parts, key).withColumn("_to", F.least(F.coalesce(after - step, last), last))
    counts = (rows.select(key, F.explode(F.sequence(FIRST, "_to", F.lit(step))).alias("_s"), "n")
              .groupBy(key, "_s").agg(F.sum("n").alias("n")).where(F.col("n") >= threshold))
    return counts.select(key, F.struct(F.timestamp_micros("_s").alias("start"), F.timestamp_micros(F.col("_s") + long).alias("end")).alias("w"), "n")


def stream_bursts(stream: DataFrame, key: str, ts: str, id_col: str, delay_seconds: int, span_seconds: int = 60,
                  threshold: int = 3, name: str = "stream_bursts", out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """:func:`panelkit.operators.incremental.error_bursts` over a stream: for every event the events of its key in the
    ``span_seconds`` that end with it, exactly, whatever order the files land in, as long as no event lands more than
    ``delay_seconds`` after a later one has been seen.

    An event is settled once the newest event seen is ``delay_seconds`` past it: nothing that can still land changes its
    count. A batch carries over the events that are not settled, and of the settled ones those of the last
    ``span_seconds``, which later events still count; both are bounded by the delay and the span, not by the stream.
    Events that land too late are left out. The sink holds the settled events; the result adds the others with their
    counts so far, so that every event has one row. Columns: ``id_col``, ``key``, n_in_window, burst, settled."""
    spark = stream.sparkSession
    out, checkpoint = _places(spark, name, out, checkpoint)
    carried = f"{out.rstrip('/')}/{CARRIED}"
    cols = [id_col, key, ts]
    schema = StructType([*[stream.schema[c] for c in cols], StructField("settled", BooleanType())])

    micros = F.unix_micros(F.col(ts).cast("timestamp"))

    def line(rows: DataFrame) -> int | None:
        """The time, in microseconds, before which events are settled."""
        newest_at = rows.agg(F.max(micros)).first()[0]
        return None if newest_at is None else newest_at - delay_seconds * 1_000_000

    def counted(rows: DataFrame) -> DataFrame:
        return I.error_bursts(rows, key, ts, span_seconds, threshold, id_col).join(rows.select(id_col, ts, "settled"), id_col)

    def sink(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        before = read_or_none(session, f"{carried}/{BATCH}={epoch - 1}") if epoch else None
        before = session.createDataFrame([], schema) if before is None else before.select(*schema.fieldNames())
        passed = line(before)
        fresh = batch.select(*cols).withColumn("settled", F.lit(False))
        if passed is not None:
            fresh = fresh.where(micros >= passed)
        rows = before.unionByName(fresh)
        at = line(rows)
        now = F.lit(False) if at is None else micros < at
        counted(rows).where(~F.col("settled") & now).select(id_col, key, "n_in_window", "burst").write.mode("overwrite").parquet(
            f"{out}/{BATCH}={epoch}")
        keep = rows.withColumn("settled", F.col("settled") | now)
        if at is not None:
            keep = keep.where(micros >= at - span_seconds * 1_000_000)
        keep.write.mode("overwrite").parquet(f"{carried}/{BATCH}={epoch}")

    q = (stream.select(*cols).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    settled, left = read_or_none(spark, out), read_or_none(spark, carried)
    if left is None:
        return I.error_bursts(spark.createDataFrame([], schema), key, ts, span_seconds, threshold, id_col).withColumn("settled", F.lit(True))
    last = left.agg(F.max(BATCH)).first()[0]  # the newest event seen is always carried on
    open_rows = counted(left.where(F.col(BATCH) == F.lit(last)).select(*schema.fieldNames())).where(~F.col("settled"))
    columns = [id_col, key, "n_in_window", "burst"]
    done = settled.select(*columns) if settled is not None else open_rows.select(*columns).limit(0)
    return done.withColumn("settled", F.lit(True)).unionByName(open_rows.select(*columns).withColumn("settled", F.lit(False)))
