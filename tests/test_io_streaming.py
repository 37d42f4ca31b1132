"""Sinks (dynamic partition overwrite, CSV reader checks) and streaming runs."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelkit.operators import schema as SH
from panelkit.sources import sinks as SK
from panelkit.streaming import streams as ST

from conftest import SMALL, rows


def test_partitioned_rewrite_does_not_duplicate(spark):
    df = spark.createDataFrame([(1, "2024march"), (2, "2024march"), (1, "2024april")],
                               "channel_id bigint, month_key string")
    path = SK.scratch_path(spark, "t-part")
    SK.write_partitioned(df, path, "month_key", ["channel_id"])
    SK.write_partitioned(df, path, "month_key", ["channel_id"])
    assert spark.read.parquet(path).count() == 3
    # a rerun with one month replaces only that month's partition
    SK.write_partitioned(df.where("month_key = '2024april'").withColumn("channel_id", F.lit(9).cast("bigint")),
                         path, "month_key")
    back = spark.read.parquet(path)
    assert rows(back, "channel_id", "month_key") == [(1, "2024march"), (2, "2024march"), (9, "2024april")]
    assert "PartitionFilters: [isnotnull(month_key" in back.where("month_key = '2024april'")._jdf \
        .queryExecution().executedPlan().toString()


def test_read_fact_csv(spark):
    d = tempfile.mkdtemp(prefix="panelkit-csv-", dir="/tmp")
    path = os.path.join(d, "seed.csv")
    cols = SH.SEED_REQUIRED
    lines = [",".join(cols)]
    base = {c: "" for c in cols}
    for cid, month, avg, rank in [("1", " March ", "1,234", "5"), ("abc", "march", "1", "1"),
                                  ("12.0", "april", "NaN", "0"), ("", "april", "2", "2")]:
        r = dict(base, year="2024", month=month, channel_id=cid, average_viewers=f'"{avg}"', rank_position=rank,
                 display_name='"Multi\nLine"')
        lines.append(",".join(r[c] for c in cols))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    df = SH.read_fact_csv(spark, path, multi_line=True)
    got = rows(df, "channel_id", "month_key", "average_viewers", "display_name")
    assert got == [(1, "2024march", None, "Multi\nLine"), (12, "2024april", None, "Multi\nLine")]
    with pytest.raises(ValueError, match="columns absent"):
        SH.require_columns(df.drop("top_game"), SH.SEED_REQUIRED)


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "channel_id bigint, top_game string")
    assert SH.final_projection(df.withColumn("year", F.lit(1))).columns == ["year", "channel_id"]
    assert SH.drop_columns(df).columns == ["channel_id"]
    with pytest.raises(ValueError):
        SH.drop_columns(df.select("channel_id"))
    e = SH.ensure_columns(df, {"streams": (0, "bigint"), "top_game": ("z", "string")})
    assert e.first().asDict() == {"channel_id": 1, "top_game": "x", "streams": 0}


def test_streaming_matches_batch(spark):
    path = f"{SMALL}/events.parquet"
    s = ST.file_stream(spark, path)
    counts = ST.stream_counts(s, ["event_type"], "t-stream-counts")
    batch = spark.read.parquet(path).groupBy("event_type").count()
    assert rows(counts) == rows(batch)
    ev = ST.file_stream(spark, path).select("user_id", F.col("ts").cast("timestamp").alias("ts")) \
        .withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    dd = ST.stream_dedupe(ev, ["user_id", "day"], "t-dedupe")
    assert dd.count() == spark.read.parquet(path).select("user_id", F.to_date("ts")).distinct().count()


def test_csv_and_append_sinks(spark):
    df = spark.createDataFrame([(1, "a,b", "x")], "channel_id bigint, name string, extra string")
    out = SK.scratch_path(spark, "t-csv")
    SK.write_csv(df.select("channel_id", "name"), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["channel_id", "name"] and back.first()["name"] == "a,b"
    app = SK.scratch_path(spark, "t-append")
    for _ in range(2):
        SK.append_records(df, app, ["channel_id", "name", "status"])
    got = spark.read.parquet(app)
    assert got.columns == ["channel_id", "name", "status"] and got.count() == 2


def test_stream_dedupe_late_files_and_restart(spark):
    """Newest file first, one per batch; a later run with the same folders reads only what landed since."""
    src, out, ckpt = (SK.scratch_path(spark, f"t-late-{n}") for n in ("src", "out", "ckpt"))
    days = spark.read.parquet(f"{SMALL}/events.parquet").select("user_id", F.to_date("ts").alias("day"))
    cuts = [r["day"] for r in days.select("day").distinct().orderBy(F.desc("day")).collect()]
    third = max(1, len(cuts) // 3)
    parts = [days.where(F.col("day").isin(cuts[i:i + third])) for i in range(0, len(cuts), third)]

    def run():
        return ST.stream_dedupe(ST.file_stream(spark, src, max_files=1), ["user_id", "day"], out=out, checkpoint=ckpt)
    for i, p in enumerate(parts[:2]):
        p.coalesce(1).write.mode("append").parquet(src)
    run()
    for p in [*parts[2:], parts[0]]:
        p.coalesce(1).write.mode("append").parquet(src)
    assert rows(run()) == rows(days.distinct())
    with pytest.raises(ValueError):
        ST.stream_dedupe(ST.file_stream(spark, src), ["day"], out=out)


def test_stream_counts_resume(spark):
    src, out, ckpt = (SK.scratch_path(spark, f"t-resume-{n}") for n in ("src", "out", "ckpt"))
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    for _ in range(2):
        df.write.mode("append").parquet(src)
        got = ST.stream_counts(ST.file_stream(spark, src), ["k"], "t-resume", out=out, checkpoint=ckpt)
    assert rows(got, "k", "count") == [("a", 4), ("b", 2)]


def test_append_batch_once(spark, monkeypatch):
    path, columns = SK.scratch_path(spark, "t-batches"), {"channel_id": "bigint", "name": "string", "rank": "bigint"}
    one = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "channel_id int, name string, extra string")
    for _ in range(2):
        SK.append_batch(one, path, columns, "2024-01")
    SK.append_batch(one.limit(1), path, columns, "2024-02")
    got = SK.read_appended(spark, path, columns)
    assert dict(got.dtypes) == columns and rows(got) == [(1, "a", None), (1, "a", None), (2, "b", None)]
    # a batch that is cut off: rows without a note, then written whole
    SK._typed(one, columns).write.parquet(f"{path}/batch=2024-03")
    assert SK.read_appended(spark, path, columns).count() == 3
    SK.append_batch(one, path, columns, "2024-03")
    assert SK.read_appended(spark, path, columns).count() == 5
    with pytest.raises(ValueError):
        SK.append_batch(one, path, columns, "a/b")


def keyed_state(spark, **more):
    from panelkit.streaming.state import KeyedState
    return KeyedState(SK.scratch_path(spark, "t-state"), ("k",), buckets=8, **more)


def test_state_reads_its_buckets_only(spark):
    state = keyed_state(spark, compact_every=3)
    df = spark.range(4000).select(F.col("id").alias("k"))
    for n in range(5):
        state.append(df.where(F.col("k") % 5 == n), n)
    assert state.snapshot_batch(spark) == 2
    assert rows(state.read(spark, df.schema)) == rows(df)
    some = state.read(spark, df.schema, buckets=[3])
    scans = [x for x in some._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters: [" in x]
    assert scans and all("bucket#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)

    def files(d):
        return {r[0] for r in d.select(F.input_file_name()).distinct().collect()}
    read = files(state._parts(spark, state.snapshot_batch(spark), None, None)[1])
    assert read and not any(f"batch_id={n}/" in f for n in (0, 1, 2) for f in read)  # the snapshot holds these
    assert rows(some) == rows(state.bucketed(df).where("bucket = 3").select("k"))
    assert state.read(spark, df.schema, before=4).count() == 3200


def test_state_survives_a_cut_compaction(spark, monkeypatch):
    from panelkit.streaming import state as ST2
    state = keyed_state(spark, compact_every=2, merge=ST2.newest(("k",), ["v"]))

    def batch(n):
        return spark.createDataFrame([(i, n * 100 + i) for i in range(n, n + 3)], "k long, v long")
    state.append(batch(0), 0)
    real = ST2.KeyedState._note
    monkeypatch.setattr(ST2.KeyedState, "_note", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.append(batch(1), 1)                                          # the snapshot is written, not noted
    want = [(0, 0), (1, 101), (2, 102), (3, 103)]
    assert state.snapshot_batch(spark) == -1 and rows(state.read(spark, batch(0).schema)) == want
    monkeypatch.setattr(ST2.KeyedState, "_note", real)
    for _ in range(2):                                                     # the batch is repeated, and once more
        state.append(batch(1), 1)
        assert state.snapshot_batch(spark) == 1 and rows(state.read(spark, batch(0).schema)) == want
    state.append(batch(2), 2)
    assert rows(state.read(spark, batch(0).schema)) == [(0, 0), (1, 101), (2, 202), (3, 203), (4, 204)]


def test_once_per_key_keeps_one_row_by_order_and_null_keys(spark):
    src, out, ckpt = (SK.scratch_path(spark, f"t-once-{n}") for n in ("src", "out", "ckpt"))
    landings = [[(1, "b"), (1, "a"), (None, "n")], [(1, "0"), (2, "z"), (None, "m")], [(2, "y"), (3, None)]]
    for i, part in enumerate(landings):
        spark.createDataFrame(part, "k long, v string").coalesce(1).write.mode("append").parquet(src)
        if i != 1:
            got = ST.stream_dedupe(ST.file_stream(spark, src, max_files=1), ["k"], out=out, checkpoint=ckpt, compact_every=2)
    assert rows(got, "k", "v") == [(1, "a"), (2, "z"), (3, None), (None, "n")]


def test_bursts_of_a_stream_equal_the_batch(spark):
    import random
    from panelkit.operators import incremental as I
    rnd, base = random.Random(4), 1_700_000_000
    data = [(i, rnd.randrange(4), base + rnd.randrange(4000)) for i in range(400)] + [(1000 + i, 9, base + 60 * i) for i in range(40)]
    events = spark.createDataFrame(data, "event_id long, user_id long, s long").select("event_id", "user_id", F.timestamp_seconds("s").alias("ts"))
    delay = 500                                                            # an event lands up to 500 s after its time
    lands = {i: s + rnd.randrange(delay) for i, _, s in data}
    src, out, ckpt = (SK.scratch_path(spark, f"t-bursts-{n}") for n in ("src", "out", "ckpt"))
    by_landing = sorted(data, key=lambda r: lands[r[0]])
    size = len(data) // 8 + 1
    for n, at in enumerate(range(0, len(data), size)):
        ids = [r[0] for r in by_landing[at:at + size]]
        events.where(F.col("event_id").isin(ids)).coalesce(1).write.mode("append").parquet(src)
        if n in (2, 7):
            got = ST.stream_bursts(ST.file_stream(spark, src, max_files=1), "user_id", "ts", "event_id", delay, 60, 3, out=out, checkpoint=ckpt)
    want = I.error_bursts(events, "user_id", "ts", 60, 3)
    columns = ("event_id", "user_id", "n_in_window", "burst")
    assert rows(got, *columns) == rows(want, *columns)
    newest = max(s for _, _, s in data)
    assert {r["event_id"] for r in got.where("not settled").collect()} == {i for i, _, s in data if s >= newest - delay}
    kept = spark.read.parquet(f"{out}/{ST.CARRIED}").where("batch_id = 7")
    assert kept.agg(F.min("ts")).first()[0].timestamp() >= newest - delay - 60
