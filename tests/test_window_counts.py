"""Sliding windows made of panes: the counts that Spark's own sliding windows give, late events included."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows

from panelkit.streaming import streams as ST


def _sliding(stream, length, slide, delay, threshold, out, ckpt):
    w = (stream.withWatermark("ts", delay).groupBy(F.col("k"), F.window("ts", length, slide).alias("w"))
         .agg(F.count(F.lit(1)).alias("n")))
    return ST.run_update(w, ["k", "w"], "t-sliding", out, ckpt).where(F.col("n") >= threshold)


@pytest.mark.parametrize("length,slide,delay,seed", [
    ("1 hour", "10 minutes", "30 minutes", 1), ("25 minutes", "10 minutes", "1 minute", 2), ("1 day", "1 hour", "2 hours", 4)])
def test_panes_equal_sliding_windows(spark, tmp_path, length, slide, delay, seed):
    """Files land one by one, many events of them late by anything up to days; the stream is started three times."""
    at = random.Random(seed)
    src = str(tmp_path / "src")
    got = want = None
    now, count = 1_700_000_000_000, 0
    for run in range(3):
        for _ in range(2):
            landed = []
            for _ in range(120):
                ts = now - int(at.random() ** 6 * 3 * 86_400_000) + at.randrange(3_600_000)
                landed.append((at.choice([None, 1, 2, 3]), None if at.random() < 0.03 else ts))
            now += at.choice([0, 900_000, 7_200_000, 90_000_000])
            spark.createDataFrame(landed, "k long, ms long").select("k", F.timestamp_millis("ms").alias("ts")) \
                .coalesce(1).write.mode("append").parquet(src)
        made = []
        for name, make in (("panes", lambda *a: ST.stream_window_counts(a[0], "k", "ts", length, slide, delay, 2, out=a[1], checkpoint=a[2], compact_every=3)),
                           ("sliding", lambda *a: _sliding(a[0], length, slide, delay, 2, a[1], a[2]))):
            made.append(make(ST.file_stream(spark, src, max_files=1), str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-ckpt")))
        got, want = (rows(m, "k", F.col("w.start").cast("string"), F.col("w.end").cast("string"), "n") for m in made)
        assert made[0].dtypes == made[1].dtypes
        assert got == want and got, run
        count += len(got)
    assert count > 10


def test_state_holds_a_group_an_event_not_one_a_window(spark, tmp_path):
    spark.range(40).select((F.col("id") % 4).alias("k"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 7200).alias("ts")) \
        .coalesce(1).write.parquet(str(tmp_path / "src"))
    s = ST.file_stream(spark, str(tmp_path / "src"))
    got = ST.stream_window_counts(s, "k", "ts", "1 day", "1 hour", "1 day", 3, out=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o" / "delta")).count() == 40
    brute = {}
    for i in range(40):
        hour = (1_700_000_000 + i * 7200) // 3600
        for h in range(hour - 23, hour + 1):
            brute[(i % 4, h * 3600)] = brute.get((i % 4, h * 3600), 0) + 1
    assert rows(got, "k", F.unix_seconds("w.start"), "n") == sorted((k, h, n) for (k, h), n in brute.items() if n >= 3)
