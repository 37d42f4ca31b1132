"""Training in rounds over bounded samples: every shard of the sample is one row,
each round sends the model to the shards and averages what they return."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import NULL_ID, write_table


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id falls in no fold)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def known_labels(labels: DataFrame, column: str, modulus: int, held: int) -> DataFrame:
    """(doc_id, y) of the labelled rows outside the held-out fold; of repeated ids the larger label counts."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
            .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(modulus) != held))
            .groupBy("doc_id").agg(F.max("y").alias("y")))


def about(rows: DataFrame, limit: int, salt: str, total: int | None = None) -> DataFrame:
    """About ``limit`` of the rows, the same ones on every run, by a hash of doc_id."""
    total = rows.count() if total is None else total
    share = min(1.0, limit / total) if total else 1.0
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))


def with_text(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """The documents of a sample; ``picked`` is bounded by the sample's limit, hence the broadcast."""
    return rows.filter(F.col("doc_id") != NULL_ID).join(F.broadcast(picked), "doc_id")


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("doc_id", kind="stable")
    return pd.DataFrame({"shard": rows["shard"].iloc[:1], "y": [rows["y"].to_numpy(np.int8).tobytes()],
                         "sizes": [np.array([len(x) for x in rows["x"]], np.int64).tobytes()], "x": [b"".join(rows["x"])]})


def packed(sample: DataFrame, shards: int) -> DataFrame:
    """(doc_id, y, x binary) rows of a bounded sample as one row per shard."""
    dealt = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int"))
    return write_table(dealt.groupBy("shard").applyInPandas(_pack, "shard int, y binary, sizes binary, x binary"), "sample")


def train(table: DataFrame, step: Callable, merge: Callable, state, rounds: int):
    """``step(state, y, sizes, x)`` gives each shard's answer as arrays; ``merge(state, answers)`` the next state.

    A round's answers, a model per shard, come as Arrow buffers, not as row objects, and its state is given up after it, so
    the driver holds one round's at a time."""
    sc = table.sparkSession.sparkContext
    for _ in range(rounds):
        sent = sc.broadcast(state)

        def run(batches, sent=sent):
            for b in batches:
                for y, sizes, x in zip(*(b.column(c).to_pylist() for c in ("y", "sizes", "x")), strict=True):
                    answer = step(sent.value, np.frombuffer(y, np.int8), np.frombuffer(sizes, np.int64), x)
                    yield pa.record_batch([pa.array([[np.ascontiguousarray(a).tobytes() for a in answer]], pa.list_(pa.binary()))], ["a"])

        answers = [[a.as_buffer() for a in r] for r in table.mapInArrow(run, "a array<binary>").toArrow().column("a")]
        sent.destroy()
        if not answers:
            break
        state = merge(state, answers)
    return state


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
