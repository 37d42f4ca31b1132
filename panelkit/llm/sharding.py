"""Sharding by balanced label propagation, in DataFrame operations only.

Documents are linked when their texts are equal. Every linked document starts in
a shard given by its id; in each round a group votes, and its documents move
towards the shard holding most of their neighbours that still has room. Moves
into a shard are admitted by lot up to the room it has, so a group larger than a
shard fills one shard after another and no shard passes its quota. Documents
without links fill what is left. The law kept is ``rows``: shard counts differ by
at most one.

Groups never meet in one task: votes are counts per (group, shard) combined on the
map side, and slots come from counts per (shard, bucket) plus a row number inside
a bucket of about BUCKET_ROWS rows. The driver sees one row per shard.

A link is an equal 64-bit hash, CRC and size of the text; a false link could only
move a document to another shard. Defined cases: null text has no bytes and
counts as equal to empty text; a null doc_id stays null; every row is placed,
repeated ones too; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import narrow, public_id, write_table

N_SHARDS = 24
ROUNDS = 12
LOTS = 4096
BUCKET_ROWS = 2000


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index + 1)


def _loads(state: DataFrame, n_shards: int) -> list[int]:
    found = {r[0]: r[1] for r in state.groupBy("shard").count().collect()}  # a row per shard
    return [found.get(b, 0) for b in range(n_shards)]


def _round(state: DataFrame, caps: list[int], n_shards: int, turn: int) -> tuple[DataFrame, bool]:
    """One round over (doc_id, size, text_crc32, hub, shard); the second value tells whether anything moved."""
    room = [c - n for c, n in zip(caps, _loads(state, n_shards), strict=True)]
    votes = state.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("votes"))
    best = (votes.filter(_pick(room, F.col("shard")) > 0).groupBy("hub")
            .agg(F.max(F.struct("votes", (-F.col("shard")).alias("minus"))).alias("best")))
    moves = (votes.join(best, "hub").filter(F.struct("votes", (-F.col("shard")).alias("minus")) < F.col("best"))
             .select("hub", "shard", (-F.col("best.minus")).alias("dest")))
    asked = write_table(state.join(moves, ["hub", "shard"], "left").withColumn(
        "lot", F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(LOTS))), "labels")
    demand = asked.filter("dest is not null").groupBy("dest", "lot").count()
    so_far = F.sum("count").over(Window.partitionBy("dest").orderBy("lot"))  # at most LOTS rows a shard
    admitted = (demand.withColumn("so_far", so_far).filter(F.col("so_far") <= _pick(room, F.col("dest")))
                .groupBy("dest").agg(F.max("lot")).collect())
    last = {r[0]: r[1] for r in admitted}
    limits = [last.get(b, -1) for b in range(n_shards)]
    moved = F.when(F.col("dest").isNotNull() & (F.col("lot") <= _pick(limits, F.col("dest"))), F.col("dest"))
    return (asked.withColumn("shard", F.coalesce(moved, "shard")).select(*state.columns), bool(last))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, rounds: int = ROUNDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit(""))
    base = write_table(narrow(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))
        .withColumn("hub", F.xxhash64("h", "text_crc32", "size")).drop("h"), "labels")
    total = base.count()
    caps = [total // n_shards + (b < total % n_shards) for b in range(n_shards)]
    hubs = base.groupBy("hub").count().filter("count > 1").select("hub")
    flagged = write_table(base.join(hubs.withColumn("linked", F.lit(True)), "hub", "left"), "labels")
    state = flagged.filter("linked").select(
        "doc_id", "size", "text_crc32", "hub", F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)).cast("int").alias("shard"))
    for turn in range(rounds):
        state, moved = _round(state, caps, n_shards, turn)
        if not moved:
            break
    load = _loads(state, n_shards)
    held = [min(n, c) for n, c in zip(load, caps, strict=True)]
    single = F.lit(-1)
    placed = state.select("doc_id", "size", "text_crc32", F.col("shard").alias("label")).unionByName(
        flagged.filter("linked is null").select("doc_id", "size", "text_crc32", single.cast("int").alias("label")))
    n_single = total - sum(load)
    buckets = max(1, -(-total // BUCKET_ROWS))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(buckets)))
    counts = placed.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("label").orderBy("bucket")) - F.col("n")).drop("n")
    ranked = (placed.withColumn("r", F.row_number().over(Window.partitionBy("label", "bucket").orderBy("doc_id")) - 1)
              .join(before, ["label", "bucket"]).withColumn("r", F.col("r") + F.col("before")))
    # what is not held by its label: the unlinked, then what stands beyond a shard's quota
    over, at = [], n_single
    for n, h in zip(load, held, strict=True):
        over.append(at - h)
        at += n - h
    index = F.greatest("label", F.lit(0))
    stays = (F.col("label") >= 0) & (F.col("r") < _pick(held, index))
    pool = F.when(F.col("label") < 0, F.col("r")).otherwise(F.col("r") + _pick(over, index))
    ends, end = [], 0
    for c, h in zip(caps, held, strict=True):
        end += c - h
        ends.append(end)
    starts = [e - (c - h) for e, c, h in zip(ends, caps, held, strict=True)]
    free = reduce(lambda a, b: a + b, [(F.col("pool") >= F.lit(e)).cast("int") for e in ends[:-1]]) if n_shards > 1 else F.lit(0)
    return (ranked.withColumn("stays", stays).withColumn("pool", F.when(~stays, pool)).withColumn("free", free)
            .select(public_id(), "size", "text_crc32", F.lit("rows").alias("law"),
                    F.when(F.col("stays"), F.col("label")).otherwise(F.col("free")).cast("int").alias("shard"),
                    F.when(F.col("stays"), F.col("r")).otherwise(
                        F.col("pool") - _pick(starts, F.col("free")) + _pick(held, F.col("free"))).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
