"""Exact dedup by distributed MSD radix partitioning.

Documents are split by successive byte ranges of their normalised text (white
space deleted): the first range of every document, then, only for documents
whose prefix another document shares, the next and wider range, until a group
is a singleton or its texts have ended. Two texts are in one group at the end
exactly when all their bytes are equal; no digest decides equality. Ranges grow
fourfold, so a text of n bytes takes log4(n / 64) + 1 rounds, and a round moves
only one range of the documents still in doubt.

Defined cases: null text counts as empty; all empty texts are one group; a null
doc_id sorts last; every row is a document of its own, rows without a doc_id and
rows that share one too (of equal ones, the first that is read stays); very long texts
are split range by range, a task holding one text at a time beside its slice; other
columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import WHITE, binary, keyed, slices, write_table

FIRST_RANGE = 64
RANGE_GROWTH = 4


def _describe(batches):
    for b in slices(batches):
        norm = [(t or b"").translate(None, WHITE) for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.record_batch([
            b.column("doc_id"), b.column("n_points"), binary([t[:FIRST_RANGE] for t in norm]),
            pa.array([hashlib.sha256(t).hexdigest() for t in norm], pa.string()),
        ], ["doc_id", "n_points", "part", "text_sha256"])


def _rest(batches):
    for b in slices(batches):
        norm = [(t or b"").translate(None, WHITE)[FIRST_RANGE:] for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.record_batch([b.column("doc_id"), binary(norm)], ["doc_id", "rest"])


def _split(parts: DataFrame, width: int) -> DataFrame:
    """Members of the subgroups (grp, part) with two documents or more, under the subgroup's
    smallest doc_id; counts are combined on the map side, so a huge group is no huge task. They are
    written, so that both sides of the join back are plain shuffles, whose hot keys adaptive
    execution divides (it does not above an aggregate)."""
    found = write_table(parts.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("sub"))
                        .filter("n > 1").drop("n"), "radix")
    return parts.join(found, ["grp", "part"]).select(
        "doc_id", F.col("sub").alias("grp"), (F.octet_length("part") < width).alias("ended"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).
    The document with the most code points in its original text, then the smallest doc_id, stays."""
    rows, restored = keyed(docs, id_col, text_col)
    base = (rows.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_points"), "text")
            .mapInArrow(_describe, "doc_id long, n_points int, part binary, text_sha256 string"))
    base = write_table(base, "radix")
    level = write_table(_split(base.select("doc_id", F.lit(0).cast("long").alias("grp"), "part"), FIRST_RANGE), "radix")
    done = level.filter("ended").select("doc_id", "grp")
    open_ = level.filter("not ended").select("doc_id", "grp")
    if open_.limit(1).count():
        # the ids grow with the corpus, so they are never broadcast; one row per id needs no further shuffle
        rest = write_table(rows.select("doc_id", "text").join(open_.select("doc_id").hint("merge"), "doc_id", "left_semi")
                           .mapInArrow(_rest, "doc_id long, rest binary"), "radix")
        at, width = 0, FIRST_RANGE * RANGE_GROWTH
        while open_.limit(1).count():
            parts = open_.join(rest.select("doc_id", F.substring("rest", at + 1, width).alias("part")), "doc_id")
            level = write_table(_split(parts, width), "radix")
            done = done.unionByName(level.filter("ended").select("doc_id", "grp"))
            open_ = level.filter("not ended").select("doc_id", "grp")
            at, width = at + width, width * RANGE_GROWTH
    members = done.join(base.select("doc_id", "n_points"), "doc_id")
    best = members.groupBy("grp").agg(
        F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus_id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    placed = members.join(best, "grp").select(
        "doc_id", (-F.col("best.minus_id")).alias("keep_id"), F.col("n").alias("group_size"))
    keep = F.coalesce("keep_id", "doc_id")
    out = base.join(placed, "doc_id", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (keep == F.col("doc_id")).alias("kept"), "text_sha256")
    return restored(out, "doc_id", "keep_id").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
