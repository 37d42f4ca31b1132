"""Merkle manifest of a dataset, with proofs by pointer jumping.

Every row is a leaf, every source a tree of its rows by ascending doc_id, and one tree
over the sources' roots gives the root of the dataset. Trees have ``ARITY`` children a
node; the last node of a level may have fewer, even one.

* ``ranked`` numbers the leaves of every source without a sort in one task: the rows are
  range-partitioned by (source, doc_id), and counts per (partition, source) give each
  partition its start.
* ``grow`` builds ``STEP`` levels in one shuffle: blocks of ARITY ** STEP neighbours, the
  number of a block being the number of its top node.
* ``proofs`` starts with every node holding its siblings (a segment) and its parent (a
  pointer). A round joins nodes with the nodes they point to, appends the segments and takes
  over the pointer, so the distance doubles and a tree of height h takes log2(h) rounds. A
  round keeps only nodes that can still be pointed to. The tree over the sources goes the same
  way, and a last join appends the source's segment to its leaves'. A node above many leaves is
  repeated once per run of BLOCK leaf numbers below it and joined by that run as well, so no
  key of a join has more than a few hundred rows, and the repeats add 1 / BLOCK of the rows.

A segment is a sequence of steps: one byte, left siblings * ARITY + right siblings, and
their digests in order, left to right.

Defined cases: a null counts as ``-`` in a leaf, whatever the column; rows without a source
form a tree of their own, ordered first; a null doc_id comes first in its tree and is never
tampered with; rows that share a doc_id are leaves of their own, ordered by their digests,
and equal rows are interchangeable; an empty text is ``0:``; very long texts are hashed
where they are read and never moved; other columns, whatever their names, are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import binary, bound_batches, write_table

ARITY = 3
STEP = 5
BLOCK = ARITY ** STEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the tree over the sources' roots; its leaf i is the root of the source numbered i


def digest(blobs) -> bytes:
    """H of some digests: SHA-256 of their hex texts, joined."""
    return hashlib.sha256("".join(b.hex() for b in blobs).encode()).digest()


# --- leaves -----------------------------------------------------------------

def field(col: Column, kind: str) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    value = col.cast(kind).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(docs: DataFrame, text: Column) -> Column:
    kinds = {"doc_id": "long", "n_chars": "long"}
    return F.unhex(F.sha2(F.concat(*(field(text if c == "text" else docs[c], kinds.get(c, "string")) for c in FIELDS)), 256))


def without_breaks(docs: DataFrame) -> Column:
    """The tampering of the audit: texts of rows whose doc_id has an even CRC-32 lose their line breaks."""
    even = F.crc32(F.encode(docs["doc_id"].cast("long").cast("string"), "UTF-8")) % 2 == 0
    return F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])


def leaves(docs: DataFrame, tampered=None) -> DataFrame:
    """doc_id, source, digest and, where ``tampered`` changes the text, the digest it then has."""
    text = docs["text"].cast("string")
    out = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), leaf(docs, text).alias("digest"),
                      *([] if tampered is None else [leaf(docs, tampered(docs)).alias("other")]))
    if tampered is None:
        return out.withColumn("other", F.lit(None).cast("binary"))
    return out.withColumn("other", F.when(F.col("other") != F.col("digest"), F.col("other")))


# --- places -----------------------------------------------------------------

def ranked(rows: DataFrame) -> DataFrame:
    """The leaves with ``tree`` (number of the source), ``idx`` (place in it) and ``n`` (its leaves)."""
    dealt = write_table(
        rows.withColumn("at", F.monotonically_increasing_id())  # tells equal rows apart, so they can be split
        .repartitionByRange("source", "doc_id", "digest", "at")
        .sortWithinPartitions("source", "doc_id", "digest", "at")
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle")
    runs = dealt.groupBy("part", "source").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("rows"))
    totals = _numbered(runs.groupBy("source").agg(F.sum("rows").alias("n")))
    before = F.sum("rows").over(Window.partitionBy("source").orderBy("part")) - F.col("rows")
    places = runs.withColumn("before", before).alias("r").join(
        totals.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select("r.part", "r.source", "first_at", "before", "tree", "n")
    # a run of one source in one partition is a bounded key, however hot the source
    return dealt.alias("d").join(
        places.alias("p"), (F.col("d.part") == F.col("p.part")) & F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "tree", (F.col("at") - F.col("first_at") + F.col("before")).alias("idx"), "n", "doc_id", "d.source", "digest", "other")


def _numbered(sources: DataFrame) -> DataFrame:
    """One row a source with its number by (null first, UTF-8 bytes), by range partitions as above."""
    dealt = write_table(sources.repartitionByRange("source").sortWithinPartitions("source")
                        .withColumn("at", F.monotonically_increasing_id()), "merkle")
    runs = dealt.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # one row a partition
    starts = runs.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("start"))
    return dealt.join(F.broadcast(starts), F.shiftright("at", 33) == F.col("part")).select(
        "source", "n", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("tree"))


# --- trees ------------------------------------------------------------------

NODE = "tree long, level int, idx long, n long, digest binary, seg binary, doc_id long, other binary"


def _blocks(base: int):
    """Nodes of ``STEP`` levels over each block; rows keep their order of number. A node below the
    block's top has its step; the top has none yet, or never, if it is the tree's root."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for tree, n, members in zip(*(b.column(c).to_pylist() for c in ("tree", "n", "members")), strict=True):
                members.sort(key=lambda m: m["idx"])
                level, width = base, n
                for _ in range(base):
                    width = -(-width // ARITY)      # nodes of this level in the whole tree
                nodes = [(m["idx"], m["digest"], m["doc_id"], m["other"]) for m in members]
                for _ in range(STEP):
                    if width == 1:
                        break
                    parents = []
                    for lo in range(0, len(nodes), ARITY):
                        run_ = nodes[lo: lo + ARITY]
                        hashes = [x[1] for x in run_]
                        parents.append((run_[0][0] // ARITY, digest(hashes), None, None))
                        for k, (idx, own, doc_id, other) in enumerate(run_):
                            seg = bytes([k * ARITY + len(run_) - 1 - k]) + b"".join(hashes[:k] + hashes[k + 1:])
                            for column, value in zip(out, (tree, level, idx, n, own, seg, doc_id, other), strict=True):
                                column.append(value)
                    nodes, level, width = parents, level + 1, -(-width // ARITY)
                for idx, own, doc_id, other in nodes:
                    for column, value in zip(out, (tree, level, idx, n, own, None, doc_id, other), strict=True):
                        column.append(value)
            yield pa.record_batch(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()),
                 binary(out[4]), binary(out[5]), pa.array(out[6], pa.int64()), binary(out[7])],
                ["tree", "level", "idx", "n", "digest", "seg", "doc_id", "other"])
    return run


def height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def grow(places: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with their step, roots) of all trees over (tree, idx, n, digest, doc_id, other); ``most``
    leaves has the largest. A block holds BLOCK members at most."""
    steps, roots, nodes = [], [], places
    for base in range(0, max(height(most), 1), STEP):
        grouped = (nodes.groupBy("tree", "n", F.expr(f"idx div {BLOCK}").alias("block"))
                   .agg(F.collect_list(F.struct("idx", "digest", "doc_id", "other")).alias("members")))
        made = write_table(grouped.select("tree", "n", "members").mapInArrow(_blocks(base), NODE), "merkle")
        steps.append(made.filter("seg IS NOT NULL"))
        open_ = made.filter("seg IS NULL")
        if base + STEP >= height(most):
            roots.append(open_)
        else:
            # a tree with one node on this level is done
            done = F.col("n") <= F.lit(ARITY ** (base + STEP))
            roots.append(open_.filter(done))
            nodes = open_.filter(~done)
    return _all(steps), _all(roots)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- proofs -----------------------------------------------------------------

POINTER = ["up_level", "up_idx"]
LONG = f"idx * CAST(POW({ARITY}, level) AS LONG)"  # number of a node's first leaf


def _pointers(nodes: DataFrame) -> DataFrame:
    """Nodes with a pointer to their parent, or none where the parent is the root: the segment is whole."""
    more = F.col("n") > F.pow(F.lit(float(ARITY)), F.col("level") + 1)
    return nodes.withColumns({"up_level": F.when(more, F.col("level") + 1), "up_idx": F.when(more, F.expr(f"idx div {ARITY}"))})


def _targets(nodes: DataFrame) -> DataFrame:
    """Nodes once per run of BLOCK leaf numbers below them."""
    last = F.expr(f"LEAST({LONG} + CAST(POW({ARITY}, level) AS LONG), n) - 1")
    run = F.explode(F.sequence(F.expr(f"{LONG} div {BLOCK}"), F.floor(last / BLOCK)))
    return nodes.select(*(F.col(c).alias(f"t_{c}") for c in ("tree", "level", "idx", "seg", *POINTER)), run.alias("t_run"))


def _jump(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """One round: segment and pointer of the node pointed to are appended and taken over."""
    met = nodes.withColumn("run", F.expr(f"{LONG} div {BLOCK}")).join(
        targets, (F.col("tree") == F.col("t_tree")) & (F.col("up_level") == F.col("t_level"))
        & (F.col("up_idx") == F.col("t_idx")) & (F.col("run") == F.col("t_run")), "left")
    return met.select(*(c for c in nodes.columns if c not in {"seg", *POINTER}),
                      F.when(F.col("t_tree").isNull(), F.col("seg")).otherwise(F.concat("seg", "t_seg")).alias("seg"),
                      *(F.col(f"t_{c}").alias(c) for c in POINTER))


def chains(places: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(leaves with their segment up to the root of their tree, roots) of the trees over ``places``."""
    nodes, roots = grow(places, most)
    lone = roots.filter("n = 1").withColumn("seg", F.lit(b"").cast("binary"))
    above = _pointers(nodes.filter("level > 0")).select("tree", "level", "idx", "n", "seg", *POINTER)
    leaves_ = _pointers(nodes.filter("level = 0").unionByName(lone))
    far = 1
    while far < height(most):
        targets = _targets(above)
        leaves_ = write_table(_jump(leaves_, targets), "merkle")
        far *= 2
        if far < height(most):  # from now on only nodes this high are pointed to
            above = write_table(_jump(above.filter(F.col("level") >= far), targets), "merkle")
    return leaves_.drop("level", *POINTER), roots


def proofs(docs: DataFrame, tampered=None) -> tuple[DataFrame, bytes | None]:
    """(one row a leaf: doc_id, digest, other, subroot, seg up to the dataset's root), and the root."""
    bound_batches(docs.sparkSession)
    places = write_table(ranked(write_table(leaves(docs, tampered), "merkle")), "merkle")
    most, sources = places.agg(F.max("n"), F.max("tree") + 1).first()
    if most is None:
        return places.select("doc_id", "digest", "other", F.col("digest").alias("subroot"), F.col("digest").alias("seg")), None
    own, subroots = chains(places.drop("source"), most)
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(sources).cast("long").alias("n"), "digest",
                          F.col("n").alias("doc_id"), F.lit(None).cast("binary").alias("other"))  # doc_id carries the source's size
    upper, root = chains(top, sources)
    # a hot source's row is repeated once a run of its leaves, and joined by that run as well
    runs = upper.select(F.col("idx").alias("s_tree"), F.col("digest").alias("subroot"), F.col("seg").alias("s_seg"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(doc_id - 1) div {BLOCK}"))).alias("s_run"))
    met = own.join(runs, (F.col("tree") == F.col("s_tree")) & (F.expr(f"idx div {BLOCK}") == F.col("s_run")))
    return met.select("doc_id", "digest", "other", "subroot", F.concat("seg", "s_seg").alias("seg")), bytes(root.first()["digest"])


def steps(seg: bytes):
    """(left siblings, right siblings) of each step of a segment."""
    at = 0
    while at < len(seg):
        left, right = divmod(seg[at], ARITY)
        cut = [seg[at + 1 + 32 * k: at + 33 + 32 * k] for k in range(left + right)]
        yield cut[:left], cut[left:]
        at += 1 + 32 * (left + right)


def fold(leaf_digest: bytes, seg: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in steps(seg):
        leaf_digest = digest([*left, leaf_digest, *right])
    return leaf_digest


def _audit(root: bytes | None):
    def run(batches):
        for b in batches:
            proof, folded = [], []
            for own, other, seg in zip(*(b.column(c).to_pylist() for c in ("digest", "other", "seg")), strict=True):
                proof.append(digest([x for left, right in steps(seg) for x in (*left, *right)]).hex())
                folded.append(fold(own if other is None else other, seg))
            n = b.num_rows
            yield pa.record_batch([
                b.column("doc_id"), *(pa.array([x.hex() for x in b.column(c).to_pylist()], pa.string()) for c in ("digest", "subroot")),
                pa.array([root.hex() if root else None] * n, pa.string()), pa.array(proof, pa.string()),
                pa.array([x.hex() for x in folded], pa.string()), pa.array([x == root for x in folded], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def audit(docs: DataFrame, tampered=without_breaks) -> DataFrame:
    """Per row: its leaf, subroot and root in the manifest of ``docs``, the digest of its proof, and the
    root that its text, after ``tampered``, gives with that proof."""
    rows, root = proofs(docs, tampered)
    return rows.mapInArrow(_audit(root), AUDIT)
