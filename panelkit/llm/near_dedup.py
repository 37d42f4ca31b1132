"""Near-duplicate detection by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Documents with equal sets
(equal 128-bit digests of the sorted set) form a class with one representative.
Representatives get a MinHash signature and walk down TREES independent trees: at
a node, coordinates chosen by the node alone (one, and a second with the
probability that makes a pair at the threshold keep about one common branch) send
a document to the child of its minwise token. After DEPTHS[0] levels, a node of at
most LEAF documents is compared exhaustively by signature; the documents of a larger
node are paired with the node's most typical members (those with most company further
down, to the last of DEPTHS), so that the copies of one text meet its centre however
many they are. All candidate pairs are then confirmed on the full sets, and components
of the confirmed links are found by star contraction. Last, a larger node is compared
exhaustively, but for pairs already in one component: its documents are dealt into
blocks of about BLOCK documents or BLOCK_BYTES of sets, a task at a time holds two
blocks and counts the common shingles of all their pairs, and what it links joins the
components. That is quadratic in a node's components, not in its copies.

A pair exactly at the threshold is missed by all TREES = 9 trees with probability
4e-4 at 0.85 and 1.3e-3 at 0.80 (computed over the binomial spread of the one
signature that the trees share); the signature filter (MARGIN) loses another 6e-7
and 3e-6. A closer pair is missed with less, and a pair that shares a node over
LEAF is compared without the filter.

Defined cases: null or empty text, or one without words, has no shingles and links
with nothing; a text with fewer words than a shingle is one shingle; a null doc_id
sorts last; every row is a document of its own, rows without a doc_id and rows that share
one too (all but the first of these come after every doc_id); very long texts are one row
of their own slice, with 8 bytes a word in each step; other columns, whatever their names,
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import LOWER, NON_SPACE, binary, buffer_of, keyed, mix, runs, slices, span_hashes, words, write_table
from panelkit.llm.components import components

SHINGLE = 5
PERCENT = 80
COORDS = 96
TREES = 9
DEPTHS = (4, 8, 16, 32)
LEAF = 32
PIVOTS = 4
BLOCK = 1024
BLOCK_BYTES = 8 << 20
COLUMNS = 4096    # shingles counted at once for a pair of blocks
MARGIN = 0.2      # signature estimates this far below the threshold are dropped: about five standard errors

_rng = np.random.Generator(np.random.PCG64(9))
_XOR = _rng.integers(0, 1 << 63, COORDS, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in order of document, and where each document's begin (n + 1 values)."""
    buf, off = buffer_of(column)
    low = LOWER[buf]
    starts, ends, first = words(low, off, NON_SPACE)
    h, n_words, n = span_hashes(low, starts, ends), np.diff(first), len(off) - 1
    doc = np.repeat(np.arange(n), n_words)
    full = runs(h, size)
    inside = doc[: len(full)] == doc[size - 1:] if len(full) else np.zeros(0, bool)
    out, owner = [full[inside]], [doc[: len(full)][inside]]
    for k in range(1, size):  # texts of k words are one shingle of k
        short = np.flatnonzero(n_words == k)
        if len(short):
            out.append(runs(h, k)[first[short]] ^ np.uint64(k))
            owner.append(short)
    g, d = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(d, kind="stable")
    return g[order], np.searchsorted(d[order], np.arange(n + 1))


def _sign(size: int):
    def run(batches):
        for b in slices(batches):
            g, cut = shingles(b.column("text"), size)
            n = len(cut) - 1
            has = np.flatnonzero(np.diff(cut))
            sig = np.zeros((n, COORDS), np.uint32)
            for i in range(COORDS):
                if len(has):
                    sig[has, i] = np.minimum.reduceat((g ^ _XOR[i]) * _MUL[i], cut[has]) >> np.uint64(32)
            sets = [np.unique(g[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.record_batch([
                b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                binary([xxhash.xxh3_128_digest(s.tobytes()) for s in sets]), binary([r.tobytes() for r in sig]),
            ], ["doc_id", "n", "digest", "sig"])
    return run


def _sets(size: int):
    def run(batches):
        for b in slices(batches):
            g, cut = shingles(b.column("text"), size)
            yield pa.record_batch([b.column("doc_id"), binary([np.unique(g[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)])],
                                  ["doc_id", "items"])
    return run


def _matrix(column) -> np.ndarray:
    buf, _ = buffer_of(column)
    return buf.view(np.uint32).reshape(-1, COORDS) if len(buf) else np.zeros((0, COORDS), np.uint32)


def _walk(sig, doc, node, levels: int, level: int, branch: float):
    """Children of the nodes after some levels, without (branch = 0) or with a second branch."""
    extra = np.uint64(int(branch * (1 << 32)))
    for depth in range(level, level + levels):
        lot = mix(node + np.array([depth + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if branch:
            more = (lot >> np.uint64(32)) < extra
            lot = np.r_[lot, mix(lot[more] + np.uint64(7))]
            doc, node = np.r_[doc, doc[more]], np.r_[node, node[more]]
        c = (lot % np.uint64(COORDS)).astype(np.int64)
        node = mix(node ^ mix(sig[doc, c].astype(np.uint64) | (c.astype(np.uint64) << np.uint64(32))))
    return doc, node


def _paths(trees: int, branch: float):
    def run(batches):
        for b in batches:
            sig = _matrix(b.column("sig"))
            ids = b.column("doc_id").to_numpy()
            for tree in range(trees):
                doc = np.arange(len(ids))
                doc, node = _walk(sig, doc, np.full(len(ids), mix(np.array([tree + 1], np.uint64))[0]), DEPTHS[0], 0, branch)
                yield pa.record_batch([pa.array(ids[doc]), pa.array(node.view(np.int64))], ["doc_id", "node"])
    return run


def _deeper(level: int, levels: int):
    def run(batches):
        for b in batches:
            sig = _matrix(b.column("sig"))
            node = b.column("node").to_numpy().view(np.uint64)
            _, node = _walk(sig, np.arange(len(node)), node, levels, level, 0.0)
            yield pa.record_batch([b.column("doc_id"), pa.array(node.view(np.int64))], ["doc_id", "node"])
    return run


def _compare(least: float):
    """Pairs of neighbours in rows sorted by node whose signatures agree often enough; a node has at
    most LEAF rows, so the rows carried from batch to batch are few."""
    def run(batches):
        kept = None
        for b in batches:
            ids, node, sig = b.column("doc_id").to_numpy(), b.column("node").to_numpy(), _matrix(b.column("sig"))
            if kept is not None:
                ids, node, sig = np.r_[kept[0], ids], np.r_[kept[1], node], np.concatenate([kept[2], sig])
            new = len(kept[0]) if kept is not None else 0
            left, right = [], []
            for k in range(1, min(LEAF, len(ids))):
                i = np.flatnonzero(node[k:] == node[:-k])
                i = i[i + k >= new]
                if not len(i):
                    break
                i = i[(sig[i] == sig[i + k]).sum(1) >= least * COORDS]
                left.append(ids[i])
                right.append(ids[i + k])
            if left:
                a, c = np.concatenate(left), np.concatenate(right)
                pairs = np.unique(np.stack([np.minimum(a, c), np.maximum(a, c)]), axis=1)
                yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
            tail = np.searchsorted(node, node[-1]) if len(node) else 0
            kept = (ids[tail:], node[tail:], sig[tail:])
    return run


def _confirm(percent: int):
    def run(batches):
        for b in batches:
            good = []
            for x, y in zip(b.column("items_a"), b.column("items_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _joined(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of links between components."""
    up: dict[int, int] = {}

    def root(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    kept = []
    for a, b in pairs.tolist():
        if (x := root(a)) != (y := root(b)):
            up[max(x, y)] = min(x, y)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def _block_links(comp: np.ndarray, side: np.ndarray, items: list[np.ndarray], percent: int) -> np.ndarray:
    """Links between components of one block (side 0 alone) or of two, over all their pairs."""
    n = np.array([len(x) for x in items])
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    values, at = np.concatenate(items), np.repeat(np.arange(len(items)), n)
    found, code, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1  # a shingle of one document alone is common to no pair
    code = np.where(shared, np.cumsum(shared) - 1, -1)[code]
    order = np.argsort(code, kind="stable")
    code, at = code[order], at[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(shared.sum()), COLUMNS):
        i, j = np.searchsorted(code, [lo, lo + COLUMNS])
        has = np.zeros((len(items), COLUMNS), np.float32)
        has[at[i:j], code[i:j] - lo] = 1
        both += has[left] @ has[right].T
    both = both.astype(np.int64)
    good = (100 * both >= percent * (n[left][:, None] + n[right] - both)) & (comp[left][:, None] != comp[right])
    a, b = np.nonzero(good)
    return _joined(np.unique(np.sort(np.stack([comp[left][a], comp[right][b]], axis=1), axis=1), axis=0))


def _blocks(percent: int):
    """Links of each pair of blocks, in rows sorted by pair."""
    def links(held):
        out = _block_links(np.array([x[1] for x in held]), np.array([x[2] for x in held]), [x[3] for x in held], percent)
        return pa.record_batch([pa.array(out[:, 0]), pa.array(out[:, 1])], ["u", "v"])

    def run(batches):
        held: list = []
        for b in batches:
            for pair, comp, side, items in zip(b.column("pair").to_pylist(), b.column("component").to_pylist(),
                                               b.column("side").to_pylist(), b.column("items"), strict=True):
                if held and held[0][0] != pair:
                    yield links(held)
                    held = []
                held.append((pair, comp, side, np.frombuffer(items.as_py(), np.uint64)))
        if held:
            yield links(held)
    return run


def _sized(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Rows (doc_id, node) of the nodes with two documents or more, with the node's size and the signature."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return write_table(rows.join(sizes, "node").join(reps.select("doc_id", "sig"), "doc_id"), "nodes")


def _candidates(reps: DataFrame, percent: int, trees: int) -> tuple[DataFrame, DataFrame | None]:
    """Distinct candidate pairs (a < b) of the representatives (doc_id, sig), and the rows of the
    nodes over LEAF at the first depth, if any, whose other pairs are left to ``_exhaustive``."""
    rows = _sized(reps.mapInArrow(_paths(trees, 100.0 / percent - 1.0), "doc_id long, node long"), reps)
    found = large = None
    for depth, deeper in zip(DEPTHS, (*DEPTHS[1:], None), strict=True):
        small = (rows.filter(F.col("size") <= LEAF).repartition("node").sortWithinPartitions("node", "doc_id")
                 .mapInArrow(_compare(percent / 100 - MARGIN), "a long, b long"))
        found = small if found is None else found.unionByName(small)
        big = rows.filter(F.col("size") > LEAF)
        if not big.limit(1).count():
            break
        large = big if large is None else large
        if deeper:
            rows = _sized(big.select("doc_id", "node", "sig").mapInArrow(_deeper(depth, deeper - depth), "doc_id long, node long"), reps)
        found = found.unionByName(_with_typical(big, rows))
    return found.distinct(), large


def _with_typical(big: DataFrame, deeper: DataFrame) -> DataFrame:
    """Each document of a large node with the node's PIVOTS most typical members: those that keep
    most company further down their paths, as the centre of a group of copies does."""
    company = deeper.groupBy("doc_id").agg(F.sum("size").alias("company"))
    lot = F.pmod(F.xxhash64("doc_id", F.lit("pivot")), F.lit(PIVOTS))
    rows = big.select("doc_id", "node").join(company, "doc_id", "left").withColumn("company", F.coalesce("company", F.lit(0)))
    pivots = (rows.groupBy("node", lot.alias("lot")).agg(F.max(F.struct("company", (-F.col("doc_id")).alias("minus"))).alias("best"))
              .groupBy("node").agg(F.collect_list(-F.col("best.minus")).alias("pivots")))  # PIVOTS at most
    # a document's nodes share most of their pivots: one row per node, then each pivot once
    own = (rows.join(pivots, "node").groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
           .select("doc_id", F.explode("pivots").alias("pivot")).filter("doc_id <> pivot"))
    return own.select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()


def _exhaustive(large: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components that meet in a large node, from all pairs of its documents. A
    component of BLOCK documents or more in a node has blocks of its own, which are not compared."""
    rows = write_table(
        large.select("doc_id", F.col("node").alias("of")).join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .join(sets.select("doc_id", F.octet_length("items").cast("long").alias("bytes")), "doc_id"), "members")
    groups = (rows.groupBy("of", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
              .withColumn("alone", F.col("n") >= BLOCK)
              .withColumn("own", F.when(F.col("alone"), F.col("component")).otherwise(F.lit(0))))
    dealt = groups.groupBy("of", "alone", "own").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"),
        F.min("component").alias("low"), F.max("component").alias("high"))
    rows = write_table(
        rows.drop("bytes").join(groups.select("of", "component", "alone", "own"), ["of", "component"])
        .join(dealt.select("of", "alone", "own", "blocks"), ["of", "alone", "own"])
        .select("doc_id", "component", F.struct("of", "alone", "own", F.pmod(F.xxhash64("doc_id", F.lit("block")), F.col("blocks"))
                                                .alias("block")).alias("block")), "blocks")
    blocks = (dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("of", "low", "high", F.struct("of", "alone", "own", "block").alias("block")))
    other = blocks.select("of", F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("block").alias("block_b"))
    pairs = write_table(blocks.join(other, "of").filter("block <= block_b and (low <> high_b or high <> low_b)")
                        .select(F.monotonically_increasing_id().alias("pair"), "block", "block_b"), "blocks")
    sides = (pairs.select("pair", F.lit(0).alias("side"), "block")
             .unionByName(pairs.filter("block <> block_b").select("pair", F.lit(1).alias("side"), F.col("block_b").alias("block"))))
    return (rows.join(sides, "block").join(sets, "doc_id").select("pair", "side", "component", "items")
            .repartition("pair").sortWithinPartitions("pair").mapInArrow(_blocks(percent), "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept."""
    rows, restored = keyed(docs, id_col, text_col)
    rows = rows.drop("own")
    base = write_table(rows.mapInArrow(_sign(size), "doc_id long, n long, digest binary, sig binary"), "sets")
    classes = base.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = write_table(classes, "classes")
    reps = classes.select(F.col("rep").alias("doc_id"), "sig")
    pairs, large = _candidates(reps, percent, trees)
    pairs = write_table(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = write_table(rows.join(wanted.hint("merge"), "doc_id", "left_semi")
                       .mapInArrow(_sets(size), "doc_id long, items binary"), "sets")
    links = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a")
             .join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")), "b")
             .mapInArrow(_confirm(percent), "a long, b long"))
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    if large is not None:  # every document of a large node was paired, so its set is at hand
        more = write_table(_exhaustive(large, sets, found, percent), "links")
        if more.limit(1).count():
            found = components(more.unionByName(found.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    of_class = classes.select("digest", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep", "doc_id")).otherwise(F.col("doc_id"))
    # texts without shingles share a digest, so they stay out of the join
    out = (base.filter("n > 0").select("doc_id", "n", "digest").join(of_class, "digest", "left")
           .select("doc_id", "n", component.alias("component"))
           .unionByName(base.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                     (F.col("component") == F.col("doc_id")).alias("kept"))
    return restored(out, "doc_id", "component_id").select("doc_id", "n_shingles", "component_id", "kept")
