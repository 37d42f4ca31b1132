"""Substring dedup over words by De Bruijn compaction.

A repeated span is made of windows of WINDOW words. The k-mers that are smallest
in some window (K words; every window holds one, and equal windows hold the same)
are the nodes of a De Bruijn graph; an edge joins two that follow each other in a
document and is named by the words from the first to the end of the second, a
document's begin and end being edges of their own. One aggregation finds, for each
node, the first document that holds it and whether it has one edge on either side;
a join brings that back to its occurrences. Nonbranching paths then compact: all
k-mers on such a path have the same occurrences, so every window inside it starts
first in the same document, and the path needs no further look. Only windows that
cross a branch are compared one by one, by the 128-bit hash of their words; the
coordinates of all that repeat (document, first word) give the spans to remove.

Defined cases: null or empty text has no words; a text shorter than a window loses
nothing; every row is a document of its own: rows without a doc_id, and all but the
first of rows that share one, count as larger than any doc_id; a window that repeats
only inside one document stays; very long texts are one row of their own slice, with
some 60 bytes a word; other columns, whatever their names, are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import (NON_SPACE, binary, buffer_of, covered, keyed, mix, range_hashes, runs, slices,
                                 span_hashes, triggers, words, write_table)

WINDOW = 50
K = 15
_BEGIN, _END = np.uint64(0xB5), np.uint64(0xE7)


def _nodes(column, window: int, k: int):
    """Word hashes, first words, window validity, smallest node of each window, node positions, hashes and edges."""
    buf, off = buffer_of(column)
    starts, ends, first = words(buf, off, NON_SPACE)
    h = span_hashes(buf, starts, ends)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    valid = doc[: max(0, len(h) - window + 1)] == doc[window - 1:] if len(h) >= window else np.zeros(0, bool)
    if not valid.any():
        none = np.zeros(0, np.uint64)
        return h, first, valid, none, np.zeros(0, np.int64), none, none, none
    grams = runs(h, k)
    at, least = triggers(grams, window - k + 1, valid)
    at = at[doc[at] == doc[np.minimum(at + k - 1, len(doc) - 1)]]
    begin, end = first[doc[at]], first[doc[at] + 1]
    same = doc[at[1:]] == doc[at[:-1]]
    left = np.where(np.r_[False, same], np.r_[0, at[:-1]], begin)
    right = np.where(np.r_[same, False], np.r_[at[1:], 0] + k, end)
    before = range_hashes(h, left, at + k) ^ np.where(np.r_[False, same], np.uint64(0), _BEGIN)
    after = range_hashes(h, at, right) ^ np.where(np.r_[same, False], np.uint64(0), _END)
    return h, first, valid, least, at, grams[at], before, after


def _occurrences(window: int, k: int):
    def run(batches):
        for b in slices(batches):
            _, first, _, _, at, node, before, after = _nodes(b.column("text"), window, k)
            doc = np.searchsorted(first, at, "right") - 1
            yield pa.record_batch([
                pa.array(node.view(np.int64)), pa.array(b.column("doc_id").to_numpy(zero_copy_only=False)[doc]),
                pa.array((at - first[doc]).astype(np.int32)), pa.array(before.view(np.int64)), pa.array(after.view(np.int64)),
            ], ["node", "doc_id", "pos", "before", "after"])
    return run


def _paths(window: int, k: int):
    """Spans of compacted paths that start earlier elsewhere, and the windows that cross branches."""
    def run(batches):
        for b in slices(batches):
            h, first, valid, least, at, node, _, _ = _nodes(b.column("text"), window, k)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            repeated, one_before, one_after = (np.zeros(len(h) + 1, bool) for _ in range(3))
            source = np.zeros(len(h) + 1, np.int64)
            marks = b.column("marks")
            values, offsets = marks.flatten(), np.r_[0, np.cumsum([len(x) for x in marks])]
            pos = values.field("pos").to_numpy(zero_copy_only=False)
            where = pos + np.repeat(first[:-1], np.diff(offsets))
            repeated[where] = True
            one_before[where] = values.field("one_before").to_numpy(zero_copy_only=False)
            one_after[where] = values.field("one_after").to_numpy(zero_copy_only=False)
            source[where] = values.field("source").to_numpy(zero_copy_only=False)
            doc = np.searchsorted(first, at, "right") - 1
            spans = [np.zeros((3, 0), np.int64)]
            inside = np.zeros(len(h) + 1, bool)
            if len(at):
                joined = np.r_[False, (doc[1:] == doc[:-1]) & repeated[at[1:]] & repeated[at[:-1]] & one_after[at[:-1]] & one_before[at[1:]]]
                head = np.flatnonzero(~joined)
                tail = np.r_[head[1:] - 1, len(at) - 1]
                use = repeated[at[head]]
                head, tail = head[use], tail[use]
                is_first = np.r_[True, doc[1:] != doc[:-1]]
                is_last = np.r_[doc[1:] != doc[:-1], True]
                begin = np.where(is_first[head] & one_before[at[head]], first[doc[head]], at[head])
                end = np.where(is_last[tail] & one_after[at[tail]], first[doc[tail] + 1], at[tail] + k)
                long = end - begin >= window
                begin, end, head = begin[long], end[long], head[long]
                inside[:-1] = covered(len(h), begin, end - window + 1)
                gone = source[at[head]] < ids[doc[head]]
                base = first[doc[head]][gone]
                spans.append(np.stack([doc[head][gone], begin[gone] - base, end[gone] - base]))
            # a window can repeat only if its own smallest k-mer does
            s = np.flatnonzero(valid & ~inside[: len(valid)])
            s = s[np.isin(least[s], node[repeated[at]])]
            one, two = (runs(x, window)[s] if len(s) else np.zeros(0, np.uint64) for x in (h, mix(h ^ np.uint64(0x5DEECE66D))))
            owner = np.searchsorted(first, s, "right") - 1
            p = np.concatenate(spans, axis=1)
            n, m = p.shape[1], len(s)
            yield pa.record_batch([
                pa.array(np.r_[ids[p[0]], ids[owner]].astype(np.int64)), pa.array(np.r_[p[1], s - first[owner]].astype(np.int32)),
                pa.array(np.r_[p[2], s - first[owner] + window].astype(np.int32)),
                pa.array(np.r_[np.zeros(n, np.int64), one.view(np.int64)], mask=np.r_[np.ones(n, bool), np.zeros(m, bool)]),
                pa.array(np.r_[np.zeros(n, np.int64), two.view(np.int64)]),
            ], ["doc_id", "start", "end", "one", "two"])
    return run


def _cut(batches):
    for b in slices(batches):
        buf, off = buffer_of(b.column("text"))
        starts, ends, first = words(buf, off, NON_SPACE)
        raw = buf.tobytes()
        n, removed, kept = np.diff(first), [], []
        for d, spans in enumerate(b.column("spans").to_pylist()):
            lo, hi = int(first[d]), int(first[d + 1])
            if spans:
                gone = covered(hi - lo, np.array([x["start"] for x in spans]), np.array([x["end"] for x in spans]))
                keep = np.flatnonzero(~gone) + lo
                removed.append(int(gone.sum()))
            else:
                keep = range(lo, hi)
                removed.append(0)
            kept.append(b" ".join([raw[starts[i]:ends[i]] for i in keep]) if spans else b" ".join(raw[off[d]:off[d + 1]].split()))
        yield pa.record_batch([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), binary(kept).cast(pa.string())],
                              ["doc_id", "n_words", "n_removed", "text"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the kept words joined by one space."""
    rows, restored = keyed(docs, id_col, text_col)
    rows = rows.drop("own")
    found = rows.mapInArrow(_occurrences(window, k), "node long, doc_id long, pos int, before long, after long")
    # written, so that the join below is between plain shuffles, whose hot keys adaptive execution divides
    nodes = write_table(found.groupBy("node").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min("before").alias("b0"), F.max("before").alias("b1"),
        F.min("after").alias("a0"), F.max("after").alias("a1")).filter("source < last")
        .select("node", "source", F.expr("b0 = b1").alias("one_before"), F.expr("a0 = a1").alias("one_after")), "nodes")
    marks = (found.select("node", "doc_id", "pos").join(nodes, "node")
             .groupBy("doc_id").agg(F.collect_set(F.struct("pos", "source", "one_before", "one_after")).alias("marks")))
    spans = write_table(rows.join(marks.hint("merge"), "doc_id")
                        .mapInArrow(_paths(window, k), "doc_id long, start int, end int, one long, two long"), "spans")
    crossing = spans.filter("one is not null")
    sources = (crossing.groupBy("one", "two").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
               .filter("source < last").drop("last"))
    gone = (crossing.join(sources, ["one", "two"]).filter("source < doc_id").select("doc_id", "start", "end")
            .unionByName(spans.filter("one is null").select("doc_id", "start", "end"))
            .groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    out = (rows.join(gone, "doc_id", "left").select("doc_id", "text", "spans")
           .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, text string"))
    return restored(out, "doc_id").select("doc_id", "n_words", "n_removed", "text")
