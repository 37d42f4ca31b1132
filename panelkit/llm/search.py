"""Ranked lexical search, reversed: the queries are the index, the documents stream by.

The items' terms become an inverted index (term -> items and repeats) with the terms'
weights, broadcast to the tasks. A task reads its documents once, counts each text's
terms that the index knows, adds what they give to the items that hold them, and keeps a
heap of the ``limit`` best documents per item; the heaps of all tasks are merged at the
end, in two steps. Documents and their postings are never shuffled.

A first pass over all documents gives N, L and the terms' document frequencies. The
index is bounded: items are dealt into slices of about SLICE_LIMIT bytes of text, each
slice takes two passes of its own, so more items cost more passes, not more memory.

Memory of a task: a slice of texts, at most SCORES scores at a time, and one heap an item.

Defined cases: a null or empty text has no terms and is not counted in N; an item without
terms, or whose terms stand in no document, returns no row; items with equal texts, or
with no or the same item_id, are ranked one by one; a null doc_id is ranked after all
others of its score and stays null; every row is ranked, repeated ones too; very long texts
are counted whole; other columns, whatever their names, are ignored; an empty table, or
no items, gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from panelkit.llm.common import ALNUM, LOWER, NULL_ID, buffer_of, narrow, owner, public_id, slices, words, write_table

LIMIT = 10
SLICE_LIMIT = 1 << 20    # bytes of items' text in one index
SCORES = 1 << 21         # scores (documents x items) and postings held at once
MERGED = 64              # tasks whose heaps are merged in the first step


def _terms(column) -> tuple[pa.Array, np.ndarray]:
    """The terms of some texts, lower-cased, and the index of each text's first (n + 1 values)."""
    buf, off = buffer_of(column)
    low = LOWER[buf]
    starts, ends, first = words(low, off, ALNUM)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    data = np.ascontiguousarray(low[ALNUM[low]])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), first


class Index:
    """Inverted index of some items: ``terms`` (distinct, an Arrow array), and for each term its items
    with the term's repeats there, as flat arrays cut by ``first``."""

    def __init__(self, texts: list[str | None]):
        found, first = _terms(pa.array(texts, pa.string()))
        coded = found.dictionary_encode()
        self.items = len(texts)
        self.terms = coded.dictionary
        item = owner(first, len(found))
        key, repeats = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(self.items, 1) + item, return_counts=True)
        self.item, self.repeats = key % max(self.items, 1), repeats.astype(np.int64)
        self.first = np.searchsorted(key // max(self.items, 1), np.arange(len(self.terms) + 1))
        self.weights = np.zeros(len(self.terms), np.int64)

    def counts(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents' lengths, and (document, term, occurrences) of the index's terms in them."""
        found, first = _terms(column)
        at = pc.index_in(found, value_set=self.terms)
        known = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
        term = at.take(pa.array(known)).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = owner(first, len(found))[known]
        key, tf = np.unique(doc * max(len(self.terms), 1) + term, return_counts=True)
        return np.diff(first), key // max(len(self.terms), 1), key % max(len(self.terms), 1), tf.astype(np.int64)


# --- statistics -------------------------------------------------------------

N_ROW, L_ROW = -1, -2


def _frequencies(index):
    """Per task: documents with each term of the index, and, as terms N_ROW and L_ROW, documents and terms in all."""
    def run(batches):
        own, n, total = index.value, 0, 0
        df = np.zeros(len(own.terms), np.int64)
        for b in slices(batches):
            length, _, term, _ = own.counts(b.column("text"))
            df += np.bincount(term, minlength=len(df))
            n += int((length > 0).sum())
            total += int(length.sum())
        seen = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.r_[seen, N_ROW, L_ROW]), pa.array(np.r_[df[seen], n, total])], ["term", "n"])
    return run


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


# --- scores -----------------------------------------------------------------

def _contributions(index: Index, documents: int, total: int, length, doc, term, tf):
    """What each (document, term) adds per occurrence of the term in an item."""
    norm = 100 - 75 + (75 * length * documents) // max(total, 1)
    return index.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[doc]))


def _best(item, score, ids, limit):
    """The ``limit`` first per item by falling score, then rising id."""
    order = np.lexsort((ids, -score, item))
    item, score, ids = item[order], score[order], ids[order]
    start = np.searchsorted(item, item, "left")
    kept = np.arange(len(item)) - start < limit
    return item[kept], score[kept], ids[kept]


def _chunks(index: Index, doc, term, docs: int):
    """(first document, documents, rows of the counts) of runs with at most SCORES scores and postings."""
    postings = np.r_[0, np.cumsum((index.first[1:] - index.first[:-1])[term])]
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    most, lo = max(1, SCORES // max(index.items, 1)), 0
    while lo < docs:
        hi = min(docs, lo + most)
        room = int(np.searchsorted(postings[bounds], postings[bounds[lo]] + SCORES, "right")) - 1
        hi = max(lo + 1, min(hi, room))
        yield lo, hi - lo, slice(bounds[lo], bounds[hi])
        lo = hi


def _scan(index, documents: int, total: int, limit: int):
    def run(batches):
        own = index.value
        item, score, ids = (np.zeros(0, np.int64) for _ in range(3))
        floor = np.zeros(own.items, np.int64)   # a document must score above it, or as much, to enter a full heap
        for b in slices(batches):
            length, doc, term, tf = own.counts(b.column("text"))
            gain = _contributions(own, documents, total, length, doc, term, tf)
            doc_ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, n, rows in _chunks(own, doc, term, b.num_rows):
                size = own.first[term[rows] + 1] - own.first[term[rows]]
                start = np.cumsum(size) - size
                at = np.arange(int(size.sum())) - np.repeat(start - own.first[term[rows]], size)
                cell = np.repeat(doc[rows] - lo, size) * own.items + own.item[at]
                # sums of whole numbers below 2**53: exact in doubles
                sums = np.bincount(cell, np.repeat(gain[rows], size) * own.repeats[at], n * own.items).astype(np.int64).reshape(n, own.items)
                d, i = np.nonzero((sums > 0) & (sums >= floor))
                item, score, ids = _best(np.r_[item, i], np.r_[score, sums[d, i]], np.r_[ids, doc_ids[lo + d]], limit)
                full = np.bincount(item, minlength=own.items) == limit
                last = np.searchsorted(item, np.arange(own.items), "right") - 1
                floor = np.where(full, score[last] if len(score) else 0, 0)
        task = TaskContext.get()
        yield pa.record_batch([pa.array(item), pa.array(score), pa.array(ids),
                               pa.array(np.full(len(item), task.partitionId() // MERGED if task else 0, np.int64))],
                              ["item", "score", "doc_id", "part"])
    return run


def _merged(heaps: DataFrame, limit: int) -> DataFrame:
    order = [F.desc("score"), F.asc("doc_id")]
    first = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= limit)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= limit)


def _slices(items: DataFrame, slice_limit: int):
    """Items (item_id, text) in lists of about ``slice_limit`` bytes of text."""
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // slice_limit))
    if n > 1:  # dealt by row, so that equal texts are spread
        items = write_table(items.withColumn("row", F.monotonically_increasing_id()), "items")
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("row"), F.lit(n)) == k) if n > 1 else items
        yield [(r["item_id"], r["text"]) for r in own.toLocalIterator()]


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", slice_limit: int = SLICE_LIMIT) -> DataFrame:
    """Each item's ``limit`` best documents with a score above 0: item_id, rank, doc_id, score."""
    spark, kind = docs.sparkSession, items.schema[item_col].dataType
    rows = narrow(docs, id_col, text_col)
    queries = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    named = StructType([StructField("item", LongType()), StructField("item_id", kind)])
    out = spark.createDataFrame([], StructType([StructField("item_id", kind), StructField("rank", IntegerType()),
                                                StructField("doc_id", LongType()), StructField("score", LongType())]))
    for part in _slices(queries, slice_limit):
        index = Index([text for _, text in part])
        if not len(index.terms):
            continue
        known = spark.sparkContext.broadcast(index)
        counts = rows.mapInArrow(_frequencies(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        df = {r["term"]: r["n"] for r in counts.collect()}  # at most the terms of one slice of items
        known.unpersist()
        n, total = df.pop(N_ROW, 0), df.pop(L_ROW, 0)
        index.weights = np.array([weight(n, df.get(t, 0)) for t in range(len(index.terms))], np.int64)
        heaps = rows.mapInArrow(_scan(spark.sparkContext.broadcast(index), n, total, limit), "item long, score long, doc_id long, part long")
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(part)], named)  # one slice of items
        ranked = _merged(heaps, limit).join(F.broadcast(names), "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), public_id("doc_id"), "score")
        out = out.unionByName(ranked)
    return out
