"""Benchmark decontamination: a broadcast hash set of the benchmark's n-grams.

Items become windows of n normalised words (an item with fewer words is one
window). Tasks hash every window of the documents, look it up in the broadcast
set and compare the words of each hit with the benchmark's, so a hash collision
removes nothing. The broadcast is bounded: items are dealt into slices of about
SLICE_LIMIT bytes of text, kept as flat arrays of some ten times that, and each slice
is broadcast, scanned and released in turn, so a benchmark of any size costs more
scans, not more memory.

Defined cases: null or empty text has no words and no hits; an item without words
matches nothing; items with equal texts are all reported; a null item_id is left
out of the item list, but its words count as hit; a null doc_id stays null; rows
are judged one by one, repeated ones too; other columns are ignored; an empty
table, or an empty benchmark, gives zero hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import ALNUM, LOWER, buffer_of, covered, filter_rows, narrow, owner, public_id, runs, slices, span_hashes, words, write_table

WINDOW = 10
SLICE_LIMIT = 2 << 20   # bytes of items' text in one index, which takes some ten times as much


def _words_of(buf, off):
    low = LOWER[buf]
    starts, ends, first = words(low, off, ALNUM)
    return low, starts, ends, first


class Windows:
    """The windows of some items as flat arrays: the items' lower-cased text with the places of its words, and per window
    length the sorted hashes, a place (first word) of each distinct window, and the items that hold it, cut by ``first``."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        self.low, self.starts, self.ends, first = _words_of(*buffer_of(pa.array([text for _, text in items], pa.string())))
        item, count = owner(first, len(self.starts)), np.diff(first)
        h, self.by_length = span_hashes(self.low, self.starts, self.ends), {}
        for n in np.unique(np.minimum(count[count > 0], window)):
            grams = runs(h, int(n))
            at = np.flatnonzero(item[: len(grams)] == item[int(n) - 1: int(n) - 1 + len(grams)])
            at = at[np.minimum(count[item[at]], window) == n]
            order = at[np.lexsort((at, grams[at]))]
            # windows of one hash follow each other; the distinct ones among them are told apart by their words
            heads, group = np.unique(grams[order], return_index=True)[1], np.zeros(len(order), np.int64)
            group[heads] = 1
            group = np.cumsum(group) - 1
            several = np.flatnonzero(group[1:] == group[:-1]) + 1
            odd = several[~self._equal(order[several], order[heads[group[several]]], int(n))]
            if len(odd):  # two windows of one hash: never seen, so plainly
                texts = [self.text(a, int(n)) for a in order]
                order = order[sorted(range(len(order)), key=lambda k: (int(grams[order[k]]), texts[k], int(order[k])))]
                texts = [self.text(a, int(n)) for a in order]
                change = np.array([k == 0 or grams[order[k]] != grams[order[k - 1]] or texts[k] != texts[k - 1] for k in range(len(order))])
                heads, group = np.flatnonzero(change), np.cumsum(change) - 1
            held = np.unique(group * len(items) + item[order])
            self.by_length[int(n)] = (grams[order[heads]], order[heads], np.searchsorted(held // max(len(items), 1), np.arange(len(heads) + 1)),
                                      held % max(len(items), 1))

    def text(self, at: int, n: int) -> bytes:
        return b" ".join(self.low[self.starts[j]:self.ends[j]].tobytes() for j in range(at, at + n))

    def _equal(self, a, b, n):
        return np.array([self.text(x, n) == self.text(y, n) for x, y in zip(a, b, strict=True)], bool)


def _hits(index: Windows, low, starts, ends, first):
    """(document, first word, length, item numbers) of each verified window occurrence."""
    h, of = span_hashes(low, starts, ends), owner(first, len(starts))
    for n, (hashes, places, cut, held) in index.by_length.items():
        grams = runs(h, n)
        if not len(grams):
            continue
        marks = np.zeros(1 << 20, bool)
        marks[(hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(marks[(grams & np.uint64(0xFFFFF)).astype(np.int64)])
        at = at[of[at] == of[at + n - 1]]
        lo, hi = np.searchsorted(hashes, grams[at], "left"), np.searchsorted(hashes, grams[at], "right")
        for k in np.flatnonzero(lo < hi):
            i = int(at[k])
            text = b" ".join(low[starts[j]:ends[j]].tobytes() for j in range(i, i + n))
            for w in range(lo[k], hi[k]):
                if index.text(int(places[w]), n) == text:
                    yield int(of[i]), i, n, held[cut[w]:cut[w + 1]]
                    break


def _scan(index):
    def run(batches):
        for b in slices(batches):
            low, starts, ends, first = _words_of(*buffer_of(b.column("text")))
            docs = b.num_rows
            hit_at: list[list[int]] = [[] for _ in range(docs)]
            hit_len: list[list[int]] = [[] for _ in range(docs)]
            items: list[set] = [set() for _ in range(docs)]
            for d, i, n, held in _hits(index.value, low, starts, ends, first):
                hit_at[d].append(i)
                hit_len[d].append(n)
                items[d].update(index.value.names[x] for x in held)
            spans, n_hit = [], []
            for d in range(docs):
                if not hit_at[d]:
                    spans.append([])
                    n_hit.append(0)
                    continue
                at = np.array(hit_at[d])
                mask = covered(int(first[d + 1] - first[d]), at - first[d], at + np.array(hit_len[d]) - first[d])
                edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0])).reshape(-1, 2)
                spans.append([{"start": int(s), "end": int(e)} for s, e in edges])
                n_hit.append(int(mask.sum()))
            # with several slices of the benchmark, "row" tells rows apart that share an id or have none
            own = [name for name in ("row",) if name in b.schema.names]
            yield pa.record_batch([
                b.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([sorted(x for x in s if x is not None) for s in items], pa.list_(pa.string())),
                *(b.column(name) for name in own),
            ], ["doc_id", "n_words", "n_hit", "spans", "items", *own])
    return run


SCHEMA = "doc_id long, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"


def _union(batches):
    """Spans of several slices of the benchmark, merged per document."""
    for b in batches:
        out, n_hit = [], []
        for n, spans in zip(b.column("n_words").to_pylist(), b.column("spans").to_pylist(), strict=True):
            s = np.array([x["start"] for x in spans], np.int64)
            e = np.array([x["end"] for x in spans], np.int64)
            mask = covered(n, s, e)
            edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0])).reshape(-1, 2)
            out.append([{"start": int(x), "end": int(y)} for x, y in edges])
            n_hit.append(int(mask.sum()))
        yield pa.record_batch([b.column("doc_id"), b.column("n_words"), pa.array(n_hit, pa.int64()),
                               pa.array(out, b.schema.field("spans").type), b.column("items")], b.schema.names)


def _indexes(benchmark: DataFrame, window: int, slice_limit: int):
    """Broadcast windows of the benchmark, one after another, each from about ``slice_limit`` bytes of items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_slices = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // slice_limit))
    if n_slices > 1:  # dealt by row, so that equal texts are spread
        items = write_table(items.withColumn("row", F.monotonically_increasing_id()), "items")
    for k in range(n_slices):
        own = items.filter(F.pmod(F.xxhash64("row"), F.lit(n_slices)) == k) if n_slices > 1 else items
        yield benchmark.sparkSession.sparkContext.broadcast(
            Windows([(r["item_id"], r["text"]) for r in own.toLocalIterator()], window)), k + 1 == n_slices


def drop_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   window: int = WINDOW, slice_limit: int = SLICE_LIMIT) -> DataFrame:
    """The rows, with all their columns, in which no window of the benchmark occurs. Of several slices each but the
    last is worked off at once, and its index released."""
    for index, last in _indexes(benchmark, window, slice_limit):
        def clean(texts, index=index):
            found = np.ones(len(texts), bool)
            for d, _, _, _ in _hits(index.value, *_words_of(*buffer_of(texts))):
                found[d] = False
            return found
        docs = filter_rows(docs, clean, text_col)
        if not last:
            docs = write_table(docs, "rows")
            index.unpersist()
    return docs


def scan_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, slice_limit: int = SLICE_LIMIT) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans of hit words [start, end), and the items found (sorted)."""
    rows, parts = narrow(docs, id_col, text_col), []
    for index, last in _indexes(benchmark, window, slice_limit):
        if last and not parts:
            return rows.mapInArrow(_scan(index), SCHEMA).select(public_id(), "n_words", "n_hit", "spans", "items")
        if not parts:
            rows = write_table(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
        parts.append(write_table(rows.mapInArrow(_scan(index), SCHEMA + ", row long"), "hits"))
        index.unpersist()
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return (merged.groupBy("row", "doc_id", "n_words").agg(
        F.sum("n_hit").alias("n_hit"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .drop("row").mapInArrow(_union, SCHEMA).select(public_id(), "n_words", "n_hit", "spans", "items"))


def remove_spans(text: str | None, spans) -> str:
    """The text without the words of the spans (word positions), and the separators between them."""
    low, starts, ends, _ = _words_of(*buffer_of(pa.array([text or ""], pa.string())))
    raw, out, at = (text or "").encode(), [], 0
    for s, e in spans:
        out.append(raw[at:starts[s]])
        at = int(ends[e - 1])
    return b"".join([*out, raw[at:]]).decode()


def items_digest(items):
    return F.sha2(F.concat_ws(",", items), 256)
