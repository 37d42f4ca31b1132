"""Repeated byte strings by prefix-free parsing and suffix sorting.

The text is parsed at rolling-hash triggers: the smallest GRAM-byte hash of every
window of WINDOW bytes is a trigger, so equal windows have equal triggers whatever
surrounds them. A phrase is a maximal run of windows of one document under one
trigger, and overlaps the next phrase by WINDOW - 1 bytes, so every window lies in
exactly one phrase. Work goes in three passes over the corpus, stored once as
compressed blocks of about BLOCK_BYTES:

1. Blocks send their distinct trigger hashes (48 bits each), dealt out by hash, and
   learn as a bit per hash which ones another block has too. A window whose trigger
   is nowhere else cannot repeat and takes no further part.
2. Blocks send the distinct phrases of the remaining windows with the smallest
   doc_id of the block that holds them (the parse), dealt out by trigger. A task
   forms the dictionary of distinct phrases, sorts all its suffixes to a depth of
   WINDOW bytes (their suffix array), and merges equal neighbours with the parse to
   the first document of every window; it answers with a bit per window of each
   phrase: does the window start in a smaller document than the block's?
3. Blocks turn the bits into spans. Within a block, later holders of a phrase lose
   all of it.

Equality is decided on bytes; hashes only choose what is compared. A phrase is sent
once per block, however many documents hold it, so a passage in a third of all
documents is a few rows per block.

Defined cases: null or empty text has no bytes; a text shorter than a window loses
nothing; a string that repeats only inside one document stays; a null doc_id is
kept and counts as larger than any other; rows repeating a doc_id are one document
for the comparison, and each row is returned; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import (binary, buffer_of, covered, gram_hashes, mix, narrow, public_id, slices, text_bytes, triggers,
                                 write_table)

WINDOW = 50
GRAM = 20
BLOCK_BYTES = 1 << 20
SHARD_BYTES = 8 << 20    # text per group of a dealing, so that a group's memory is bounded
HASH_BYTES = 6


def _blocks(batches):
    task = TaskContext.get().partitionId()
    for i, b in enumerate(slices(batches, limit=BLOCK_BYTES)):
        buf, off = buffer_of(b.column("text"))
        yield pa.record_batch([
            pa.array([(task << 32) | i], pa.int64()), binary([b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64).tobytes()]),
            binary([off.tobytes()]), binary([pa.compress(buf.tobytes(), "zstd", asbytes=True)]),
        ], ["block", "ids", "off", "text"])


class _Block:
    """A block's bytes, windows and triggers."""

    def __init__(self, row: dict, window: int, gram: int):
        self.id, self.ids = row["block"], np.frombuffer(row["ids"], np.int64)
        self.off = np.frombuffer(row["off"], np.int64)
        size = int(self.off[-1])
        self.buf = np.frombuffer(pa.decompress(row["text"], size, "zstd"), np.uint8) if size else np.zeros(0, np.uint8)
        self.window = window
        n = max(0, size - window + 1)
        room = np.repeat(self.off[1:], np.diff(self.off))[:n]  # where the document of each position ends
        self.valid = np.arange(n) + window <= room
        if self.valid.any():
            grams = gram_hashes(self.buf, gram)
            at, least = triggers(grams, window - gram + 1, self.valid)
            self.doc = np.searchsorted(self.off, at, "right") - 1
            # smallest hashes crowd at zero: mixed again (one to one), they deal out evenly
            self.least = mix(least)
            self.hashes, inverse = np.unique(mix(grams[at]), return_inverse=True)
            low, high = np.full(len(self.hashes), np.iinfo(np.int64).max), np.full(len(self.hashes), np.iinfo(np.int64).min)
            np.minimum.at(low, inverse, self.ids[self.doc])
            np.maximum.at(high, inverse, self.ids[self.doc])
            self.shared = low < high   # in two documents of this block already
        else:
            self.least, self.hashes, self.shared = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)

    def shards(self, hashes: np.ndarray, bits: int) -> np.ndarray:
        return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)

    def phrases(self, repeated: np.ndarray):
        """First and one-past-last window start of each phrase, and its trigger."""
        at = np.searchsorted(self.hashes, self.least)
        at[at == len(self.hashes)] = 0
        ok = self.valid & repeated[at] & (self.hashes[at] == self.least) if len(self.hashes) else self.valid & False
        new = ok.copy()
        if len(ok):
            new[1:] &= ~ok[:-1] | (self.least[1:] != self.least[:-1])
            new[self.off[:-1][self.off[:-1] < len(ok)]] = ok[self.off[:-1][self.off[:-1] < len(ok)]]
        begin = np.flatnonzero(new)
        stop = np.flatnonzero(ok & ~np.r_[ok[1:] & ~new[1:], False]) + 1 if len(ok) else begin
        return begin, stop, self.least[begin]

    def distinct(self, repeated: np.ndarray):
        """The block's phrases in the order of their triggers: bytes, smallest document, and for every
        occurrence the phrase, its first window and its document."""
        begin, stop, trigger = self.phrases(repeated)
        order = np.argsort(trigger, kind="stable")
        begin, stop, trigger = begin[order], stop[order], trigger[order]
        ids = self.ids[np.searchsorted(self.off, begin, "right") - 1]
        raw, known = self.buf.tobytes(), {}
        phrase = np.fromiter((known.setdefault(raw[i:j], len(known)) for i, j in zip(begin.tolist(), (stop + self.window - 1).tolist(), strict=True)),
                             np.int64, len(begin))
        least = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(least, phrase, ids)
        head = np.zeros(len(known), np.uint64)
        head[phrase] = trigger
        return list(known), least, head, phrase, begin, ids


def _repeated(block: _Block, answers, bits: int) -> np.ndarray:
    """Which of the block's trigger hashes stand in another document."""
    out = block.shared.copy()
    shard = block.shards(block.hashes, bits)
    for a in answers or ():
        lo, hi = np.searchsorted(shard, [a["shard"], a["shard"] + 1])   # hashes are in order, so are shards
        out[lo:hi] |= np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).view(bool)
    return out


def _send_triggers(window: int, gram: int, bits: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row, window, gram)
                shard = block.shards(block.hashes, bits)
                names, cuts = np.unique(shard, return_index=True)
                parts = np.split(block.hashes, cuts[1:])
                # the top 48 bits, most significant bytes first
                blobs = [np.ascontiguousarray(p.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].T).tobytes() for p in parts] if len(names) else []
                yield pa.record_batch([pa.array(names, pa.int32()), pa.array([block.id] * len(names), pa.int64()), binary(blobs)],
                                      ["shard", "block", "hashes"])
    return run


def _match_triggers(rows: pd.DataFrame) -> pd.DataFrame:
    lists = []
    for blob in rows["hashes"]:
        x = np.zeros((len(blob) // HASH_BYTES, 8), np.uint8)
        x[:, :HASH_BYTES] = np.frombuffer(blob, np.uint8).reshape(HASH_BYTES, -1).T
        lists.append(x.view(">u8").ravel().astype(np.uint64))
    _, inverse, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    found = np.split(count[inverse] > 1, np.cumsum([len(x) for x in lists])[:-1])
    return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], "bits": [np.packbits(f).tobytes() for f in found]})


def _send_phrases(window: int, gram: int, bits: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row, window, gram)
                names, least, head, _, _, _ = block.distinct(_repeated(block, row["triggers"], bits))
                shard = block.shards(head, bits)
                where, cuts = np.unique(shard, return_index=True)
                ends = [*cuts[1:], len(names)]
                size = np.array([len(x) for x in names], np.int32)
                yield pa.record_batch([
                    pa.array(where, pa.int32()), pa.array([block.id] * len(where), pa.int64()),
                    binary([pa.compress(b"".join(names[i:j]), "zstd", asbytes=True) for i, j in zip(cuts, ends, strict=True)]),
                    binary([size[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)]),
                    binary([least[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)]),
                ], ["shard", "block", "phrases", "sizes", "docs"])
    return run


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), begin[1], ..."""
    return np.repeat(begin - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(int(count.sum()))


def _sort_windows(window: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        dictionary: dict[bytes, int] = {}
        parse, docs = [], []
        for blob, sizes, least in zip(rows["phrases"], rows["sizes"], rows["docs"], strict=True):
            sizes = np.frombuffer(sizes, np.int32)
            raw = pa.decompress(blob, int(sizes.sum()), "zstd").to_pybytes()
            ends = np.cumsum(sizes).tolist()
            parse.append(np.fromiter((dictionary.setdefault(raw[i:j], len(dictionary)) for i, j in zip([0, *ends[:-1]], ends, strict=True)),
                                     np.int64, len(sizes)))
            docs.append(np.frombuffer(least, np.int64))
        first = np.full(len(dictionary), np.iinfo(np.int64).max)
        np.minimum.at(first, np.concatenate(parse), np.concatenate(docs))
        size = np.array([len(x) for x in dictionary], np.int64)
        text = np.frombuffer(b"".join(dictionary), np.uint8)
        count = size - window + 1
        owner = np.repeat(np.arange(len(size)), count)
        at = _spread(np.cumsum(size) - size, count)
        suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, window)[at])
        suffixes = suffixes.view(f"S{window}").ravel()   # all of one length, so zero bytes at the end count too
        order = np.argsort(suffixes)   # the suffix array, to the depth of a window
        suffixes = suffixes[order]
        new = np.r_[True, suffixes[1:] != suffixes[:-1]]
        del suffixes
        least = np.minimum.reduceat(first[owner[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
        source = np.empty(len(at), np.int64)
        source[order] = least
        begin = np.cumsum(count) - count
        answers = []
        for phrase, own in zip(parse, docs, strict=True):
            n = count[phrase]
            answers.append(np.packbits(source[_spread(begin[phrase], n)] < np.repeat(own, n)).tobytes())
        return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], "bits": answers})
    return run


def _remove(window: int, gram: int, bits: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row, window, gram)
                names, least, head, phrase, begin, ids = block.distinct(_repeated(block, row["triggers"], bits))
                count = np.array([len(x) for x in names], np.int64) - window + 1
                elsewhere = np.zeros(int(count.sum()), bool)
                shard, at = block.shards(head, bits), np.cumsum(count) - count
                for a in row["windows"] or ():
                    lo, hi = np.searchsorted(shard, [a["shard"], a["shard"] + 1])   # phrases are in order of trigger
                    where = _spread(at[lo:hi], count[lo:hi])
                    elsewhere[where] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=len(where)).view(bool)
                n = count[phrase]
                start = _spread(begin, n)
                gone = elsewhere[_spread(at[phrase], n)] | np.repeat(ids > least[phrase], n)
                start = start[gone]
                mask = covered(len(block.buf), start, start + window)
                off = block.off
                edge = np.flatnonzero(np.diff(np.r_[False, mask].astype(np.int8)) == 1)
                cut = np.union1d(edge, off[:-1][(off[:-1] < len(mask)) & mask[np.minimum(off[:-1], max(0, len(mask) - 1))]]) if len(mask) else edge
                total = np.r_[0, np.cumsum(mask)]
                kept = block.buf[~mask].tobytes()
                left = off - total[off]
                spans = np.searchsorted(cut, off)
                yield pa.record_batch([
                    pa.array(block.ids), pa.array(np.diff(off)), pa.array(np.diff(total[off])), pa.array(np.diff(spans)),
                    binary([kept[i:j] for i, j in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes."""
    rows = narrow(docs, id_col, text_col)
    n_shards = max(1, text_bytes(rows) // SHARD_BYTES)
    bits = min(20, int(n_shards - 1).bit_length())
    blocks = write_table(rows.mapInArrow(_blocks, "block long, ids binary, off binary, text binary"), "blocks")

    def answers(sent: DataFrame, match, name: str) -> DataFrame:
        found = sent.groupBy("shard").applyInPandas(match, "block long, shard int, bits binary")
        return found.groupBy("block").agg(F.collect_list(F.struct("shard", "bits")).alias(name))  # a row per block and shard

    sent = blocks.mapInArrow(_send_triggers(window, gram, bits), "shard int, block long, hashes binary")
    known = write_table(answers(sent, _match_triggers, "triggers"), "triggers")
    seen = blocks.join(known.hint("merge"), "block", "left")
    sent = seen.mapInArrow(_send_phrases(window, gram, bits), "shard int, block long, phrases binary, sizes binary, docs binary")
    known = write_table(known.join(answers(sent, _sort_windows(window), "windows"), "block", "left"), "windows")
    return (blocks.join(known.hint("merge"), "block", "left")
            .mapInArrow(_remove(window, gram, bits), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
            .select(public_id(), "n_bytes", "n_removed", "n_spans", "kept"))
