"""Quality rules: repetition inside a text, by its suffix array.

The suffixes of a text's word sequence are sorted by prefix doubling; the ranks kept
from each doubling give the longest common prefix (LCP) of neighbours. A run of
neighbours with LCPs of at least l is an LCP interval: a substring of l words and all
its occurrences. Of the nested intervals that hold a suffix, the deepest is a maximal
repeat and spans every shallower one at that place, so its length, the greater LCP of
the two neighbours, is what the suffix adds to the union of spans. Nothing is sampled
and no pair of occurrences is made: a text of n words takes n such spans, also when it
is one word n times over.

Limits (``Limits``): the share of words in repeats of ``min_words`` words or more, and
the words of the longest repeat (occurrences may overlap). The rules beside it count
words, characters, symbols and repeated lines.

Words are compared as bytes (Arrow dictionaries, no hashes). All work is within a row:
no shuffle, and a task holds one slice of about 512 KB of text or one longer text, with
some 150 bytes a word of it.

Defined cases: null or empty text has no words, no lines and fails the base rules; a
null doc_id stays null; every row is judged, repeated ones too; ties between equal
suffixes do not occur, as a suffix differs from another of its text in length; very
long texts are judged whole; other columns, whatever their names, are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelkit.llm.common import NON_SPACE, buffer_of, narrow, owner, public_id, slices, words

BASE_WINDOW = 5          # words of the base rule's window
MIN_WORDS = 10           # the base rule: fewer words fail
BASE_SHARE = 20          # the base rule: percent of words in repeated windows
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """A text is kept while repeats of at least ``min_words`` words cover at most ``percent`` of its
    words and no repeat is longer than ``longest`` words."""
    min_words: int = 10
    percent: int = 15
    longest: int = 30


def _numbered(buf: np.ndarray, keep: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of each span among the distinct spans; ``keep`` marks the bytes in spans, in order."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    data = np.ascontiguousarray(buf[keep])
    spans = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = spans.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def longest_repeats(symbols: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position of several sequences (``doc`` ascending), the length of the longest substring
    from there that also starts elsewhere in its sequence.

    Prefix doubling over all sequences at once; positions that differ from all others leave after
    the round that tells them apart. ``levels[k]`` holds ranks by the first 2**k symbols.
    """
    n = len(symbols)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    end = np.searchsorted(doc, doc, "right")       # first position after the sequence
    _, rank = np.unique(doc * (int(symbols.max()) + 1) + symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    levels, width = [rank], 1
    tied = np.flatnonzero(np.bincount(rank)[rank] > 1)
    while len(tied):
        # the tied positions' second halves; past the end of the sequence comes before everything
        after = tied + width
        inside = after < end[tied]
        second = np.zeros(len(tied), np.int64)
        second[inside] = rank[after[inside]] + 1
        order = np.lexsort((second, rank[tied]))
        first, second = rank[tied][order], second[order]
        head = np.r_[True, first[1:] != first[:-1]]
        new = head | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(tied))
        # a group of m equal ranks r owns r .. r + m - 1: its parts start at their first member's place
        group_start = np.maximum.accumulate(np.where(head, at, 0))
        part_start = np.maximum.accumulate(np.where(new, at, 0))
        rank = _spread(levels, rank)
        rank[tied[order]] = rank[tied[order]] + (part_start - group_start)
        levels.append(rank)
        width *= 2
        size = np.diff(np.r_[np.flatnonzero(new), len(tied)])
        tied = tied[order][np.repeat(size, size) > 1]
        tied.sort()
    # suffix array, and the LCP of neighbours from the ranks of each doubling, widest first
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    a, b = array[:-1].copy(), array[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        live = np.flatnonzero((a < end[array[:-1]]) & (b < end[array[1:]]))
        same = live[levels[k][a[live]] == levels[k][b[live]]]
        lcp[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    best[array[:-1]] = lcp
    best[array[1:]] = np.maximum(best[array[1:]], lcp)
    return best


def _spread(levels: list, rank: np.ndarray) -> np.ndarray:
    """A copy of the ranks in which a group of m equal ones owns m values (the first round numbers
    groups without gaps)."""
    if len(levels) > 1:
        return rank.copy()
    size = np.bincount(rank)
    start = np.cumsum(size) - size
    return start[rank]


def _union(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions in any [at, at + length)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def _per_doc(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated_lines(buf: np.ndarray, off: np.ndarray, has_word: np.ndarray) -> np.ndarray:
    """Lines of each document that hold a word and equal an earlier line of it."""
    docs = len(off) - 1
    breaks = np.flatnonzero(buf == 10)
    cut = np.zeros(len(buf), bool)
    cut[breaks] = True
    # a line ends at a break or with its document; by document, as empty ones end at the same byte
    doc = np.r_[np.searchsorted(off, breaks, "right") - 1, np.arange(docs)]
    order = np.argsort(doc, kind="stable")
    doc, ends = doc[order], np.r_[breaks, off[1:]][order]
    starts = np.r_[0, ends[:-1] + 1]
    first = np.r_[True, doc[1:] != doc[:-1]]
    starts[first] = off[:-1][doc[first]]
    number, size = _numbered(buf, ~cut, ends - starts)
    words_before = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(has_word, out=words_before[1:])
    worded = words_before[ends] > words_before[starts]
    key = (doc * max(size, 1) + number)[worded]
    _, seen = np.unique(key, return_index=True)
    return np.bincount(doc[worded], minlength=docs) - np.bincount(doc[worded][seen], minlength=docs)


def measure(column, limits: Limits) -> tuple[dict[str, np.ndarray], list]:
    """Counts of each text of an Arrow column, and the union of the spans of its long repeats (words)."""
    buf, off = buffer_of(column)
    starts, ends, first = words(buf, off, NON_SPACE)
    doc = owner(first, len(starts))
    in_word = NON_SPACE[buf]
    number, _ = _numbered(buf, in_word, ends - starts)
    best = longest_repeats(number, doc)

    def union(least):
        at = np.flatnonzero(best >= least)
        return _union(at, best[at], len(best))
    longest = np.zeros(len(off) - 1, np.int64)
    np.maximum.at(longest, doc, best)
    long_ones = union(limits.min_words)
    counts = {
        "n_words": np.diff(first).astype(np.int64),
        "word_chars": _per_doc(in_word & ((buf & 0xC0) != 0x80), off),
        "n_symbols": _per_doc(_SYMBOL[buf], off),
        "n_dup_lines": _repeated_lines(buf, off, in_word),
        "n_repeat_words": _per_doc(union(BASE_WINDOW), first),
        "n_long_repeat_words": _per_doc(long_ones, first),
        "longest_repeat": longest,
    }
    edge = np.zeros(len(best) + 1, bool)
    edge[first] = True                                  # spans never run on into the next document
    rise = np.flatnonzero(long_ones & (~np.r_[False, long_ones[:-1]] | edge[:-1]))
    fall = np.flatnonzero(long_ones & (~np.r_[long_ones[1:], False] | edge[1:])) + 1
    of = doc[rise]
    lo = np.searchsorted(of, np.arange(len(off) - 1), "left")
    hi = np.searchsorted(of, np.arange(len(off) - 1), "right")
    spans = [[{"start": int(s - first[d]), "end": int(e - first[d])} for s, e in zip(rise[x:y], fall[x:y], strict=True)]
             for d, (x, y) in enumerate(zip(lo, hi, strict=True))]
    return counts, spans


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_long_repeat_words", "longest_repeat")
SCHEMA = ("doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
          + ", base_failed boolean, kept boolean, spans array<struct<start:long,end:long>>")


def _judge(limits: Limits):
    def run(batches):
        for b in slices(batches):
            counts, spans = measure(b.column("text"), limits)
            n = counts["n_words"]
            failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > BASE_SHARE * n)
            repeated = (100 * counts["n_long_repeat_words"] > limits.percent * n) | (counts["longest_repeat"] > limits.longest)
            yield pa.record_batch(
                [b.column("doc_id"), *(pa.array(counts[c]) for c in COUNTS), pa.array(failed), pa.array(~failed & ~repeated),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", *COUNTS, "base_failed", "kept", "spans"])
    return run


def judge_repetition(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, and the spans [start, end) of words that lie in
    repeats of at least ``limits.min_words`` words."""
    return narrow(docs, id_col, text_col).mapInArrow(_judge(limits), SCHEMA).withColumn("doc_id", public_id())
