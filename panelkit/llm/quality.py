"""Quality scores by positive-unlabelled learning.

Trusted positives are labelled good documents; everything else used for training
is unlabelled text, whatever its label says. The model is additive over features
of the text's form (share of capitals, punctuation, repeated words and lines, word
and line lengths, ...), each cut into bins; it minimises the non-negative unbiased
risk  prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))  with
the logistic loss. When the second part turns negative on a shard, the step goes
against it, as the non-negative estimator prescribes. The class prior is estimated
as the share of good rows among the labelled rows outside the held-out fold.

Both samples are bounded (POSITIVES, UNLABELLED); training runs in rounds over
SHARDS of them with averaged weights, and scoring reads every whole text without a
shuffle.

Defined cases: null or empty text has all features 0 and is scored like any other;
without labelled rows all scores are 0.5; a null doc_id stays null and is not held
out; every row is scored, repeated ones too; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import LOWER, NON_SPACE, binary, buffer_of, narrow, public_id, slices, span_hashes, words
from panelkit.llm.learning import about, fold, known_labels, packed, sigmoid, train, with_text

POSITIVES = 20_000
UNLABELLED = 20_000
SHARDS = 4
ROUNDS = 3
STEPS = 150
BINS = 16
RATE, DECAY = 0.5, 1e-5
MODULUS, HELD, CUT = 3, 1, 0.5

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = True
_PUNCT &= ~_LETTER & ~_DIGIT
N_FEATURES = 20


def features(column) -> np.ndarray:
    """Form of each text as N_FEATURES numbers, nearly all of them shares from 0 to 1."""
    buf, off = buffer_of(column)
    n = len(off) - 1
    size = np.diff(off).astype(float)

    def per_doc(mask):
        total = np.r_[0, np.cumsum(mask, dtype=np.int64)]
        return (total[off[1:]] - total[off[:-1]]).astype(float)

    starts, ends, first = words(buf, off, NON_SPACE)
    n_words = np.diff(first).astype(float)
    doc = np.repeat(np.arange(n), np.diff(first))

    def per_word(mask):
        return np.bincount(doc, mask, n) if len(doc) else np.zeros(n)

    low = LOWER[buf]
    h = span_hashes(low, starts, ends)
    length = (ends - starts).astype(float)
    edge = np.zeros(len(buf), bool)
    edge[off[:-1][size > 0]] = True
    breaks = (buf == 10) | np.r_[edge[1:], True][: len(buf)]
    line_end = np.flatnonzero(breaks) + 1
    line_start = np.r_[0, line_end[:-1]][: len(line_end)]
    line_doc = np.searchsorted(off, line_start, "right") - 1
    n_lines = np.bincount(line_doc, minlength=n).astype(float) if len(line_doc) else np.zeros(n)
    line_hash = span_hashes(buf, line_start, line_end - (buf[line_end - 1] == 10)) if len(buf) else np.zeros(0, np.uint64)

    def distinct(owner, values):
        if not len(owner):
            return np.zeros(n)
        order = np.lexsort((values, owner))
        new = np.r_[True, (owner[order][1:] != owner[order][:-1]) | (values[order][1:] != values[order][:-1])]
        return np.bincount(owner[order][new], minlength=n).astype(float)

    same = lambda k: np.r_[np.zeros(min(k, len(h)), bool), (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])] if len(h) > k else np.zeros(len(h), bool)
    first_byte, last_byte = (buf[starts], buf[ends - 1]) if len(starts) else (buf[:0], buf[:0])
    before_last = buf[np.maximum(ends - 2, starts)] if len(starts) else buf[:0]
    second = buf[np.minimum(starts + 1, ends - 1)] if len(starts) else buf[:0]
    letters, per = per_doc(_LETTER[buf]), np.maximum(n_words, 1)
    chars = np.maximum(size, 1)
    return np.stack([
        per_doc(_UPPER[buf]) / np.maximum(letters, 1), per_doc(_DIGIT[buf]) / chars, per_doc(_PUNCT[buf]) / chars,
        per_doc(~NON_SPACE[buf]) / chars, letters / chars,
        per_word(same(1)) / per, per_word(same(2)) / per, distinct(doc, h) / per,
        per_word(_PUNCT[last_byte]) / per, per_word(_PUNCT[last_byte] & _PUNCT[before_last] & (length > 2)) / per,
        per_word(_UPPER[first_byte] & _UPPER[second] & (length > 1)) / per, per_word(_PUNCT[first_byte]) / per,
        per_word(_PUNCT[first_byte] & (length == 1)) / per,
        np.minimum(per_word(length) / per / 40, 1), np.minimum(np.log1p(np.maximum.reduceat(length, first[:-1].clip(max=max(0, len(length) - 1)))) / 8, 1) * (n_words > 0) if len(length) else np.zeros(n),
        distinct(line_doc, line_hash) / np.maximum(n_lines, 1), np.bincount(line_doc, (line_end - line_start) < 30, n) / np.maximum(n_lines, 1) if len(line_doc) else np.zeros(n),
        np.minimum(np.log1p(size / np.maximum(n_lines, 1)) / 10, 1), np.minimum(np.log1p(size) / 12, 1), per_doc(buf >= 128) / chars,
    ], axis=1)


def codes(column) -> np.ndarray:
    """Bin of each feature as a coordinate of the model; bins are finer near zero."""
    f = features(column)
    bins = np.minimum((np.sqrt(np.clip(f, 0, 1)) * BINS).astype(np.int64), BINS - 1)
    return bins + np.arange(N_FEATURES) * BINS


def _sample_rows(batches):
    for b in slices(batches):
        x = codes(b.column("text")).astype(np.uint16)
        yield pa.record_batch([b.column("doc_id"), b.column("y"), binary([r.tobytes() for r in x])], ["doc_id", "y", "x"])


def _descend(state, y, sizes, x):
    """Steps of Adagrad on one shard's non-negative risk; y is 1 for positives, 0 for unlabelled."""
    weights, power, prior = state
    w, power = weights.copy(), power.copy()
    x = np.frombuffer(x, np.uint16).reshape(-1, N_FEATURES).astype(np.int64)
    pos, unl = x[y == 1], x[y == 0]
    if not len(pos) or not len(unl):
        return w, power

    def gradient(rows, slope):
        g = np.bincount(rows.ravel(), np.repeat(slope, N_FEATURES), len(w))
        g[-1] = slope.sum()
        return g / len(rows)

    for _ in range(STEPS):
        sp, su = w[pos].sum(1) + w[-1], w[unl].sum(1) + w[-1]
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        rest = gradient(unl, sigmoid(su)) - prior * gradient(pos, sigmoid(sp))
        g = prior * gradient(pos, sigmoid(sp) - 1) + rest if negative >= 0 else -rest
        g += DECAY * w
        power += g * g
        w -= RATE * g / np.sqrt(power + 1e-8)
    return w, power


def _average(state, answers):
    parts = [[np.frombuffer(a, np.float64) for a in x] for x in answers]
    return np.mean([p[0] for p in parts], axis=0), np.mean([p[1] for p in parts], axis=0), state[2]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = MODULUS, held: int = HELD,
        positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> np.ndarray:
    """Weights of the bins and, last, the bias."""
    known = known_labels(labels, label, modulus, held)
    total, good = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    zero = np.zeros(N_FEATURES * BINS + 1)
    if not good:
        return zero
    rows = narrow(docs)
    trusted = about(known.filter("y = 1"), positives, label, good)
    web = rows.select("doc_id").filter(F.coalesce(fold(modulus) != held, F.lit(True)))
    web = about(web, unlabelled, "unlabelled").select("doc_id", F.lit(0).alias("y")).distinct()
    sample = with_text(rows, trusted.unionByName(web)).mapInArrow(_sample_rows, "doc_id long, y int, x binary")
    return train(packed(sample, SHARDS), _descend, _average, (zero, zero.copy(), good / total), ROUNDS)[0]


def _score(model):
    def run(batches):
        for b in slices(batches):
            total = model.value[codes(b.column("text"))].sum(1) + model.value[-1]
            yield pa.record_batch([b.column("doc_id"), pa.array(sigmoid(total))], ["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return narrow(docs, id_col, text_col).mapInArrow(_score(sent), "doc_id long, score double").withColumn("doc_id", public_id())


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return score_documents(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(fold(MODULUS) == HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
