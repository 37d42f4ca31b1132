"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams
and skip-grams.

A document's features are its distinct words, word pairs and pairs that skip one
word, hashed to 2**HASH_BITS coordinates. Training takes a bounded sample of
labelled documents (SAMPLE), dealt into shards of about SHARD_ROWS; each shard runs FTRL over its
documents one by one with per-coordinate rates, and each round averages the
shards' (z, n). Coordinates in fewer than MIN_DOCS documents of a shard are left
out there. The L1 term leaves few non-zero weights; they are broadcast (bounded by
the sample) and every whole text is scored where it lies, without a shuffle.

Defined cases: null or empty text has no features and gets the bias alone; without
any labelled row all scores are 0; a null doc_id stays null and is not held out;
every row is scored, repeated ones too; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import ALNUM, LOWER, binary, buffer_of, filter_rows, mix, narrow, public_id, runs, slices, span_hashes, words
from panelkit.llm.learning import about, fold, known_labels, packed, sigmoid, train, with_text

SAMPLE = 20_000
SHARD_ROWS = 2_500
ROUNDS = 8
HASH_BITS = 26
MIN_DOCS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1.0, 0.1
MODULUS, HELD, CUT = 4, 2, 0.3


def _features(column) -> tuple[np.ndarray, np.ndarray, int]:
    """Coordinates and document index of every occurrence of a feature."""
    buf, off = buffer_of(column)
    low = LOWER[buf]
    starts, ends, first = words(low, off, ALNUM)
    h = span_hashes(low, starts, ends)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pair = runs(h, 2)
    skip = mix(h[:-2] * np.uint64(3) + h[2:] * np.uint64(0x9E3779B97F4A7C15)) if len(h) > 2 else h[:0]
    in_pair, in_skip = doc[:-1] == doc[1:], doc[:-2] == doc[2:]
    coord = np.concatenate([h, pair[in_pair[: len(pair)]], skip[in_skip[: len(skip)]]]) & np.uint64((1 << HASH_BITS) - 1)
    where = np.concatenate([doc, doc[:-1][in_pair][: len(pair)], doc[:-2][in_skip][: len(skip)]])
    return coord.astype(np.int64), where, len(first) - 1


def _sample_rows(batches):
    for b in slices(batches):
        coord, where, n = _features(b.column("text"))
        own = np.unique((where << HASH_BITS) | coord)
        cuts = np.searchsorted(own, np.arange(n + 1) << HASH_BITS)
        coord = (own & ((1 << HASH_BITS) - 1)).astype(np.uint32)
        yield pa.record_batch([b.column("doc_id"), b.column("y"), binary([coord[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)])],
                              ["doc_id", "y", "x"])


def _weights(z, n):
    return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def _epoch(state, y, sizes, x):
    """FTRL over one shard; state is (coordinates, z, n) with the bias as coordinate -1."""
    coords, z0, n0 = state
    x = np.frombuffer(x, np.uint32)
    found, df = np.unique(x, return_counts=True)
    names = np.r_[-1, found[df >= MIN_DOCS].astype(np.int64)]
    used = np.r_[found[df >= MIN_DOCS], np.uint32(0xFFFFFFFF)]  # the last equals no coordinate
    at = np.searchsorted(coords, names)
    have = (at < len(coords)) & (coords[np.minimum(at, len(coords) - 1)] == names)
    z, n = np.where(have, z0[np.minimum(at, len(z0) - 1)], 0.0), np.where(have, n0[np.minimum(at, len(n0) - 1)], 0.0)
    ends = np.cumsum(sizes // 4)
    for k in range(len(y)):
        part = x[ends[k] - sizes[k] // 4: ends[k]]
        place = np.searchsorted(used, part)
        j = np.r_[0, place[used[place] == part] + 1]
        w = _weights(z[j], n[j])
        g = sigmoid(w.sum()) - y[k]
        step = (np.sqrt(n[j] + g * g) - np.sqrt(n[j])) / ALPHA
        z[j] += g - step * w
        n[j] += g * g
    return names, z, n


def _average(state, answers):
    coords, z0, n0 = state
    got = [[np.frombuffer(a[0], np.int64), np.frombuffer(a[1], np.float64), np.frombuffer(a[2], np.float64)] for a in answers]
    names = np.unique(np.concatenate([coords, *(g[0] for g in got)]))
    z, n = np.zeros(len(names)), np.zeros(len(names))
    at = np.searchsorted(names, coords)
    z[at], n[at] = z0, n0
    base_z, base_n = z.copy(), n.copy()
    for c, zs, ns in got:
        at = np.searchsorted(names, c)
        z[at] += (zs - base_z[at]) / len(got)
        n[at] += (ns - base_n[at]) / len(got)
    return names, z, n


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = MODULUS, held: int = HELD,
        sample: int = SAMPLE) -> dict:
    """Sparse weights {"bias", "coords", "weights"} learned outside the held-out fold."""
    known = known_labels(labels, label, modulus, held)
    total = known.count()
    picked = about(known, sample, label, total)
    shards = max(1, -(-min(total, sample) // SHARD_ROWS))
    rows = with_text(narrow(docs), picked).mapInArrow(_sample_rows, "doc_id long, y int, x binary")
    start = (np.array([-1]), np.zeros(1), np.zeros(1))
    coords, z, n = train(packed(rows, shards), _epoch, _average, start, ROUNDS)
    w = _weights(z, n)
    keep = (w != 0) & (coords >= 0)
    return {"bias": float(w[0]) if n[0] else -30.0, "coords": coords[keep], "weights": w[keep]}


def scores(model: dict, texts) -> np.ndarray:
    """Score of each text: the weights of its distinct features."""
    coord, where, n = _features(texts)
    marks = np.zeros(1 << 20, bool)
    marks[model["coords"] & 0xFFFFF] = True
    near = np.flatnonzero(marks[coord & 0xFFFFF])
    at = np.minimum(np.searchsorted(model["coords"], coord[near]), max(0, len(model["coords"]) - 1))
    hit = model["coords"][at] == coord[near] if len(model["coords"]) else np.zeros(0, bool)
    pairs = np.unique((where[near][hit] << 32) | at[hit])
    total = np.bincount(pairs >> 32, model["weights"][pairs & 0xFFFFFFFF], n) if len(pairs) else np.zeros(n)
    return sigmoid(total + model["bias"])


def _score(model):
    def run(batches):
        for b in slices(batches):
            yield pa.record_batch([b.column("doc_id"), pa.array(scores(model.value, b.column("text")))], ["doc_id", "score"])
    return run


def drop_toxic(docs: DataFrame, model: dict, cut: float = CUT) -> DataFrame:
    """The rows, with all their columns, that score below ``cut``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda texts: scores(sent.value, texts) < cut)


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return narrow(docs, id_col, text_col).mapInArrow(_score(sent), "doc_id long, score double").withColumn("doc_id", public_id())


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return score_documents(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(fold(MODULUS) == HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
