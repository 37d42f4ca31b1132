"""Line dedup with two Bloom filters.

Every task hashes the keys of its documents' lines into two filters, seen once
and seen at least twice. Merging two tasks' filters ORs both and adds to the
second what the firsts have in common, so the merged second filter holds every
key of two documents or more (and some false positives). Only lines in it are
shuffled, with their whole keys: the exact count of documents, the document that
keeps the line and the removal all rest on equal key bytes.

The filters are cut into segments of SEGMENT_BITS by the key's hash and merged
segment by segment in Spark; only the second filter reaches the driver and the
tasks. Its size follows the text's bytes up to MAX_BITS (16 MB); beyond that more
lines are suspected and shuffled, and results stay the same.

Defined cases: null or empty text is one empty line; a null doc_id is kept and
sorts last; each row is a document of its own, also where rows share a doc_id or have
none, so such rows count one by one, lose only their own lines, and all rows of the
largest doc_id keep the line; very long texts are one row of their own slice; other
columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import WHITE, binary, keyed, slices, text_bytes, write_table

MIN_POINTS = 40
MIN_DOCS = 5
SEGMENT_BITS = 1 << 20
MAX_BITS = 1 << 27
PROBES = 3


def line_keys(text: bytes, min_points: int):
    """(line number, key) of the lines whose key is long enough."""
    for i, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(WHITE)
        if len(key) >= min_points and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_points):
            yield i, key


def _places(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash and its probes inside the segment (one row per hash)."""
    seg = (h % np.uint64(segments)).astype(np.int64)
    a, b = h >> np.uint64(40), (h >> np.uint64(16)) | np.uint64(1)
    return seg, np.stack([((a + np.uint64(k) * b) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64) for k in range(PROBES)], axis=1)


def _fill(segments: int, min_points: int):
    def run(batches):
        seen = []
        for b in slices(batches):
            for t in b.column("text").cast(pa.binary()).to_pylist():
                seen.append(np.fromiter({xxhash.xxh3_64_intdigest(k) for _, k in line_keys(t or b"", min_points)}, np.uint64))
        h, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, int))
        seg, at = _places(h, segments)
        for s in np.unique(seg):
            mine = seg == s
            yield pa.record_batch([
                pa.array([int(s)], pa.int32()), binary([np.unique(at[mine]).astype(np.uint32).tobytes()]),
                binary([np.unique(at[mine & (n > 1)]).astype(np.uint32).tobytes()]),
            ], ["seg", "once", "twice"])
    return run


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    for a, b in zip(rows["once"], rows["twice"], strict=True):
        a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
        twice[a[once[a]]] = True
        twice[b] = True
        once[a] = True
    return pd.DataFrame({"seg": rows["seg"].iloc[:1], "bits": [np.packbits(twice).tobytes()]})


def _suspects(filters, segments: int, min_points: int):
    def run(batches):
        bits = {s: np.unpackbits(np.frombuffer(x, np.uint8)).view(bool) for s, x in filters.value.items()}
        for b in slices(batches):
            ids, owners, keys, lines = [], [], [], []
            for doc_id, own_id, t in zip(b.column("doc_id").to_pylist(), b.column("own").to_pylist(),
                                         b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                own: dict[bytes, list[int]] = {}
                for i, k in line_keys(t or b"", min_points):
                    own.setdefault(k, []).append(i)
                if not own:
                    continue
                names = list(own)
                seg, at = _places(np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names)), segments)
                for j, k in enumerate(names):
                    seg_bits = bits.get(int(seg[j]))
                    if seg_bits is not None and seg_bits[at[j]].all():
                        ids.append(doc_id)
                        owners.append(own_id)
                        keys.append(k)
                        lines.append(own[k])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(owners, pa.int64()), binary(keys), pa.array(lines, pa.list_(pa.int32()))],
                                  ["doc_id", "own", "key", "lines"])
    return run


def _rewrite(batches):
    for b in slices(batches):
        n, dropped, kept = [], [], []
        for t, drop in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("drop").to_pylist(), strict=True):
            lines = (t or b"").split(b"\n")
            gone = set(drop or ())
            n.append(len(lines))
            dropped.append(len(gone))
            kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t or b"")
        yield pa.record_batch([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                               binary(kept).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the text without its repeated lines."""
    rows, restored = keyed(docs, id_col, text_col)
    segments = max(1, min(MAX_BITS, text_bytes(rows) // 16) // SEGMENT_BITS)
    filled = rows.mapInArrow(_fill(segments, min_points), "seg int, once binary, twice binary")
    merged = filled.groupBy("seg").applyInPandas(_merge, "seg int, bits binary")
    # at most MAX_BITS bits, whatever the corpus
    filters = docs.sparkSession.sparkContext.broadcast({r["seg"]: bytes(r["bits"]) for r in merged.collect()})
    suspects = write_table(rows.mapInArrow(_suspects(filters, segments, min_points),
                                           "doc_id long, own long, key binary, lines array<int>"), "lines")
    repeated = (suspects.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("keeper"))
                .filter(F.col("n") >= min_docs).drop("n"))
    drops = (suspects.join(repeated, "key").filter("own <> keeper")
             .groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("drop")))
    out = (rows.join(drops, "doc_id", "left").select("doc_id", "text", "drop")
           .mapInArrow(_rewrite, "doc_id long, n_lines long, n_dropped long, text string"))
    return restored(out, "doc_id").select("doc_id", "n_lines", "n_dropped", "text")
