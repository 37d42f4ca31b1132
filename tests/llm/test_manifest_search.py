"""Repetition rules, Merkle manifest and reversed search against brute force, on odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from panelkit.llm import merkle, repetition, search

WORDS = [f"w{i}" for i in range(300)]


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


P40 = prose(1, 40)
TEXTS = [
    None, "", " \n\t\n ", "one", "a b\na b\n \n \na b", prose(2, 9), prose(3, 10), prose(4, 200), f"{P40}\n{P40}", f"{P40}. {prose(5, 300)} {P40}",
    " ".join(["spam"] * 120), "buy now " * 30, f"{prose(6, 12)} {prose(7, 60)} {prose(6, 12)}", "Ünï# cödé <b> 日本\n日本\n日本 $5 & 10%",
    "\n".join(["the same line of text"] * 6), prose(8, 2500), f"{prose(9, 31)} x {prose(9, 31)} {prose(10, 400)}", "x\r\nx\r\nx",
]


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def in_windows(ws, size):
    """Words in windows of ``size`` words found twice or more."""
    at: dict = {}
    for i in range(len(ws) - size + 1):
        at.setdefault(tuple(ws[i:i + size]), []).append(i)
    return {p for x in at.values() if len(x) > 1 for i in x for p in range(i, i + size)}


def test_repetition(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[8], 1, "x"), (8, TEXTS[8], 1, "x")],
                                 "doc_id long, text string, spans int, kept string").repartition(3)
    limits = repetition.Limits(min_words=8, percent=12, longest=25)
    got = repetition.judge_repetition(docs, limits).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        t = TEXTS[8 if r["doc_id"] is None else r["doc_id"]]
        ws, lines, seen, dup = words_of(t), (t or "").split("\n"), set(), 0
        for x in lines:
            dup += bool(words_of(x)) and x in seen
            seen.add(x)
        longest = 0
        while in_windows(ws, longest + 1):
            longest += 1
        short, long_ones = in_windows(ws, 5), in_windows(ws, 8)
        failed = len(ws) < 10 or 100 * len(short) > 20 * len(ws)
        kept = not failed and 100 * len(long_ones) <= 12 * len(ws) and longest <= 25
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_long_repeat_words"], r["longest_repeat"],
                r["base_failed"], r["kept"]) == (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(short),
                                                 len(long_ones), longest, failed, kept), t
        assert {p for s in r["spans"] for p in range(s["start"], s["end"])} == long_ones


def test_longest_repeats_of_many_small_sequences():
    for seed in range(150):
        rng = np.random.default_rng(seed)
        seqs = [rng.integers(0, rng.choice([1, 2, 3, 9]), rng.choice([0, 1, 2, 6, 33])).tolist() for _ in range(rng.integers(1, 6))]
        doc = np.array([k for k, s in enumerate(seqs) for _ in s], np.int64)
        want = []
        for s in seqs:
            common = lambda i, j: next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k]), 0)  # noqa: B023, E731
            want += [max((common(i, j) for j in range(len(s)) if j != i), default=0) for i in range(len(s))]
        assert repetition.longest_repeats(np.array([x for s in seqs for x in s], np.int64), doc).tolist() == want


# --- manifest ---------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    """(left siblings, right siblings) up to the root."""
    out = []
    for nodes in levels[:-1]:
        lo = i - i % 3
        out.append((nodes[lo:i], nodes[i + 1:lo + 3]))
        i //= 3
    return out


def manifest(rows):
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        own[s] = tree([leaf_of(r, r[4]) for r in by[s]])
    top = tree([own[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            steps = path(own[s], i) + path(top, k)
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf_of(r, r[4].replace("\n", "") if even and r[4] is not None else r[4])
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*(x for left, right in steps for x in (*left, *right)))
            out.append((r[0], leaf_of(r, r[4]), own[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def key(t):
    return tuple((x is not None, str(x)) for x in t)


@pytest.mark.parametrize("sizes", [[1], [2, 1], [700, 1, 3, 30], [9, 10, 27, 28, 1, 1, 1, 4]])
def test_manifest(spark, sizes):
    rows = []
    for k, n in enumerate(sizes):
        source = [None, "é", "z", "a", "", "日本", "b", "c"][k]
        rows += [((k * 10_007 + i * 31) % 50_021 - 20, source, [None, "en"][i % 2], [None, i][i % 3 > 0],
                  [None, "", f"line {i}\nnext 日本\n", f"text {i}"][i % 4]) for i in range(n)]
    # no id, one id on different and on equal rows
    rows += [(None, "a", None, None, "no\nid"), (None, "a", "en", 1, "no\nid"), (7, "a", None, 2, "x\ny"), (7, "a", None, 2, "x\ny"), (7, "a", None, 2, "other\n")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], FIELDS + ", tree int, digest string").repartition(4)
    got = [tuple(r) for r in merkle.audit(docs).collect()]
    assert sorted(got, key=key) == sorted(manifest(rows), key=key)


def test_manifest_of_an_empty_table(spark):
    assert merkle.audit(spark.createDataFrame([], FIELDS)).collect() == []


def test_proof_of_one_text_and_root_alone(spark):
    rows = [(i, "s", "en", 3, f"t{i}\n") for i in range(40)]
    proved, root = merkle.proofs(spark.createDataFrame(rows, FIELDS))
    for r in proved.collect():
        assert merkle.fold(bytes(r["digest"]), bytes(r["seg"])) == root and r["other"] is None
        assert merkle.fold(hashlib.sha256(b"changed").digest(), bytes(r["seg"])) != root


# --- search -----------------------------------------------------------------

DOCS = [(i, prose(100 + i, 5 + 13 * i % 90)) for i in range(80)] + [
    (80, None), (81, ""), (82, "... !"), (83, "Été W1 w1 W1-w2_w3"), (None, prose(3, 30)), (None, "w1"), (84, "w1"), (84, "w1"), (85, prose(5, 20_000))]
ITEMS = [("a", "w1 w2 W3 w1"), ("b", "été, 日本"), ("c", None), ("d", "?"), ("e", "unknown terms"), (None, "w4 w5"), ("a", "w6"), ("f", prose(9, 60)), ("g", "w1")]


def terms(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(docs, items, limit):
    found = [(i, terms(t)) for i, t in docs]
    found = [(i, ts) for i, ts in found if ts]
    n, total = len(found), sum(len(ts) for _, ts in found)
    df: dict = {}
    for _, ts in found:
        for x in set(ts):
            df[x] = df.get(x, 0) + 1
    out = []
    for item_id, text in items:
        scores = []
        for i, ts in found:
            m = 100 - 75 + (75 * len(ts) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * ts.count(x)) // (1000 * ts.count(x) + 8 * m))
                    for x in terms(text) if x in df)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item_id, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:limit])]
    return out


@pytest.mark.parametrize("slice_limit", [1 << 20, 12])
@pytest.mark.parametrize("limit", [10, 2])
def test_search(spark, limit, slice_limit, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, item int, score string").repartition(5)
    items = spark.createDataFrame([(i, t, 3) for i, t in ITEMS], "item_id string, text string, rank int")
    got = [tuple(r) for r in search.search(docs, items, limit, slice_limit=slice_limit).collect()]
    assert sorted(got, key=key) == sorted(ranked(DOCS, ITEMS, limit), key=key)


def test_search_in_small_chunks(spark, monkeypatch):
    index = search.Index([t for _, t in ITEMS])
    index.weights[:] = 1000
    texts = [t for _, t in DOCS]
    import pyarrow as pa
    length, doc, term, tf = index.counts(pa.array(texts, pa.string()))
    monkeypatch.setattr(search, "SCORES", 40)
    parts = list(search._chunks(index, doc, term, len(texts)))
    assert sum(n for _, n, _ in parts) == len(texts) and len(parts) > 5
    assert [r for _, _, rows in parts for r in range(rows.start, rows.stop)] == list(range(len(doc)))


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:2], "item_id string, text string")
    assert search.search(docs, items).collect() == []
    assert search.search(spark.createDataFrame([(1, "w1")], "doc_id long, text string"), items.limit(0)).collect() == []
