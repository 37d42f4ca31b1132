"""Rows, not ids, are documents: rows that share an id or have none, private column names, long texts, empty tables."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from panelkit.llm import common, exact_dedup, line_dedup, near_dedup, substring_dedup

SMALL = "/root/testdata/sf0.001"
LINE = "THE SAME LINE, LONG ENOUGH TO BE LOOKED AT ONCE MORE"


def prose(seed, n, words=500):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, words, n))


def table(spark, rows, extra="row_key long, own string, row int, `a.b` int"):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], f"doc_id long, text string, {extra}").repartition(3)


def key(t):
    return tuple((x is not None, x if isinstance(x, int) else str(x)) for x in t)


def same(found, want):
    assert sorted(found, key=key) == sorted(want, key=key)


def test_row_keys_are_unique_and_give_ids_back(spark):
    for rows in ([(1, "a"), (2, "b")], [(None, "a"), (None, "b"), (3, "c")], [(1, "a"), (1, "b"), (1, "a"), (None, "c"), (5, "d"), ((1 << 63) - 2, "e")]):
        docs = table(spark, rows)
        keyed, restored = common.row_keys(docs)
        assert keyed.select(common.KEY).distinct().count() == len(rows)
        back = restored(keyed, common.KEY)
        same([tuple(r) for r in back.select(common.KEY, "row.text").collect()], rows)
        assert keyed.select("row.*").columns == docs.columns
        first = {r["own"] for r in keyed.collect() if r[common.KEY] == r["own"]}
        assert len(first) == len({i for i, _ in rows if i is not None}) or (1 << 63) - 2 in {i for i, _ in rows}


def test_lines_of_rows_with_one_id(spark):
    rows = [(1, f"{LINE}\nfoo one"), (1, f"bar two\n{LINE}"), *[(i, f"text {i}\n{LINE}") for i in range(2, 7)], (None, f"{LINE}\nno id"), (None, "plain"), (9, None)]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(table(spark, rows)).collect()]
    want = [(1, 2, 1, "foo one"), (1, 2, 1, "bar two"), *[(i, 2, 1, f"text {i}") for i in range(2, 7)], (None, 2, 0, f"{LINE}\nno id"), (None, 1, 0, "plain"), (9, 1, 0, "")]
    same(got, want)
    without = [r for r in rows if r[0] is not None]  # the two rows of the largest id keep the line
    got = [(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(table(spark, [*without, (6, f"again\n{LINE}")])).collect()]
    assert (6, f"again\n{LINE}") in got and (6, f"text 6\n{LINE}") in got and (5, "text 5") in got


def test_exact_groups_of_rows_with_one_id(spark):
    long = prose(1, 3000)
    rows = [(1, "aaa bbb"), (1, "ccc dd"), (2, "aaabbb"), (3, "c"), (3, "c "), (None, "c"), (None, None), (4, ""), (5, long), (5, long + " "), (5, long + "x")]
    norm = [re.sub(r"[ \t-\r]", "", t or "") for _, t in rows]
    got = exact_dedup.exact_groups(table(spark, rows)).collect()
    assert len(got) == len(rows)
    want = [(i, norm.count(n), hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm)]
    same([(r["doc_id"], r["group_size"], r["text_sha256"]) for r in got], want)
    for digest in {w[2] for w in want}:
        group = [r for r in got if r["text_sha256"] == digest]
        assert sum(r["kept"] for r in group) == 1 and len({r["keep_id"] for r in group}) == 1
        members = [(-len(t or ""), i is None, i or 0, i) for (i, t), n in zip(rows, norm) if hashlib.sha256(n.encode()).hexdigest() == digest]
        assert group[0]["keep_id"] == min(members)[3]


def shingles(t, size):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    return {tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def test_near_groups_of_rows_with_one_id(spark):
    a, b = prose(2, 80), prose(3, 90)
    rows = [(1, a), (1, b), (2, a + " end"), (3, "start " + b), (None, b + " x"), (None, prose(4, 50)), (7, prose(5, 40)), (7, ""), (8, None), (8, "one"), (9, "one")]
    sets = [shingles(t, 3) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        return i if parent[i] == i else root(parent[i])
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    got = near_dedup.near_duplicates(table(spark, rows), size=3, percent=85).collect()
    same([(r["doc_id"], r["n_shingles"]) for r in got], [(i, len(s)) for (i, _), s in zip(rows, sets)])
    assert sum(r["kept"] for r in got) == len({root(i) for i in range(len(rows))})
    # every row's class is the one of its own text: {a, a'}, {b, b', b''} and the lone ones
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert by[(1, len(sets[0]))] == by[(2, len(sets[2]))] and by[(1, len(sets[1]))] == by[(3, len(sets[3]))] == by[(None, len(sets[4]))]
    assert by[(9, 1)] in (8, 9)  # which row of id 8 comes first is not fixed


def test_substrings_of_rows_with_one_id(spark):
    shared, other = prose(6, 30), prose(7, 30)
    rows = [(1, f"{shared} tail"), (1, f"{other} end"), (2, f"x {shared} y {other}"), (None, f"{other} z"), (3, None), (3, "")]
    got = [tuple(r) for r in substring_dedup.dedup_substrings(table(spark, rows), window=20, k=8).collect()]
    assert len(got) == len(rows)
    kept = " ".join(r[3] for r in got).split()
    # each passage stands once among what is kept, and nothing else is lost
    assert sorted(kept) == sorted((f"{shared} {other} tail end x y z").split())


def test_private_names_do_not_clash(spark):
    docs = table(spark, [(1, "a b c"), (1, "a b c"), (None, "d e f"), (2, "g")], "`row_key` long, __row_key string, __part int, own int")
    kept = corpus_pipeline.drop_exact_copies(spark, docs, SMALL)
    assert kept.columns == docs.columns
    same([tuple(r) for r in kept.collect()], [(1, "a b c", 1, "x", 2, 3), (None, "d e f", 1, "x", 2, 3), (2, "g", 1, "x", 2, 3)])


def test_pipeline_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0, name


@pytest.mark.parametrize("text", [prose(8, 700_000, 90_000)])
def test_a_text_of_five_megabytes(spark, text):
    assert len(text) > 4 << 20
    docs = spark.createDataFrame([(1, text), (2, text[:1000]), (3, text + " end")], "doc_id long, text string")
    assert [r["kept"] for r in exact_dedup.exact_groups(docs).orderBy("doc_id").collect()] == [True] * 3
    assert [r["component_id"] for r in near_dedup.near_duplicates(docs).orderBy("doc_id").collect()] == [1, 2, 1]
    removed = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert removed[1] == (700_000, 0) and removed[3] == (700_001, 700_000) and removed[2][1] >= removed[2][0] - 1
