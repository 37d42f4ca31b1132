"""The registered corpus queries: each applies its operator to its whole table
and derives the columns of its contract from the operator's outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (decontaminate, exact_dedup, line_dedup, merkle, near_dedup, packing, quality, repetition, search, sharding,
                          substring_dedup, suffix_dedup, toxicity)
from panelkit.llm.common import documents

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), _labels(spark, sf_dir))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), _labels(spark, sf_dir))


_WS = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
k AS (SELECT *, {_LOWER.format(f"regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g')")} AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.key IS NOT NULL AND r.keeper <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE r.key IS NULL OR r.keeper = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key GROUP BY k.doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@query(rf"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS pts, regexp_replace(coalesce(text, ''), '{_WS}', '', 'g') AS t FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY pts DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query(rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(list_slice(ws, i, i + least(10, len(ws)) - 1), ' ') AS win
       FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS win
       FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM w, lens WHERE len(ws) >= n)),
h AS (SELECT dw.doc_id, dw.i, bw.n, bw.item_id FROM dw JOIN bw USING (n, win)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hw ON hw.doc_id = w.doc_id LEFT JOIN hi ON hi.doc_id = w.doc_id""")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query(rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(list_slice(ws, i, i + 2), ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.reach),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id""")
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=3, percent=85)


@query(rf"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
v AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 49), ' ')) AS win
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT win, min(doc_id) AS source FROM v GROUP BY win HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 49)) AS p FROM v JOIN f USING (win) WHERE source < doc_id)),
a AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
k AS (SELECT a.doc_id, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY a.p) FILTER (WHERE g.p IS NULL) AS kept
      FROM a LEFT JOIN g ON g.doc_id = a.doc_id AND g.p = a.p GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id""")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
v AS (SELECT doc_id, size, i, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS win
      FROM (SELECT doc_id, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS i
            FROM w, (VALUES (5), (10), (31)) AS sizes(size) WHERE len(ws) >= size)),
again AS (SELECT doc_id, size, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, size, win) AS c FROM v) WHERE c > 1),
hit AS (SELECT doc_id, size, count(DISTINCT p) AS c
        FROM (SELECT doc_id, size, unnest(generate_series(i, i + size - 1)) AS p FROM again) GROUP BY doc_id, size),
r AS (SELECT doc_id, max(c) FILTER (WHERE size = 5) AS short, max(c) FILTER (WHERE size = 10) AS long, max(c) FILTER (WHERE size = 31) AS longest
      FROM hit GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_WS}+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
             coalesce(short, 0) AS n_repeat_words, coalesce(long, 0) AS long, coalesce(longest, 0) AS longest
      FROM w LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN l ON l.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * long <= 15 * n_words AND longest = 0 AS kept
FROM c""")
def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge_repetition(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# CRC-32 bit by bit, over the digits of the id
_CRC_SQL = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
  lambda a, b: list_reduce(range(8), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)), xor(a, b)), 4294967295), 4294967295)"""


def _tree_sql(name: str, leaves: str) -> str:
    return f"""{name}(tree, level, idx, n, digest) AS (
  {leaves} UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n)"""


def _path_sql(name: str, tree: str, leaves: str) -> str:
    return f"""{name}(r, tree, level, idx, n, folded, sibs) AS (
  {leaves} UNION ALL
  SELECT p.r, p.tree, p.level + 1, p.idx // 3, (p.n + 2) // 3,
         sha256(string_agg(CASE WHEN s.idx = p.idx THEN p.folded ELSE s.digest END, '' ORDER BY s.idx)),
         p.sibs || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (WHERE s.idx <> p.idx), '')
  FROM {name} p JOIN {tree} s ON s.tree = p.tree AND s.level = p.level AND s.idx // 3 = p.idx // 3
  WHERE p.n > 1 GROUP BY p.r, p.tree, p.level, p.idx, p.n, p.folded, p.sibs)"""


@query(f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT *, CASE WHEN {_CRC_SQL} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents),
leaf AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, {_leaf_sql("text")} AS leaf, {_leaf_sql("other")} AS other,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM d),
{_tree_sql("t", "SELECT tree, 0, idx, n, leaf FROM leaf")},
sub AS MATERIALIZED (SELECT tree, digest FROM t WHERE n = 1),
{_tree_sql("u", "SELECT CAST(-1 AS BIGINT), 0, tree, count(*) OVER (), digest FROM sub")},
{_path_sql("p", "t", "SELECT r, tree, 0, idx, n, other, '' FROM leaf")},
up AS (SELECT p.*, (SELECT count(*) FROM sub) AS m FROM p WHERE n = 1),
{_path_sql("q", "u", "SELECT r, CAST(-1 AS BIGINT), 0, tree, m, folded, sibs FROM up")}
SELECT doc_id, leaf, sub.digest AS subroot, root.digest AS root, sha256(q.sibs) AS proof_sha256, q.folded AS folded_root,
       q.folded = root.digest AS verified
FROM leaf JOIN q ON q.r = leaf.r AND q.n = 1 JOIN sub ON sub.tree = leaf.tree, (SELECT digest FROM u WHERE n = 1) root""")
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(documents(spark, sf_dir))


_TERM_TEXT = _LOWER.format("coalesce(text, '')")
_TERMS = rf"regexp_extract_all({_TERM_TEXT}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(f"""
WITH dt AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY doc_id, term),
dl AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM dt GROUP BY doc_id),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM dl),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM dt, g GROUP BY term, docs),
it AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // total) AS m FROM dl, g),
s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM it JOIN wt USING (term) JOIN dt USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10""")
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))
