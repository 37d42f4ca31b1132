"""Helpers shared by the corpus operators: intermediate tables in the shared
folder, Arrow text buffers, word boundaries and rolling hashes.

Hashes here only group candidates; every operator that needs equality compares
the bytes or whole sets afterwards, or says so in its docstring.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import ensure_checkpoint_dir

NULL_ID = (1 << 63) - 1  # stands for a null doc_id inside an operator; sorts last
SLICE_BYTES = 1 << 19    # text handled at once inside a task; bounds numpy's working arrays
POWERS_KEPT = 8 << 20    # longest table of powers that a worker keeps
BATCH_BYTES = 8 << 20    # Arrow batch sent to a task's Python worker, unless the session sets its own bound
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
WHITE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: the usual 10,000 rows of long texts take an executor's memory
    outside the heap several times over. A bound set on the session stays."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any input: other columns (and their names) never enter an operator;
    a null id becomes NULL_ID, a null text stays null."""
    bound_batches(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )


KEY = "row_key"
ROW = "row"


def row_keys(docs: DataFrame, id_col: str = "doc_id"):
    """The rows as (KEY, own id, ROW: a struct of all columns, so that no name can clash), and a function
    that gives key columns of a frame their ids back.

    A row's key is its id. Rows without an id, and all but one of those that share an id, get keys of their
    own above every id, from a copy of these rows alone that is written once."""
    own = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(own.alias("own"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW))
    ids = rows.groupBy("own").agg(F.count(F.lit(1)).alias("n"))
    top, nulls, shared = ids.agg(F.max("own"), F.count_if(F.col("own").isNull()), F.count_if(F.col("own").isNotNull() & (F.col("n") > 1))).first()
    if not nulls and not shared:
        return rows.select(F.col("own").alias(KEY), "own", ROW), lambda df, *cols: df
    odd, plain = rows.filter("own IS NULL"), rows.filter("own IS NOT NULL")
    if shared:
        several = write_table(ids.filter("own IS NOT NULL AND n > 1").select("own"), "keys")
        odd = odd.unionByName(plain.join(several.hint("merge"), "own", "left_semi").select("own", ROW))
        plain = plain.join(several.hint("merge"), "own", "left_anti")
    odd = write_table(odd.withColumn("at", F.monotonically_increasing_id()), "keys")
    # a task's numbers follow each other from its own start: one count a task makes them dense
    parts = odd.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, n = [], 0
    for r in parts:
        starts.append((r["part"], n))
        n += r["n"]
    top = -1 if top is None else top
    shift = max(0, top + n - NULL_ID)  # keys must fit a long: ids near its end move down together
    offsets = docs.sparkSession.createDataFrame(starts, "part long, start long")
    odd = (odd.join(F.broadcast(offsets), F.shiftright("at", 33) == F.col("part"))
           .withColumn(KEY, F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(top - shift + 1)))
    if shared:  # the first of the rows that share an id has it as its key
        first = odd.filter("own IS NOT NULL").groupBy(F.col("own").alias("of")).agg(F.min(KEY).alias("first"))
        odd = odd.join(first, F.col("own") == F.col("of"), "left").withColumn(
            KEY, F.when(F.col(KEY) == F.col("first"), F.col("own") - F.lit(shift)).otherwise(F.col(KEY)))
    named = odd.filter(F.col("own").isNotNull() & (F.col(KEY) > top - shift)).select(F.col(KEY).alias("named_key"), F.col("own").alias("named_id"))

    def restored(df: DataFrame, *cols: str) -> DataFrame:
        for c in cols:
            plain_id = F.when(F.col(c) <= top - shift, F.col(c) + F.lit(shift))
            if shared:
                df = df.join(named, F.col(c) == F.col("named_key"), "left").withColumn(c, F.coalesce(plain_id, "named_id")).drop("named_key", "named_id")
            else:
                df = df.withColumn(c, plain_id)
        return df
    rows = plain.select((F.col("own") - F.lit(shift)).alias(KEY), "own", ROW).unionByName(odd.select(KEY, "own", ROW))
    return rows, restored


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(doc_id, text) as ``narrow`` gives them, but with a key of its own for every row in doc_id, and the
    function giving key columns their ids back. ``own`` is the row's id, NULL_ID without one."""
    bound_batches(docs.sparkSession)
    rows, restored = row_keys(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), "id")
    return rows.select(F.col(KEY).alias("doc_id"), F.coalesce("own", F.lit(NULL_ID)).alias("own"), F.col(f"{ROW}.text").alias("text")), restored


def public_id(col: str = "doc_id"):
    return F.when(F.col(col) != NULL_ID, F.col(col)).alias(col)


def write_table(df: DataFrame, label: str = "t") -> DataFrame:
    """Cut lineage: write to the shared checkpoint folder as Parquet and read it back
    (survives lost executors, and later steps read only the columns they need)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


# --- text buffers -----------------------------------------------------------

def buffer_of(col) -> tuple[np.ndarray, np.ndarray]:
    """(uint8 buffer, int64 offsets) of an Arrow string or binary array; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    if len(col) == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text (a longer text stands alone)."""
    for batch in batches:
        _, off = buffer_of(batch.column(text))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


# --- words ------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NON_SPACE = np.ones(256, bool)
NON_SPACE[list(WHITE)] = False
# letters and digits of ASCII, and every byte of a character outside ASCII
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def words(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends (byte positions) and, per document, the index of its first word (n + 1 values)."""
    flag = np.zeros(len(buf) + 1, bool)
    flag[:-1] = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(flag[:-1] & (~np.r_[False, flag[:-2]] | edge[:-1])) if len(buf) else np.zeros(0, np.int64)
    ends = np.flatnonzero(flag[:-1] & (~flag[1:] | edge[1:])) + 1 if len(buf) else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(starts, off)


_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= POWERS_KEPT:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of 64-bit values (equal values, equal hash)."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_BASE_INV, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    return range_hashes(_BYTE[buf], starts, ends)


def gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """64-bit rolling hash of every run of ``size`` bytes."""
    if len(buf) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _power(_BASE, len(buf)), out=total[1:])
    return mix((total[size:] - total[:-size]) * _power(_BASE_INV, len(buf) - size + 1))


def triggers(grams: np.ndarray, grams_in_window: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose gram is the smallest of some valid window (all of equal ones), and the
    smallest gram of every window. Which positions of a window are triggers because of it
    depends on the window's content alone, so equal windows share a trigger."""
    least = run_minima(grams, grams_in_window)
    padded = np.zeros(len(grams) + grams_in_window - 1, np.uint64)
    padded[grams_in_window - 1: grams_in_window - 1 + len(least)] = np.where(valid[: len(least)], least, 0)
    most = ~run_minima(~padded, grams_in_window)
    return np.flatnonzero(most == grams), least


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive items; the last n - 1 positions have none."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out, at, step, part, width = np.zeros(size, np.uint64), 0, 1, h, 1
    step_pow = int(_STEP)
    while True:
        if n & width:
            out += part[at: at + size] * np.uint64(pow(step_pow, at, 1 << 64))
            at += width
        if width * 2 > n:
            return mix(out)
        part = part[: len(part) - width] + part[width:] * np.uint64(pow(step_pow, width, 1 << 64))
        width *= 2


def run_minima(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of n consecutive values."""
    if len(h) < n:
        return np.zeros(0, h.dtype)
    width, part = 1, h
    while width * 2 <= n:
        part = np.minimum(part[: len(part) - width], part[width:])
        width *= 2
    rest = n - width
    return np.minimum(part[: len(part) - rest], part[rest:]) if rest else part


def owner(first: np.ndarray, n: int) -> np.ndarray:
    """Document index of each of n items, from the documents' first items."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of n positions lying in any of the intervals."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def binary(blobs) -> pa.Array:
    return pa.array(blobs, pa.binary())


def filter_rows(docs: DataFrame, mask, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, for which ``mask(texts)`` holds; no shuffle."""
    def run(batches):
        for b in slices(batches, text_col):
            yield b.filter(pa.array(mask(b.column(text_col)), pa.bool_()))
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
