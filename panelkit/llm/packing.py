"""Packing of token sequences by minimum bin slack.

A document is its token ids and an end id, cut into whole windows and one
remainder. Only the remainders' lengths matter for filling windows, and there are
fewer lengths than tokens in a window, so the plan is made on the driver from the
histogram of lengths (at most ``window`` rows, whatever the corpus): each window
takes the longest length left and, by bitset subset-sum over the multiset of the
others, the lengths that bring it closest to capacity; the backtracked counts form
a pattern, used as often as the histogram allows. Pieces find their place in
parallel, by their rank among the pieces of their length.

Words repeat, so each is encoded once: a first pass counts the words of all texts,
the WORDS_KEPT most frequent ones are encoded in Spark and broadcast as flat arrays (bounded:
words of at most WORD_BYTES bytes), and a task looks a slice's distinct words up there
and encodes only the others. Which words are kept changes no id. A word is found by a hash and confirmed by its bytes;
words are encoded many to a text, with a word between them whose one id nothing else gives.
This needs a tokenizer that folds case, drops white space and lets no token cross it:
``load`` raises for a file whose normaliser or word pattern is another.

Defined cases: null text counts as empty (one end id); a null doc_id stays null;
every row is packed, repeated ones too; very long texts are encoded whole, a task
holding some 30 bytes per byte of the longest; other columns, whatever their names,
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import LOWER, NON_SPACE, WHITE, binary, buffer_of, narrow, public_id, slices, span_hashes, words, write_table

WINDOW = 4096
END_ID = 2
BUCKET_ROWS = 2000
WORDS_KEPT = 1 << 19   # most frequent words, of those found twice, whose ids are broadcast
WORD_BYTES = 32        # longest word kept: bounds the broadcast to some 40 MB
SLICE = 4 << 20        # bytes of text encoded at once
MARKER = b"\0"         # word between words that are encoded as one text
AT_ONCE = 20_000       # words encoded, or hashed, at once: bounds what they take beside their bytes
# the normaliser and the word pattern that words may be encoded apart under (fixed values)
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_STOP = np.zeros(256, bool)
_STOP[list(b".,")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[97:123] = True
_loaded: dict = {}
_markers: dict = {}


def load(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        made = json.loads(tokenizer.to_str())
        first = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        if made.get("normalizer") != NORMALIZER or first.get("pattern") != {"Regex": PATTERN}:
            raise ValueError(f"{path}: words can be encoded apart only where case is folded and white space dropped in the known way")
        marker = tokenizer.encode(MARKER.decode(), add_special_tokens=False).ids
        whole = made.get("truncation") is None and made.get("padding") is None
        _markers[path] = marker[0] if whole and len(marker) == 1 else None
        _loaded[path] = tokenizer
    return _loaded[path]


# --- words --------------------------------------------------------------------

def units(column) -> tuple[pa.Array, np.ndarray]:
    """Pieces of some texts that can be encoded apart, and the index of each text's first (n + 1 values):
    the words, folded as the tokenizer's normaliser does, with a final stop or comma after a letter or
    digit of ASCII split off, as its pattern does. A text that may hold a special token keeps its capitals
    and stops."""
    buf, off = buffer_of(column)
    starts, ends, first = words(buf, off, NON_SPACE)
    split = np.zeros(len(starts), bool)
    long = np.flatnonzero(ends - starts > 1)
    split[long] = _STOP[buf[ends[long] - 1]] & _PLAIN[LOWER[buf[ends[long] - 2]]]
    marks = np.flatnonzero((buf[:-1] == 60) & (buf[1:] == 124)) if len(buf) else np.zeros(0, np.int64)
    special = np.unique(np.searchsorted(off, marks, "right") - 1)
    if len(special):
        low = LOWER[buf]
        for d in special:
            low[off[d]:off[d + 1]] = buf[off[d]:off[d + 1]]
            split[first[d]:first[d + 1]] = False
        data = low.tobytes().translate(None, WHITE)
    else:
        data = buf.tobytes().translate(LOWER.tobytes(), WHITE)
    # each word that loses its stop makes two units
    ends_at = np.cumsum(ends - starts)
    more = np.cumsum(split)
    place = np.arange(1, len(starts) + 1) + more
    offsets = np.zeros(len(starts) + int(split.sum()) + 1, np.int64)
    offsets[place] = ends_at
    offsets[place[split] - 1] = ends_at[split] - 1
    found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return found, first + np.r_[0, more][first]


def _count(batches):
    for b in batches:
        found, _ = units(b.column("text"))
        counted = found.filter(pc.less_equal(pc.binary_length(found), WORD_BYTES)).value_counts()
        yield pa.record_batch([counted.field("values").cast(pa.binary()), counted.field("counts")], ["word", "n"])


def _column(values) -> pa.Array:
    """One Arrow array of binary values, from a list or a column in chunks."""
    if isinstance(values, pa.ChunkedArray):
        return pa.concat_arrays(values.chunks).cast(pa.large_binary()) if values.num_chunks else pa.array([], pa.large_binary())
    return pa.array(values, pa.large_binary())


def _hashes(found: pa.Array) -> np.ndarray:
    """64-bit hash of each word, AT_ONCE words at a time (the arrays take many times the words' bytes)."""
    buf, off = buffer_of(found)
    hashes = [np.zeros(0, np.uint64)]
    for at in range(0, len(found), AT_ONCE):
        cuts = off[at: at + AT_ONCE + 1]
        hashes.append(span_hashes(buf[cuts[0]: cuts[-1]], cuts[:-1] - cuts[0], cuts[1:] - cuts[0]))
    return np.concatenate(hashes)


class Lexicon:
    """Ids of some words: ``words`` (an Arrow array), their ids as one array cut by ``first``, and their hashes in order, with
    the word of each. The words and their ids, as little-endian bytes, may come as Arrow columns: no object is made per word."""

    def __init__(self, path: str, found=(), ids=None):
        self.path = path
        self.words = _column(found)
        if ids is None:
            self.ids, self.first = _encoded(path, self.words.to_pylist())
        else:
            blob, cuts = buffer_of(_column(ids))
            self.ids, self.first = blob.view(np.uint32), cuts // 4
        hashes = _hashes(self.words)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def lookup(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, length) of each word, encoding those that are not kept."""
        place, new = np.zeros(len(found), np.int64), np.arange(len(found))
        if len(self.words):
            at = np.searchsorted(self.hashes, _hashes(found))
            place = self.order[np.minimum(at, len(self.order) - 1)]
            # the bytes decide; a word behind another one's hash is encoded like any that is not kept
            new = np.flatnonzero(~pc.equal(self.words.take(pa.array(place)), found).to_numpy(zero_copy_only=False))
        ids, first = self.ids, self.first
        if len(new):
            more, starts = _encoded(self.path, found.take(pa.array(new)).to_pylist())
            place[new] = len(first) - 1 + np.arange(len(new))
            ids, first = np.r_[ids, more], np.r_[first, len(ids) + starts[1:]]
        return ids, first[place], first[place + 1] - first[place]


def _encoded(path: str, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word as one array, and where each word's begin."""
    tokenizer = load(path)
    marker = _markers[path]
    ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
    for at in range(0, len(found), AT_ONCE):
        part = found[at: at + AT_ONCE]
        text = (b" " + MARKER + b" ").join([*part, b""])
        if marker is not None and text.count(MARKER) == len(part):  # else a word holds it
            got = np.array(tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(got == marker)
            if len(ends) == len(part):
                ids.append(got[got != marker])
                sizes.append(np.diff(ends, prepend=-1) - 1)
                continue
        each = [np.array(g.ids, np.uint32) for g in tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
        ids += each
        sizes.append(np.array([len(x) for x in each], np.int64))
    return np.concatenate(ids), np.cumsum(np.concatenate(sizes))


def encode(column, lexicon: Lexicon, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each with the end id, and where each text's begin (n + 1 values)."""
    found, first = units(column)
    coded = found.dictionary_encode()
    ids, start, length = lexicon.lookup(coded.dictionary)
    word = coded.indices.to_numpy(zero_copy_only=False)
    size = length[word]
    at = np.zeros(len(word) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    bounds = at[first] + np.arange(len(first))
    source = np.repeat(start[word] - at[:-1], size)
    source += np.arange(len(source))
    of_word = np.ones(int(bounds[-1]), bool)
    of_word[bounds[1:] - 1] = False
    out = np.full(len(of_word), end_id, "<u4")
    out[of_word] = ids[source]
    return out, bounds


# --- pieces ---------------------------------------------------------------------

def _pieces(lexicon, window: int, end_id: int):
    def run(batches):
        for b in slices(batches, limit=SLICE):
            ids, bounds = encode(b.column("text"), lexicon.value, end_id)
            size = np.diff(bounds)
            count = -(-size // window)
            doc = np.repeat(np.arange(b.num_rows), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
            cuts = np.r_[bounds[doc] + start, bounds[-1]]
            pieces = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.record_batch([b.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(np.diff(cuts)), pa.array(size[doc]), pieces],
                                  ["doc_id", "start", "length", "doc_tokens", "ids"])
    return run


def _encode_words(path: str):
    def run(batches):
        for b in batches:
            ids, first = _encoded(path, b.column("word").to_pylist())
            yield pa.record_batch([b.column("word"), binary([ids[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)])], ["word", "ids"])
    return run


def lexicon(rows: DataFrame, tokenizer_path: str, kept: int = WORDS_KEPT) -> Lexicon:
    """The ids of the corpus's most frequent words, at most ``kept``, of those found twice or more. The least count that
    is kept comes from a histogram of the counts (sixteen steps between a count and its double), so no task sorts them."""
    counts = rows.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    counts = write_table(counts.withColumn("step", F.floor(F.log2("n") * 16).cast("int")), "words")
    least, room = None, kept
    for r in sorted(counts.groupBy("step").count().collect(), reverse=True):  # at most 1,008 steps
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    top = counts.filter(F.col("step") >= F.lit(least)).select("word")
    # bounded by ``kept``, and brought in one job as Arrow columns: a row object each takes the driver ten times their bytes
    found = top.mapInArrow(_encode_words(tokenizer_path), "word binary, ids binary").toArrow()
    return Lexicon(tokenizer_path, found.column("word"), found.column("ids"))


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
                    id_col: str = "doc_id", text_col: str = "text", kept: int = WORDS_KEPT) -> DataFrame:
    """Pieces of every document: doc_id, start, length, doc_tokens, ids (binary)."""
    load(tokenizer_path)
    rows = narrow(docs, id_col, text_col)
    known = docs.sparkSession.sparkContext.broadcast(lexicon(rows, tokenizer_path, kept))
    return rows.mapInArrow(_pieces(known, window, end_id), "doc_id long, start long, length long, doc_tokens long, ids binary")


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Copies of each length whose sum comes closest to ``capacity``: bounded subset sums as
    the bits of an integer, with the state before each length kept for backtracking."""
    reach, kept, full = 1, [], 1 << capacity
    mask = (full << 1) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= capacity), reverse=True):
        left = most = min(counts[length], capacity // length)
        kept.append((length, most, reach))
        step = 1
        while left:
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left -= take
            step *= 2
        if reach & full:
            break
    best, chosen = reach.bit_length() - 1, {}
    for length, most, before in reversed(kept):
        c = next(c for c in range(most + 1) if best >= c * length and before >> (best - c * length) & 1)
        if c:
            chosen[length] = c
            best -= c * length
    return chosen


def plan(histogram: dict[int, int], window: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (times used, [(length, copies)]) that place every length of the histogram."""
    left, patterns = dict(histogram), []
    for longest in sorted(left, reverse=True):
        while left[longest]:
            left[longest] -= 1
            pattern = fill_window(left, window - longest)
            left[longest] += 1
            pattern[longest] = pattern.get(longest, 0) + 1
            times = min(left[x] // c for x, c in pattern.items())
            for x, c in pattern.items():
                left[x] -= times * c
            patterns.append((times, sorted(pattern.items(), reverse=True)))
    return patterns


def _places(patterns) -> dict[str, np.ndarray]:
    """For each length, in order of rank: which pieces go to which sequences and offsets."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            first = used.get(length, 0)
            rows.append((length, first, copies, sequence, offset))
            used[length] = first + times * copies
            offset += length * copies
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T, strict=True))


def _assign(places):
    def run(batches):
        p = places.value
        key = (p["length"].astype(np.uint64) << np.uint64(44)) + p["first"].astype(np.uint64)
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            i = np.searchsorted(key, (length.astype(np.uint64) << np.uint64(44)) + rank.astype(np.uint64), "right") - 1
            at = rank - p["first"][i] if len(key) else rank
            b = b.drop_columns(["rank"])
            yield pa.record_batch([*b.columns, pa.array(p["sequence"][i] + at // p["copies"][i]),
                                   pa.array(p["offset"][i] + at % p["copies"][i] * length)],
                                  [*b.schema.names, "sequence_id", "offset"])
    return run


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces (doc_id, start, length and whatever else they carry) with sequence_id and offset."""
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `window` rows
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan(histogram, window)))
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).drop("n")
    local = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start")) - 1
    ranked = (dealt.withColumn("local", local).join(before, ["length", "bucket"])
              .select(*pieces.columns, (F.col("local") + F.col("before")).alias("rank")))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_assign(places), f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Placed pieces of all documents with the CRC-32 of their ids, and the ids themselves on request."""
    pieces = tokenize_pieces(docs, tokenizer_path, window, end_id, id_col, text_col)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    placed = place(write_table(pieces if with_ids else pieces.drop("ids"), "pieces"), window)
    return placed.withColumn("doc_id", public_id())


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves: ids of each, joined in order of offset (at most a window a group)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
