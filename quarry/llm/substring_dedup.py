"""Substring dedup by relative Lempel-Ziv parsing against a distributed, anchored reference index.

The reference is the corpus itself. Every window of `window` words has an anchor: its smallest
k-gram hash (the leftmost of equals), which depends on the window's words alone. Consecutive
windows with one anchor form a run, so each run belongs to exactly one reference block (those
runs of the corpus that share its anchor), and no other block can hold one of its windows; a
document is thus parsed against every block that could match it, and never against the rest.

The index holds for each block how many runs it has and whether all have the same words, and, where
that is more than one, the positions (text, word) of its first and its last occurrence. A run whose block holds nothing else
is a literal. A run whose block holds only copies of itself matches the first occurrence (the last,
if it is the first itself) as a whole. Where the copies of a block disagree, matches end inside the
run: of these boundary runs each window is looked up by itself, in an index of windows made alike.

Parsing takes a document's matches from left to right: a factor goes on as long as the next match
continues it in the same source at the same displacement, else it ends there and the next one
begins. Factors begin at matches of a whole window at least, and every window that straddles the
boundary of two factors has been looked up by itself, so removing the words of all factors removes
exactly the words of windows that occur elsewhere, whichever occurrence a factor points to. (A
factor points to one occurrence of each match, so it may be shorter than the longest possible.)

Blocks and windows are counted by aggregates that combine on the map side, so a hot passage costs
one row a task, and joins back go through exchanges that adaptive execution may split. Verdicts
belong to texts, so copies share them.

Windows are told apart by 128 bits (two hashes of their words; words by 64 bits), texts by 87 bits.
Runs of a block take 64 bits, as a block is wrongly taken for copies of one run only if all its
different runs have one hash. Defined results: null and empty texts have no words; a repeated row counts as another
occurrence, so its windows are removed; null ids are carried; texts of any length are taken whole
(positions have 31 bits, more than a string can hold); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import byte_class, covered, mix, rolling, runs_hashes, span_hashes, spread_join, text_slices, word_bounds, written

WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words of a window, and of the k-grams that anchors are chosen from.
WINDOW, ANCHOR = 35, 8
_PLACE = np.uint64((1 << 22) - 1)
#: Grams that places are worked out for at once; places in such a part fit _PLACE.
_PART = 1 << 21
#: r holds 23 bits of a second hash of the text, the first word of a run or window, the number of its windows, and whether its block is all copies of it.
PLACE_BITS, TEXT_BITS = 39, 23
_HERE = (1 << PLACE_BITS) - 1
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each width neighbours, by doubling."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _leftmost_least(grams: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each width grams is (the leftmost of equals), by their upper 42 bits."""
    found = [np.zeros(0, dtype=np.int64)]
    for lo in range(0, len(grams) - width + 1, _PART):
        part = grams[lo : lo + _PART + width - 1]
        least = _sliding_min((part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), width)
        found.append((least & _PLACE).astype(np.int64) + lo)
    return np.concatenate(found)


def second(words: np.ndarray) -> np.ndarray:
    """Other hashes of words, from their hashes."""
    return mix(words ^ _SECOND)


def anchored_runs(words: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash, content hash) of the runs of a slice; windows by their first word."""
    none, no_hash = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if len(words) < window:
        return none, none, no_hash, no_hash
    grams = rolling(words, anchor)
    places = _leftmost_least(grams, window - anchor + 1)
    at = np.arange(len(places))
    room = np.repeat(first[1:], np.diff(first))[: len(places)]
    at = at[at + window <= room]
    if not len(at):
        return none, none, no_hash, no_hash
    place = places[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    lo, count = at[heads], np.diff(np.append(heads, len(at)))
    content = runs_hashes(words, lo, lo + count - 1 + window) ^ mix((place[heads] - lo).astype(np.uint64))
    return lo, count, grams[place[heads]], content


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _runs(window: int, anchor: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_ids, others = (batch.column(i).to_numpy() for i in (0, 1))
            for lo_row, hi_row, data, off in text_slices(batch.column(2)):
                a, b, first = word_bounds(data, off, WORD)
                lo, count, gram, content = anchored_runs(span_hashes(data, a, b), first, window, anchor)
                doc = np.searchsorted(first[1:], lo, side="right")
                packed = (others[lo_row:hi_row][doc].astype(np.int64) << PLACE_BITS) | ((lo - first[doc]) << 8) | (count << 1)
                yield pa.RecordBatch.from_arrays([pa.array(text_ids[lo_row:hi_row][doc]), _signed(gram), _signed(content), pa.array(packed, pa.int64())], names=["t", "a", "c", "r"])

    return run


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the entries of an array of lists; a null is an empty list."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    return np.repeat(np.arange(len(lists)), size), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _matches(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, r, source, place in the source) of arrays of matches, by row and place."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), size)
    r, source, there = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
    r, there = r & _HERE, there & _HERE
    order = np.lexsort((r >> 8, row))
    return row[order], r[order], source[order], there[order] >> 8


def _windows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_ids, others = (batch.column(i).to_numpy() for i in (0, 1))
            row, runs = _flat(batch.column(3))
            runs &= _HERE
            for lo_row, hi_row, data, off in text_slices(batch.column(2)):
                here = (row >= lo_row) & (row < hi_row)
                if not here.any():
                    continue
                doc, r = row[here] - lo_row, runs[here]
                a, b, first = word_bounds(data, off, WORD)
                words = span_hashes(data, a, b)
                count = (r >> 1) & 127
                inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                place = np.repeat(r >> 8, count) + inner
                doc = np.repeat(doc, count)
                packed = (others[lo_row:hi_row][doc].astype(np.int64) << PLACE_BITS) | place << 8 | 3
                at = first[doc] + place
                h = (_signed(rolling(x, window)[at]) for x in (words, second(words)))
                yield pa.RecordBatch.from_arrays([pa.array(text_ids[lo_row:hi_row][doc]), *h, pa.array(packed, pa.int64())], names=["t", "w", "v", "r"])

    return run


def kept_words(data: np.ndarray, a: np.ndarray, b: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    k = np.flatnonzero(keep)
    doc = np.searchsorted(first[1:], k, side="right")
    last = np.ones(len(k), dtype=bool)
    last[:-1] = doc[1:] != doc[:-1]
    size = b[k] - a[k] + ~last
    ends = np.cumsum(size)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, dtype=np.uint8)
    src = np.repeat(a[k] - ends + size, size) + np.arange(len(out))
    space = np.zeros(len(out), dtype=bool)
    space[ends[~last] - 1] = True
    out[~space] = data[src[~space]]
    offsets = np.concatenate([[0], ends])[np.searchsorted(k, first)].astype(np.int32)
    return pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets), pa.py_buffer(out))


def parse(doc: np.ndarray, r: np.ndarray, source: np.ndarray, there: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Factors (document, first word, end, source, first word there) of matches in order of document and place."""
    place, last = r >> 8, (r >> 8) + ((r >> 1) & 127)
    shift = there - place
    goes_on = np.zeros(len(r), dtype=bool)
    goes_on[1:] = (doc[1:] == doc[:-1]) & (source[1:] == source[:-1]) & (shift[1:] == shift[:-1]) & (place[1:] <= last[:-1])
    heads = np.flatnonzero(~goes_on)
    tails = np.append(heads[1:], len(r)) - 1 if len(heads) else heads
    owner, begin, end = doc[heads], place[heads], last[tails] - 1 + window
    cut = begin.copy()  # a factor begins where the one before it ends
    cut[1:] = np.where(owner[1:] == owner[:-1], np.maximum(begin[1:], end[:-1]), begin[1:])
    some = cut < end
    return owner[some], cut[some], end[some], source[heads][some], (cut + shift[heads])[some]


FACTORS = "array<struct<start: bigint, length: bigint, source: bigint, source_start: bigint>>"


def _cut(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, *matches = _matches(batch.column(2))
            for lo_row, hi_row, data, off in text_slices(batch.column(1)):
                here = slice(*np.searchsorted(row, [lo_row, hi_row]))
                doc, begin, end, source, there = parse(row[here] - lo_row, *(x[here] for x in matches), window)
                a, b, first = word_bounds(data, off, WORD)
                gone = covered(first[doc] + begin, first[doc] + end, len(a))
                step = np.zeros(len(a) + 1, dtype=np.int64)
                np.cumsum(gone, out=step[1:])
                n = np.bincount(doc, minlength=hi_row - lo_row)
                factors = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (begin, end - begin, source, there)], names=["start", "length", "source", "source_start"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo_row, hi_row - lo_row),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(step[first[1:]] - step[first[:-1]], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), factors),
                        kept_words(data, a, b, first, ~gone),
                    ],
                    names=["__id", "n_words", "n_removed", "factors", "kept"],
                )

    return run


def _other(r: str) -> Column:
    """The second hash of a text, from the upper bits of r."""
    return F.shiftright(r, PLACE_BITS).cast("int").alias("u")


def _matched(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(t, u, m) of rows (t, r) of equal keys: m is r and the first of the others, or the last for the first itself."""
    at = F.struct("t", "r")
    sources = rows.groupBy(*keys).agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    own = (F.col("t") == F.col("lo.t")) & (F.col("r") == F.col("lo.r"))
    m = F.struct("r", F.when(own, F.col("hi.t")).otherwise(F.col("lo.t")).alias("source"), F.when(own, F.col("hi.r")).otherwise(F.col("lo.r")).alias("there"))
    return spread_join(rows, sources, keys).select("t", _other("r"), m.alias("m"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row: the id, n_words, n_removed, factors, kept (the words left, joined by a space).

    A factor is (start, length) in words and where its words occur too: source (the 64-bit hash of a text) and source_start.
    """
    if not anchor < window <= anchor + 100:
        raise ValueError("a window is longer than an anchor, by 100 words at most")
    kind = docs.schema[id_col].dataType.simpleString()
    second_hash = F.hash("__text").bitwiseAND(F.lit((1 << TEXT_BITS) - 1))
    base = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).select("__id", F.xxhash64("__text").alias("t"), second_hash.alias("u"), "__text")
    runs = base.select("t", "u", "__text").mapInArrow(_runs(window, anchor), "t long, a long, c long, r long")
    blocks = runs.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where(F.col("n") > 1).select("a", (F.col("lo") == F.col("hi")).cast("long").alias("whole"))
    parsed = written(spread_join(runs.select("t", "a", "r"), blocks, ["a"]).select("t", "a", F.col("r").bitwiseOR(F.col("whole")).alias("r")), "runs")
    copies = F.col("r").bitwiseAND(F.lit(1)) == 1
    ends = parsed.where(~copies).select("t", _other("r"), "r").groupBy("t", "u").agg(F.collect_set("r").alias("runs"))
    held = spread_join(base, ends, ["t", "u"]).select("t", "u", "__text", "runs")
    checked = held.mapInArrow(_windows(window), "t long, w long, v long, r long")
    twice = checked.groupBy("w", "v").agg(F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    single = written(spread_join(checked, twice, ["w", "v"]).select("t", "w", "v", "r"), "windows")
    matches = _matched(single, ["w", "v"]).unionByName(_matched(parsed.where(copies), ["a"])).groupBy("t", "u").agg(F.collect_set("m").alias("ms"))
    out = spread_join(base, matches, ["t", "u"], "left").select("__id", "__text", "ms")
    return out.mapInArrow(_cut(window), f"__id {kind}, n_words long, n_removed long, factors {FACTORS}, kept string").withColumnRenamed("__id", id_col)
