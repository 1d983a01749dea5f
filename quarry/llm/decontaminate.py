"""Benchmark decontamination: n-grams of benchmark items are looked up in every token window.

The normalised n-grams of the items become a sorted table of 64-bit hashes in packed arrays (a set
with the words, the place of each window in them and the items it belongs to), built once and
broadcast. Its size is checked: beyond max_windows (about 50 bytes each, with their words) the items
are taken in blocks, one pass over the documents a block, and the hits of all blocks are put
together per document before anything is decided. A window that is found is verified word by word
before it counts.

Defined results: null or empty texts have no words and no hits; null item texts, and items without
words, are skipped; an item without an id hits, but is not in the lists of items; items with equal
text, and repeated ids, all count (an id once); an item shorter than the window is one window of its
own length; rows are judged each by itself, repeated ones too; texts of any length are scanned
whole; empty tables of documents or items give no rows or no hits; extra columns are ignored by
`find_contamination` and carried by `decontaminate`, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import byte_class, covered, discard, mix, rolling, span_hashes, text_slices, word_bounds, written

WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Windows that are broadcast at once: about 100 MB.
MAX_WINDOWS = 2_000_000
OUT = "__id {id}, __text string, n_words long, hit_starts array<int>, hit_ends array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, as the byte tables see them."""
    raw = _LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    a, b, _ = word_bounds(raw, np.array([0, len(raw)]), WORD)
    raw = raw.tobytes()
    return [raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]


class Windows:
    """The windows of benchmark items by length, in arrays: hashes in order, places among the words, items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.names = [item for item, _ in items]
        raw = [(text or "").encode() for _, text in items]
        off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.data = _LOWER[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        a, b, first = word_bounds(self.data, off, WORD)
        words = span_hashes(self.data, a, b)
        self.a, self.b, self.tables = a, b, []
        sizes = np.minimum(np.diff(first), width)
        for w in np.unique(sizes[sizes > 0]).tolist():
            mine = np.flatnonzero(sizes == w)
            many = np.diff(first)[mine] - w + 1
            owner = np.repeat(mine, many)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + first[owner]
            h, g = rolling(words, w)[place], rolling(mix(words), w)[place]
            order = np.lexsort((owner, g, h))
            h, g, owner, place = h[order], g[order], owner[order], place[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            heads = np.flatnonzero(new)
            self.tables.append((w, h[heads], place[heads], np.append(heads, len(h)), owner.astype(np.int32)))

    def words(self, place: int, w: int) -> list[bytes]:
        return [self.data[self.a[q] : self.b[q]].tobytes() for q in range(place, place + w)]

    def scan(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, list[int], list[int], set]]:
        """(words, starts and ends of hits, items) of each text in a slice."""
        data = _LOWER[data]
        a, b, first = word_bounds(data, off, WORD)
        hashes = span_hashes(data, a, b)
        n = len(off) - 1
        found: list[tuple[list[int], list[int], set]] = [([], [], set()) for _ in range(n)]
        ends = first[1:]
        for w, keys, places, heads, owners in self.tables:
            h = rolling(hashes, w)
            if not len(h):
                continue
            at = np.searchsorted(keys, h)
            at[at == len(keys)] = 0
            for p in np.flatnonzero(keys[at] == h).tolist():
                d = int(np.searchsorted(ends, p, side="right"))
                if p + w > ends[d]:
                    continue
                k = int(at[p])
                here = [data[a[q] : b[q]].tobytes() for q in range(p, p + w)]
                while k < len(keys) and keys[k] == h[p]:
                    if self.words(int(places[k]), w) == here:
                        found[d][0].append(p - int(first[d]))
                        found[d][1].append(p - int(first[d]) + w)
                        found[d][2].update(owners[heads[k] : heads[k + 1]].tolist())
                    k += 1
        for d in range(n):
            starts, stops, items = found[d]
            yield int(first[d + 1] - first[d]), starts, stops, {self.names[i] for i in items}


def _table(spark: SparkSession, items: DataFrame, width: int) -> Broadcast:
    return spark.sparkContext.broadcast(Windows([(r["item"], r["text"]) for r in items.toLocalIterator()], width))


def _scan(windows: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column(1)):
                rows = list(windows.value.scan(data, off))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                        pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                        pa.array([sorted(x for x in r[3] if x is not None) for r in rows], pa.list_(pa.string())),
                    ],
                    names=["__id", "__text", "n_words", "hit_starts", "hit_ends", "items"],
                )

    return run


def _items(benchmark: DataFrame, item_col: str, item_text: str, max_windows: int) -> tuple[DataFrame, int]:
    """(item, text) of the benchmark, and the number of blocks it is taken in: a word takes two characters at least."""
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    size = bench.select(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    return bench, max(1, -(-int(size) // (2 * max_windows)))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 10, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per row: the id, text, n_words, hit_starts and hit_ends (word positions), items (sorted as strings)."""
    kind = docs.schema[id_col].dataType.simpleString()
    bench, blocks = _items(benchmark, item_col, item_text, max_windows)
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def one(part: DataFrame) -> DataFrame:
        return base.mapInArrow(_scan(_table(docs.sparkSession, part, width)), OUT.format(id=kind))

    if blocks == 1:
        found = one(bench)
    else:
        split = written(bench.withColumn("b", F.pmod(F.xxhash64("text", "item"), F.lit(blocks))), "bench")
        parts = None
        for b in range(blocks):
            p = one(split.where(F.col("b") == b)).select("__id", F.xxhash64("__text").alias("__h"), "hit_starts", "hit_ends", "items").where(F.size("hit_starts") > 0)
            p = written(p, f"hits{b}")
            parts = p if parts is None else parts.unionByName(p)
        merged = parts.groupBy("__id", "__h").agg(*[F.flatten(F.collect_set(c)).alias(c) for c in ("items",)], F.collect_set(F.struct("hit_starts", "hit_ends")).alias("hits"))
        flat = merged.select(F.col("__id").alias("__i"), F.col("__h").alias("__g"), F.flatten(F.col("hits.hit_starts")).alias("hit_starts"), F.flatten(F.col("hits.hit_ends")).alias("hit_ends"), F.array_sort(F.array_distinct("items")).alias("items"))
        count = one(bench.limit(0)).select("__id", "__text", "n_words")
        none = F.array().cast("array<int>")
        found = count.join(flat, F.col("__id").eqNullSafe(F.col("__i")) & (F.xxhash64("__text") == F.col("__g")), "left").select(
            "__id", "__text", "n_words", F.coalesce("hit_starts", none).alias("hit_starts"), F.coalesce("hit_ends", none).alias("hit_ends"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
        )
    return found.withColumnsRenamed({"__id": id_col, "__text": text_col})


def count_hits(starts: F.Column, ends: F.Column) -> F.Column:
    """Words in the union of hit spans."""
    spans = F.array_sort(F.arrays_zip(starts.alias("a"), ends.alias("b")))
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(s["b"] - F.greatest(s["a"], acc["to"]), F.lit(0))).alias("n"), F.greatest(acc["to"], s["b"]).alias("to")),
        lambda acc: acc["n"].cast("long"),
    )


def remove_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without its hit words; what lies between words stays."""
    raw = text.encode()
    low = _LOWER[np.frombuffer(raw, dtype=np.uint8)]
    a, b, _ = word_bounds(low, np.array([0, len(raw)]), WORD)
    hit = covered(np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64), len(a))
    parts, at = [], 0
    for i in np.flatnonzero(hit).tolist():
        parts.append(raw[at : a[i]])
        at = int(b[i])
    parts.append(raw[at:])
    return b"".join(parts).decode()


def _clean(windows: Broadcast, at: int, drop_share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with what is left of the text in column at, without those of which drop_share of the words or more are hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            for lo, hi, data, off in text_slices(texts):
                changed, gone = {}, []
                for i, (n, starts, ends, _) in enumerate(windows.value.scan(data, off)):
                    keep = True
                    while starts and keep:  # what is left may hold a window again
                        keep = covered(np.array(starts), np.array(ends), n).sum() < drop_share * n
                        if keep:
                            changed[i] = remove_spans(changed[i] if i in changed else texts[lo + i].as_py(), starts, ends)
                            raw = np.frombuffer(changed[i].encode(), dtype=np.uint8)
                            ((n, starts, ends, _),) = windows.value.scan(raw, np.array([0, len(raw)]))
                    if not keep:
                        gone.append(i)
                part = batch.slice(lo, hi - lo)
                if changed:
                    new = part.column(at).to_pylist()
                    for i, text in changed.items():
                        new[i] = text
                    part = part.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
                yield part.take(pa.array(np.setdiff1d(np.arange(hi - lo), gone), pa.int64())) if gone else part

    return run


def _cut(drop_share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, text without its hits); the text is null where drop_share of its words or more are hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, n, starts, ends in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                keep = covered(np.array(starts), np.array(ends), n).sum() < drop_share * n
                out.append(remove_spans(text, starts, ends) if keep else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["__id", "__text"])

    return run


def _clean_in_blocks(plain: DataFrame, text: str, bench: DataFrame, blocks: int, width: int, drop_share: float) -> DataFrame:
    """As _clean does: in each round the hits of all blocks are found on the same text before it is judged and cut."""
    split = written(bench.withColumn("b", F.pmod(F.xxhash64("text", "item"), F.lit(blocks))), "bench")
    base = written(plain.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    left, changed, turn = base.select("__id", F.col(text).alias("__text")), None, 0
    while True:
        parts = []
        for b in range(blocks):
            p = left.mapInArrow(_scan(_table(plain.sparkSession, split.where(F.col("b") == b), width)), OUT.format(id="long")).where(F.size("hit_starts") > 0)
            parts.append(written(p.select("__id", "n_words", "hit_starts", "hit_ends"), f"hits{b}"))
        hits = functools.reduce(DataFrame.unionByName, parts)
        if hits.isEmpty():
            discard(*parts)
            break
        hits = hits.groupBy("__id", "n_words").agg(F.collect_list(F.struct("hit_starts", "hit_ends")).alias("h"))
        hits = hits.select("__id", "n_words", F.flatten("h.hit_starts").alias("a"), F.flatten("h.hit_ends").alias("b"))
        cut = left.join(hits, "__id").select("__id", "__text", "n_words", "a", "b").mapInArrow(_cut(drop_share), "__id long, __text string")
        cut = written(cut.withColumn("turn", F.lit(turn)), "cut")
        discard(*parts)
        changed = cut if changed is None else changed.unionByName(cut)
        left, turn = cut.where(F.col("__text").isNotNull()).select("__id", "__text"), turn + 1  # what is left may hold a window again
    discard(split)
    if changed is None:
        return base.drop("__id")
    last = changed.groupBy("__id").agg(F.max(F.struct("turn", F.col("__text").alias("t"))).alias("last"))
    done = base.join(last, "__id", "left").where("last IS NULL OR last.t IS NOT NULL")
    return done.select(*[F.coalesce("last.t", text).alias(text) if c == text else c for c in plain.columns])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 10, drop_share: float = 0.5, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """docs without hit words; documents of which drop_share of the words or more are hit go. The columns stay."""
    bench, blocks = _items(benchmark, item_col, item_text, max_windows)
    plain = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = docs.columns.index(text_col)
    if blocks == 1:
        out = plain.mapInArrow(_clean(_table(docs.sparkSession, bench, width), at, drop_share), plain.schema)
    else:
        out = _clean_in_blocks(plain, f"__c{at}", bench, blocks, width, drop_share)
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
