"""Near-duplicate classes: ProbMinHash signatures of weighted shingles, banding, exact verification.

Shingles are runs of five words (a shorter text is one shingle), weighted by how often a document
has them. Each shingle is a Poisson process of arrivals with its weight as rate and a random
component for each arrival; a component keeps the shingle that arrives first. A shingle stops as
soon as its next arrival is later than the latest first arrival of all components. Equal components
estimate the probability Jaccard similarity; bands of components make buckets. A text that repeats
shingles is banded twice, with its weights and with weights of one: the latter estimate the Jaccard
similarity of the sets, by which links are verified.

Copies of a text share one signature, so they are one candidate. Buckets with the same members
are taken once. A bucket of up to `block` texts is compared within one task, all against all on
sets of shingle hashes (without emitting pairs: only links that join two parts of it leave). A
larger bucket is dealt into blocks of that size, anew in each band, and its most central texts
(those that share most buckets) join every block. That finds most classes in linear time; what it
leaves out is found exactly: two similar sets share one of their rarest shingles (prefix filter), so
texts of larger buckets are grouped by these, groups within one class are dropped, and the rest are
compared all against all, large groups as tasks of two blocks each.
Links are closed to classes by alternating large-star and small-star steps on written tables.

Similarity for verification is the Jaccard index of the sets of shingles (32-bit hashes), 0.8 or
more. Bands are set for a recall above 0.9999 at that similarity, and each pair of a bucket, however
large, that is similar enough ends in one class.

Defined results: null and empty texts have no shingles and form one class as copies of each other;
null ids are carried and never name a class unless no member has an id (then it is null); repeated
rows, and different texts under one id, are members each; very long texts are compared whole; an
empty table gives no rows; extra columns are ignored (`keep_one` carries them).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import byte_class, discard, mix, rolling, runs_hashes, span_hashes, spread_join, text_slices, word_bounds, written

SHINGLE, BANDS, ROWS, BLOCK, CENTRES = 5, 25, 5, 256, 4
#: Cells of the table of shingle counts by which rare ones are told (any order of shingles gives the same links).
CELLS = 1 << 18
_WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of the distinct shingles of a slice, by text and hash."""
    data = _LOWER[data]
    a, b, first = word_bounds(data, off, _WORD)
    words = span_hashes(data, a, b)
    n = np.diff(first)
    h = rolling(words, SHINGLE)
    doc = np.repeat(np.arange(len(n)), n)[: len(h)]
    inside = np.arange(len(h)) + SHINGLE <= first[1:][doc]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    h = np.concatenate([h[inside], runs_hashes(words, first[short], first[short + 1])])
    doc = np.concatenate([doc[inside], short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def prob_minhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, size: int) -> np.ndarray:
    """Signatures (docs × size) of weighted elements; those of a document without elements are 0."""
    first = np.full(docs * size, np.inf)
    sig = np.zeros(docs * size, dtype=np.uint64)
    at, rate, t, step = doc, weight.astype(np.float64), np.zeros(len(h)), np.uint64(0)
    with np.errstate(over="ignore"):
        while len(h):
            step += np.uint64(1)
            draw = mix(h + step * _GOLD)
            t = t - np.log(((draw >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) / rate
            slot = at * size + (mix(draw ^ _GOLD) % np.uint64(size)).astype(np.int64)
            better = t < first[slot]
            s, v, e = slot[better], t[better], h[better]
            np.minimum.at(first, s, v)
            won = v == first[s]
            sig[s[won]] = e[won]
            latest = first.reshape(docs, size).max(axis=1)
            go = t < latest[at]
            if not go.all():
                at, rate, t, h = at[go], rate[go], t[go], h[go]
    return sig.reshape(docs, size)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A key for each band of a signature."""
    with np.errstate(over="ignore"):
        parts = mix(sig[:, : BANDS * ROWS] + np.tile(np.arange(1, ROWS + 1, dtype=np.uint64) * _GOLD, BANDS)).reshape(len(sig), BANDS, ROWS)
        return mix(parts.sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, off in text_slices(batch.column(1)):
            doc, h, w = shingles(data, off)
            n = hi - lo
            keys = band_keys(prob_minhash(doc, h, np.ones(len(w)), n, BANDS * ROWS)).view(np.int64)
            some, again = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
            some[doc] = True
            again[doc[w > 1]] = True  # for others the signature with weights is the same
            of = again[doc]
            number = np.cumsum(again) - 1
            weighted = band_keys(prob_minhash(number[doc[of]], h[of], w[of], int(again.sum()), BANDS * ROWS)).view(np.int64) if of.any() else keys[:0]
            more = (weighted != keys[again]).ravel()
            owner = np.concatenate([np.repeat(np.flatnonzero(some), BANDS), np.repeat(np.flatnonzero(again), BANDS)[more]])
            flat = np.concatenate([keys[some].ravel(), weighted.ravel()[more]])[np.argsort(owner, kind="stable")]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], names=["t", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, off in text_slices(batch.column(1)):
            doc, h, _ = shingles(data, off)
            ends = np.searchsorted(doc, np.arange(hi - lo + 1))
            small = (h >> np.uint64(32)).astype(np.uint32)  # in order, as the hashes are
            sets = [np.unique(small[a:b]).tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["t", "s"])


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each two sets share."""
    if len(sets) == 2:
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]])
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, element, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = many[element] > 1
    element, owner = element[both], owner[both]
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    element = np.cumsum(np.concatenate([[0], np.diff(element) > 0])) if len(element) else element
    counts = np.zeros((len(sets), len(sets)))
    for lo in range(0, int(element[-1]) + 1 if len(element) else 0, width):
        a, b = np.searchsorted(element, [lo, lo + width])
        x = np.zeros((len(sets), width), dtype=np.float32)
        x[owner[a:b], element[a:b] - lo] = 1
        counts += x @ x.T
    counts[np.diag_indices(len(sets))] = size
    return counts.astype(np.int64)


def parts(links: np.ndarray) -> np.ndarray:
    """The smallest index of the connected part of each, by a matrix of links."""
    label = np.arange(len(links))
    while True:
        new = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _link(similarity: float) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        ts, at = np.unique(group.column("t").to_numpy(), return_index=True)
        raw = group.column("s")
        sets = [np.frombuffer(raw[i].as_py(), dtype=np.uint32) for i in at.tolist()]
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if len(ts) < 2:
            return empty
        n = shared_counts(sets)
        size = n.diagonal()
        label = parts(n >= similarity * (size[:, None] + size[None, :] - n) - 1e-9)
        moved = label != np.arange(len(ts))
        return pa.table({"a": pa.array(ts[moved]), "b": pa.array(ts[label[moved]])}) if moved.any() else empty

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        s = np.frombuffer(b"".join(batch.column("s").to_pylist()), dtype=np.uint32)
        counts += np.bincount(s % CELLS, minlength=CELLS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["cell", "c"])


def _rarest(counts: np.ndarray, similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The shingles of each set of which two similar sets share one: all but the share they must have in common, and one more, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch.column("s").to_pylist():
                s = np.frombuffer(raw, dtype=np.uint32)
                found.append(s[np.lexsort((s, counts[s % CELLS]))][: len(s) - int(np.ceil(similarity * len(s) - 1e-6)) + 1])
            each = np.repeat(np.arange(len(found)), [len(x) for x in found])
            k = np.concatenate(found).astype(np.int64) if found else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k), batch.column("t").take(pa.array(each)), batch.column("root").take(pa.array(each))], names=["k", "t", "root"])

    return run


def _missed(wide: DataFrame, sets: DataFrame, labels: DataFrame, similarity: float, block: int) -> DataFrame:
    """Links between texts of wide that labels (t, root) hold apart, each similar pair linked or joined by others."""
    held = spread_join(sets, wide.select("t").distinct(), ["t"])
    held = written(spread_join(held, labels, ["t"], "left").select("t", "s", F.coalesce("root", "t").alias("root")), "wide")
    counts = np.zeros(CELLS, dtype=np.int64)
    for r in held.select("s").mapInArrow(_cells, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).toLocalIterator():
        counts[r["cell"]] = r["c"]
    rare = written(held.select("t", "root", "s").mapInArrow(_rarest(counts, similarity), "k long, t long, root long"), "rarest")
    groups = rare.groupBy("k").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("t")).alias("x"), F.min("t").alias("u"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    groups = groups.groupBy("n", "x", "u").agg(F.min("k").alias("k")).select("k", "n")
    size = block
    blocks = F.ceil(F.col("n") / size).cast("int")
    dealt = spread_join(rare.select("k", "t"), groups, ["k"]).select("k", "t", blocks.alias("of"), F.pmod(F.xxhash64("t", "k"), blocks).cast("int").alias("i"))
    others = F.when(F.col("of") > 1, F.filter(F.sequence(F.lit(0), F.col("of") - 1), lambda j: j != F.col("i"))).otherwise(F.array(F.lit(0)))
    dealt = dealt.select("k", "t", "of", "i", F.explode(others).alias("j"))
    dealt = dealt.select("k", (F.least("i", "j").cast("long") * F.col("of") + F.greatest("i", "j")).alias("salt"), "t")
    return spread_join(dealt, sets, ["t"]).groupBy("k", "salt").applyInArrow(_link(similarity), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that isn't its part's smallest, and that smallest; edges: (a, b) with b smaller."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = spread_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, least, ["a"]).select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        last, edges = edges, written(small.where("a <> b").distinct(), "edges")
        discard(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).select("__id", F.xxhash64("__text").alias("t"), "__text")


def _roots(docs: DataFrame, id_col: str, text_col: str, similarity: float, block: int) -> DataFrame:
    """Per distinct text: t (its hash), rep (the smallest id), n (rows), root (the t that names its class); a written table."""
    base = _texts(docs, id_col, text_col)
    signed = written(base.select("t", "__text").mapInArrow(_signatures, "t long, keys array<long>").groupBy("t").agg(F.first("keys").alias("keys")), "signatures")
    bands = signed.select("t", F.explode("keys").alias("k"))
    buckets = bands.groupBy("k").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("t")).alias("x"), F.min("t").alias("u")).where(F.col("n") > 1)
    buckets = buckets.groupBy("n", "x", "u").agg(F.min("k").alias("k")).select("k", "n")
    members = written(spread_join(bands, buckets, ["k"]).select("k", "t", "n"), "members")
    central = members.groupBy("t").agg(F.sum("n").alias("c"))
    wide = members.where(F.col("n") > block)
    centres = spread_join(wide, central, ["t"]).groupBy("k", "n", F.pmod(F.xxhash64("t"), F.lit(CENTRES)).alias("part")).agg(F.max(F.struct("c", "t")).alias("best"))
    salts = F.ceil(F.col("n") / block).cast("int")
    dealt = members.select("k", F.when(F.col("n") > block, F.pmod(F.xxhash64("t", "k"), salts)).otherwise(F.lit(0)).cast("int").alias("salt"), "t")
    dealt = dealt.unionByName(centres.select("k", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("best.t").alias("t")))
    held = written(base.select("__id", "t").groupBy("t").agg(F.min("__id").alias("rep"), F.count("*").alias("n")), "texts")
    # One row of each text: that with the smallest id, so that copies don't meet in a task. A merge join at every size, as the candidates grow with the input.
    wanted = held.join(members.select("t").distinct(), "t", "left_semi").select(F.col("t").alias("u"), "rep")
    texts = base.join(wanted.hint("merge"), (F.col("t") == F.col("u")) & F.col("__id").eqNullSafe(F.col("rep"))).groupBy("t").agg(F.first("__text").alias("__text"))
    sets = written(texts.mapInArrow(_sets, "t long, s binary"), "sets")
    links = spread_join(dealt, sets, ["t"]).groupBy("k", "salt").applyInArrow(_link(similarity), "a long, b long")
    labels = components(links).withColumnsRenamed({"a": "t", "b": "root"})
    if not wide.isEmpty():
        more = _missed(wide, sets, labels, similarity, block)
        labels = components(labels.select(F.col("t").alias("a"), F.col("root").alias("b")).unionByName(more)).withColumnsRenamed({"a": "t", "b": "root"})
    out = written(held.join(labels, "t", "left").select("t", "rep", "n", F.coalesce("root", "t").alias("root")), "roots")
    discard(signed, members, held, sets)
    return out


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """Per row: the id, class_id (the smallest id of its class), class_size (rows)."""
    held = _roots(docs, id_col, text_col, similarity, block)
    classes = held.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"))
    of = written(spread_join(held.select("t", "root"), classes, ["root"]).select("t", "class_id", "class_size"), "classes")
    discard(held)
    return spread_join(_texts(docs, id_col, text_col).select("__id", "t"), of, ["t"]).select(F.col("__id").alias(id_col), "class_id", "class_size")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """One row of each class: the one with the smallest id (of texts with that id the one with the smallest hash; of equal rows one).

    Rows without an id stay. Different texts under one id are rows of their own classes.
    """
    held = _roots(docs, id_col, text_col, similarity, block)
    best = held.where(F.col("rep").isNotNull()).groupBy("root").agg(F.min(F.struct("rep", "t")).alias("b"))
    best = written(best.select(F.col("b.rep").alias("__b_id"), F.col("b.t").alias("__b_t")), "best")
    discard(held)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col(id_col).alias("__id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__t"))
    kept = rows.join(best, (F.col("__id") == F.col("__b_id")) & (F.col("__t") == F.col("__b_t")), "left_semi").dropDuplicates(["__id", "__t"])
    kept = kept.unionByName(rows.where(F.col("__id").isNull()))
    return kept.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
