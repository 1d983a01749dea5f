"""Document quality: a linear-chain conditional random field labels every line good or bad.

Each line has features of its own and of its neighbours; the chain's forward-backward marginals
of "good", weighted by line length, average to the document's score, which a logistic map fitted
on the training documents calibrates. A training document's label holds for all its lines.

Fitting uses a bounded sample: the max_documents labelled rows with the smallest hash of their id,
without those of more than max_breaks line breaks (features, not texts, reach the driver), in
stretches of at most SEGMENT lines. Scoring covers every line of every text, however long, in one
pass without a shuffle.

Defined results: a null or empty text is one empty line and gets that line's score; with labels
of one kind only, or none, every score is 0.5 or the share of good labels; null labels are not
learned; several labels of one id count as their smallest; repeated rows are scored, and learned
from, once each; null ids are scored; an empty table gives no rows; extra columns are carried or
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import byte_class, span_hashes, text_slices, word_bounds

#: Labelled documents that are learned from at most.
MAX_DOCUMENTS = 3000
#: Line breaks of a document that is learned from at most; with MAX_DOCUMENTS it bounds what reaches the driver.
MAX_BREAKS = 1000
#: Lines of a training stretch.
SEGMENT = 64
_NOT_SPACE = ~byte_class((32, 32), (9, 13))
_CLASSES = np.stack(
    [
        byte_class((65, 90)),  # upper case
        byte_class((97, 122)),  # lower case
        byte_class((48, 57)),  # digits
        byte_class((33, 33), (63, 63)),  # ! and ?
        byte_class((35, 38), (42, 43), (47, 47), (60, 62), (64, 64), (91, 96), (123, 126)),  # symbols
        byte_class((128, 255)),
        byte_class((44, 44), (46, 46)),
    ]
)


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of the lines of a slice, their lengths, first line of each text and one more)."""
    n = len(data)
    cuts = np.flatnonzero(data == 10)
    owner = np.searchsorted(off, cuts, side="right") - 1
    starts = np.sort(np.concatenate([off[:-1], cuts + 1]), kind="stable")
    first = np.arange(len(off)) + np.concatenate([np.searchsorted(cuts, off[:-1]), [len(cuts)]])
    ends = np.concatenate([starts[1:] - 1, [n]])
    last = first[1:] - 1
    ends[last] = off[1:]
    assert len(owner) + len(off) - 1 == len(starts)
    size = (ends - starts).astype(np.float64)
    per = np.maximum(size, 1)
    cols = []
    for c in _CLASSES:
        sums = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(c[data], out=sums[1:])
        cols.append((sums[ends] - sums[starts]) / per)
    a, b, _ = word_bounds(data, np.unique(np.concatenate([starts, ends, [0, n]])), _NOT_SPACE)
    h = span_hashes(data, a, b)
    w0, w1 = np.searchsorted(a, starts), np.searchsorted(a, ends)
    words = np.maximum(w1 - w0, 1)
    for gap in (1, 2):
        again = np.zeros(len(h) + 1, dtype=np.int64)
        if len(h) > gap:
            np.cumsum(h[gap:] == h[:-gap], out=again[gap + 1 :])
        again_in = again[w1] - again[np.minimum(w0 + gap, w1)]
        cols.append(again_in / words)
    long = np.zeros(len(a) + 1)
    np.cumsum(b - a, out=long[1:])
    mean = (long[w1] - long[w0]) / words
    bang = np.zeros(len(a) + 1, dtype=np.int64)
    if len(a):
        tail = data[b - 1]
        np.cumsum((tail == 33) | _CLASSES[4][tail], out=bang[1:])
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    key = span_hashes(data, starts, ends) ^ (doc.astype(np.uint64) << np.uint64(40))
    _, at, many = np.unique(key, return_inverse=True, return_counts=True)
    cols += [
        np.log1p(size) / 5,
        np.log1p(words) / 3,
        mean / 10,
        (mean > 12).astype(float),
        (bang[w1] - bang[w0]) / words,
        np.minimum(np.log1p(many[at] - 1), 3) * (size > 0),
        (size == 0).astype(float),
        (words < 3).astype(float),
        np.log1p(np.repeat(np.diff(first), np.diff(first))) / 5,
    ]
    return np.stack(cols, axis=1), size + 1, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each line, of the one before and of the one after (zeros at the ends), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    edge = np.zeros((len(x), 3))
    edge[first[:-1], 0] = 1
    edge[first[1:] - 1, 1] = 1
    edge[:, 2] = 1
    return np.concatenate([x, before, after, edge], axis=1)


def _order(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences by falling length, and how many are longer than t for each t."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    return order, np.searchsorted(-n[order], -np.arange(int(n.max(initial=0))), side="left")


def marginals(good: np.ndarray, trans: np.ndarray, first: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By forward-backward: P(good) of each line, P(pair of labels) summed over all places, log partition of each sequence.

    good: score of "good" over "bad" for each line. trans: 2 × 2 scores of label pairs.
    weight: of each line, for the sum over pairs (none: no pairs are wanted).
    """
    m = len(good)
    e = np.stack([np.zeros(m), good], axis=1)
    order, active = _order(first)
    begin = first[:-1][order]
    alpha, beta = np.zeros((m, 2)), np.zeros((m, 2))
    alpha[begin] = e[begin]
    for t in range(1, len(active)):
        at = begin[: active[t]] + t
        prev = alpha[at - 1]
        alpha[at] = np.logaddexp(prev[:, :1] + trans[0], prev[:, 1:] + trans[1]) + e[at]
    for t in range(len(active) - 1, 0, -1):
        at = begin[: active[t]] + t
        nxt = beta[at] + e[at]
        beta[at - 1] = np.logaddexp(nxt[:, :1] + trans[:, 0], nxt[:, 1:] + trans[:, 1])
    z = np.logaddexp(alpha[first[1:] - 1, 0], alpha[first[1:] - 1, 1])
    zs = np.repeat(z, np.diff(first))
    p = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - zs, 0))
    if weight is None:
        return p, np.zeros((2, 2)), z
    inner = np.ones(m, dtype=bool)
    inner[first[1:] - 1] = False
    i = np.flatnonzero(inner)
    pairs = np.exp(alpha[i][:, :, None] + trans[None] + (e[i + 1] + beta[i + 1])[:, None, :] - zs[i][:, None, None])
    pairs = np.einsum("i,ijk->jk", weight[i], pairs)
    return p, pairs, z


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    calibration: tuple[float, float]
    constant: float | None = None

    def raw(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals of each text."""
        full = with_neighbours((x - self.mean) / self.scale, first)
        p, _, _ = marginals(full @ self.weights, self.trans, first)
        return np.add.reduceat(p * size, first[:-1]) / np.add.reduceat(size, first[:-1])

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(off) - 1, self.constant)
        a, b = self.calibration
        return 1 / (1 + np.exp(-(a * _logit(self.raw(*line_features(data, off))) + b)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], l2: float = 1e-3, steps: int = 60, rate: float = 0.2) -> Model:
    """From (features, lengths, label) of documents, by Adam on the conditional log-likelihood per line."""
    labels = np.array([q for _, _, q in docs])
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(0), np.zeros((2, 2)), np.zeros(0), np.ones(0), (1.0, 0.0), float(labels.mean()) if len(labels) else 0.5)
    x = np.concatenate([f for f, _, _ in docs])
    size = np.concatenate([s for _, s, _ in docs])
    count = np.array([len(f) for f, _, _ in docs])
    first = np.concatenate([[0], np.cumsum(count)])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    full = with_neighbours((x - mean) / scale, first)
    y = np.repeat(labels, count).astype(float)
    within = np.arange(len(x)) - np.repeat(first[:-1], count)
    cut = np.append(np.flatnonzero(within % SEGMENT == 0), len(x))
    share = np.repeat(1 / np.minimum(count, SEGMENT), count)  # a document counts about once, whatever its length
    weight = share / share.sum()
    w, trans = np.zeros(full.shape[1]), np.zeros((2, 2))
    mom = [np.zeros_like(w), np.zeros_like(trans)]
    var = [np.zeros_like(w), np.zeros_like(trans)]
    inner = np.ones(len(x), dtype=bool)
    inner[cut[1:] - 1] = False
    seen = np.diag([weight[inner & (y == k)].sum() for k in (0, 1)])
    for step in range(1, steps + 1):
        p, pairs, _ = marginals(full @ w, trans, cut, weight)
        grads = [full.T @ ((y - p) * weight) - l2 * w, seen - pairs - l2 * trans]
        for k, (v, g) in enumerate(zip((w, trans), grads, strict=True)):
            mom[k] = 0.9 * mom[k] + 0.1 * g
            var[k] = 0.99 * var[k] + 0.01 * g * g
            v += rate * (1 - step / steps / 1.1) * (mom[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.99**step)) + 1e-8)
        np.clip(trans, -3, 3, out=trans)
    model = Model(w, trans, mean, scale, (1.0, 0.0))
    s = _logit(model.raw(x, size, first))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic fit, lightly held near 1
        q = 1 / (1 + np.exp(-(a * s + b)))
        r, h = labels - q, q * (1 - q) + 1e-9
        g = np.array([(r * s).sum() - 0.1 * (a - 1), r.sum()])
        m = np.array([[(h * s * s).sum() + 0.1, (h * s).sum()], [(h * s).sum(), h.sum()]])
        d = np.linalg.solve(m, g)
        a, b = a + float(d[0]), b + float(d[1])
        if abs(d).max() < 1e-6:
            break
    model.calibration = (max(a, 0.05), b)
    return model


def _features(max_breaks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column(1)):
                x, size, first = line_features(data, off)
                both = np.concatenate([x, size[:, None]], axis=1).astype(np.float32)
                some = np.flatnonzero(np.diff(first) <= max_breaks + 1)
                blobs = [both[first[i] : first[i + 1]].tobytes() for i in some.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(some)), pa.array(blobs, pa.binary())], names=["label", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_documents: int = MAX_DOCUMENTS, max_breaks: int = MAX_BREAKS) -> Model:
    """labels: (id, label 0 or 1); those that are to be learned from only."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).cast("int").alias("__y"))
    some = known.orderBy(F.xxhash64("__id"), "__id").limit(max_documents)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(some), "__id").select("__y", "__text")
    got = rows.mapInArrow(_features(max_breaks), "label int, x binary").toArrow()
    width = len(_CLASSES) + 11
    parsed = []
    for y, blob in sorted(zip(got.column("label").to_pylist(), got.column("x").to_pylist(), strict=True)):
        m = np.frombuffer(blob, dtype=np.float32).reshape(-1, width + 1).astype(np.float64)
        parsed.append((m[:, :-1], m[:, -1], int(y)))
    return train(parsed)


def _score(model, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(m.score(data, off), pa.float64())], names=[*batch.schema.names, "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "__score") -> DataFrame:
    """The columns named by keep (all by default), and the score, under a name that none of them has."""
    keep = list(keep if keep is not None else docs.columns)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    cols = keep if text_col in keep else [*keep, text_col]  # the text crosses over once
    plain = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(cols)])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    out = plain.mapInArrow(_score(sent, cols.index(text_col)), f"{kinds}, __score double")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(keep)], F.col("__score").alias(name))
