"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per language and bucket are summed over all training rows (each task adds up its own
first, so a hot source or language costs one vector a task); the log-probability matrix has a
fixed number of buckets and a row for each language, so it is broadcast, and each batch of
texts is scored in numpy by gathering matrix rows and summing them per text. A matrix holds at most
MAX_LANGUAGES; where there are more, languages are taken in blocks, one matrix after the other, and
the best language and the sum of posteriors so far go along with each text.

Characters are code points, in lower case where that is one code point too. Defined results: a null
text, or one without a letter, is `und` with score 0; with no training rows every text is `und`;
null labels are not learned; equal scores go to the language that sorts first; repeated rows count
each; texts of any length are counted and scored whole; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, text_slices, written

#: Lengths of the n-grams (in characters of the lower-cased text) and buckets they are hashed to.
ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
#: Languages of a matrix; with BUCKETS it bounds what is broadcast (64 MB).
MAX_LANGUAGES = 512
#: Matrix rows times languages that are gathered at once.
CELLS = 1 << 22
_PRIME, _STEP = np.uint32(16777619), np.uint32(2654435761)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The lower case of the first 65,536 code points, and whether they are letters."""
    chars = [chr(i) for i in range(1 << 16)]
    lower = [ord(low) if len(low := c.lower()) == 1 else ord(c) for c in chars]
    return np.array(lower, dtype=np.uint32), np.array([c.isalpha() for c in chars])


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice, and offsets of texts in them."""
    raw = data.tobytes()
    if raw.isascii():
        return data.astype(np.uint32), off
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32), heads[off]


def grams(points: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, inside) of the n-grams of each order that start at each character; inside: they lie in one text."""
    lower, _ = _tables()
    low = np.where(points < len(lower), lower[np.minimum(points, len(lower) - 1)], points).astype(np.uint32)
    n = len(low)
    room = np.repeat(off[1:], np.diff(off)) - np.arange(n)
    code = low.copy()
    with np.errstate(over="ignore"):
        for k in range(1, max(ORDERS)):
            code = code * _PRIME ^ np.concatenate([low[k:], np.zeros(min(k, n), np.uint32)])[:n]
            if k + 1 in ORDERS:
                yield (((code + np.uint32(k)) * _STEP) >> np.uint32(17)).astype(np.int32), room > k


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            ids = np.concatenate([[-1], at])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids)), pa.array(ids, pa.int32()), pa.array(np.concatenate([[docs[lang]], v[at]]), pa.int64())], names=["lang", "bucket", "n"])
        sums.clear()
        docs.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lo, hi, data, off in text_slices(batch.column(1)):
            names, ids = np.unique(np.array(langs[lo:hi], dtype=object).astype(str), return_inverse=True)
            points, off = characters(data, off)
            for lang, k in zip(names.tolist(), np.bincount(ids).tolist(), strict=True):
                docs[lang] = docs.get(lang, 0) + k
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, dtype=np.int64)
            owner = np.repeat(ids, np.diff(off))
            for bucket, inside in grams(points, off):
                for i, lang in enumerate(names.tolist()):
                    sums[lang] += np.bincount(bucket[inside & (owner == i)] if len(names) > 1 else bucket[inside], minlength=BUCKETS)
            if len(sums) > MAX_LANGUAGES // 4:
                yield from out()
    yield from out()


@dataclass
class Model:
    """Some of the languages: names in order, log probabilities (buckets × languages), log priors among all."""

    langs: list[str]
    matrix: np.ndarray
    prior: np.ndarray

    def score(self, points: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Log posteriors (up to a constant) of each text in a slice."""
        total = np.zeros((len(off) - 1, len(self.langs)))
        step = max(1, CELLS // len(self.langs))
        for bucket, inside in grams(points, off):
            for lo in range(0, len(bucket), step):
                part = self.matrix[bucket[lo : lo + step]]
                part[~inside[lo : lo + step]] = 0
                one = int(np.searchsorted(off, lo, side="right")) - 1
                cuts = off[one : int(np.searchsorted(off, lo + len(part), side="left"))]
                texts = np.arange(one, one + len(cuts))
                full = np.append(np.diff(cuts), 1) > 0
                total[texts[full]] += np.add.reduceat(part, np.maximum(cuts[full] - lo, 0), axis=0, dtype=np.float64)
        return total + self.prior


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> list[Model]:
    """Counts over all rows with a label and a text; a model for each MAX_LANGUAGES languages, in their order."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sums = written(rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    docs = {r["lang"]: r["n"] for r in sums.where("bucket = -1").toLocalIterator()}
    langs, models = sorted(docs), []
    for i in range(0, len(langs), MAX_LANGUAGES):
        some = langs[i : i + MAX_LANGUAGES]
        mine = sums.where(F.col("lang").between(some[0], some[-1]) & (F.col("bucket") >= 0)) if len(langs) > MAX_LANGUAGES else sums.where("bucket >= 0")
        got = mine.toArrow().combine_chunks()
        names = pa.array(some)
        counts = np.full((BUCKETS, len(some)), smoothing)
        counts[got.column("bucket").to_numpy(), pc.index_in(got.column("lang"), names).to_numpy()] += got.column("n").to_numpy()
        matrix = (np.log(counts) - np.log(counts.sum(axis=0))).astype(np.float32)
        prior = np.array([docs[x] for x in some])
        models.append(Model(some, matrix, np.log(prior / sum(docs.values()))))
    discard(sums)
    return models


def _predict(model, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One more block of languages: (id, text, best language so far, its log posterior, log of the sum of posteriors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        _, letter = _tables()
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column(1)):
                before = batch.slice(lo, hi - lo)
                points, off = characters(data, off)
                s = m.score(points, off)
                here = s.argmax(axis=1)
                top = s[np.arange(len(s)), here]
                total = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
                had, most, mass = before.column(2).to_pylist(), before.column(3).to_numpy(), before.column(4).to_numpy()
                lang = [m.langs[k] if new else old for k, new, old in zip(here.tolist(), (top > most).tolist(), had, strict=True)]
                most, mass = np.maximum(top, most), np.logaddexp(mass, total)
                if not last:
                    yield pa.RecordBatch.from_arrays([before.column(0), before.column(1), pa.array(lang, pa.string()), pa.array(most), pa.array(mass)], names=["__id", "__text", "__lang", "__most", "__mass"])
                    continue
                is_letter = np.where(points < len(letter), letter[np.minimum(points, len(letter) - 1)], False)
                for i in np.flatnonzero(points >= len(letter)).tolist():
                    is_letter[i] = chr(points[i]).isalpha()
                seen = np.concatenate([[0], np.cumsum(is_letter)])
                some = seen[off[1:]] > seen[off[:-1]]
                lang = [x if ok else "und" for x, ok in zip(lang, some.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([before.column(0), pa.array(lang, pa.string()), pa.array(np.where(some, np.exp(most - mass), 0.0))], names=["__id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, models: list[Model], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, lang_pred, score."""
    kind = docs.schema[id_col].dataType.simpleString()
    if not models:
        return docs.select(F.col(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    none = F.lit(float("-inf"))
    out = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.lit(None).cast("string").alias("__lang"), none.alias("__most"), none.alias("__mass"))
    for i, m in enumerate(models):
        last = i == len(models) - 1
        sent = docs.sparkSession.sparkContext.broadcast(m)
        out = out.mapInArrow(_predict(sent, last), f"__id {kind}, lang_pred string, score double" if last else f"__id {kind}, __text string, __lang string, __most double, __mass double")
    return out.withColumnRenamed("__id", id_col)


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(0))
