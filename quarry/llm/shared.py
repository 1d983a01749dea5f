"""What several operators of this subpackage use: written tables, byte views of texts, hashes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in slices of so many bytes; one longer text is a slice of its own.
SLICE_BYTES = 2_000_000
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: that in spark.checkpoint.dir.

    Where a local session names none (tests), one of our own, removed at exit; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="quarry-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/quarry/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._quarry_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that written() made; for those that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df._quarry_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def unlike(name: str, columns: list[str]) -> str:
    """name, or a longer one that no column has (whatever the case)."""
    have = {c.lower() for c in columns}
    while name.lower() in have:
        name += "_"
    return name


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on integer keys whose hot values must not share a task.

    right is usually an aggregate by the same keys. Joining on a bijection of the first key
    gives both sides an exchange of their own, which adaptive execution may split when skewed.
    """
    other = right
    cond = None
    for i, k in enumerate(keys):
        other = other.withColumn(f"__r{i}", F.col(k).bitwiseXOR(F.lit(1)) if i == 0 else F.col(k)).drop(k)
        on = (F.col(k).bitwiseXOR(F.lit(1)) if i == 0 else F.col(k)) == F.col(f"__r{i}")
        cond = on if cond is None else cond & on
    return left.join(other, cond, how).drop(*[f"__r{i}" for i in range(len(keys))])


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _M1
        x ^= x >> np.uint64(27)
        x *= _M2
        x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BASE = 0x9FB21C651E98DF25 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n, or those of its inverse."""
    key = "inverse" if inverse else "plain"
    have = _POW.get(key)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        steps = np.full(size, _INV if inverse else _BASE, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            have = _POW[key] = np.multiply.accumulate(steps)
    return have[:n]


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of rows in them) of runs of rows; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true for the bytes in the (closed) ranges."""
    table = np.zeros(256, dtype=bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


def word_bounds(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes of a class inside one text), and the first word of each text (one more at the end)."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(off), dtype=np.int64)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = is_word[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    cuts = off[(off > 0) & (off < n)]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    stops = inside[:n] & ~inside[1:]
    before = cuts - 1
    stops[before] = inside[before]
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by prefix sums."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(table[data] * powers(len(data)), out=sums[1:])
        h = (sums[ends] - sums[starts]) * powers(len(data) + 1, inverse=True)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _GOLD)


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of width word hashes; runs are by position, whatever text they lie in."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * powers(len(words)), out=sums[1:])
        return mix((sums[width:] - sums[:n]) * powers(n, inverse=True))


def runs_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the word hashes from starts to ends."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * powers(len(words)), out=sums[1:])
        h = (sums[ends] - sums[starts]) * powers(len(words) + 1, inverse=True)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _GOLD)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; Python workers are told where this package lies, if nothing else does."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
