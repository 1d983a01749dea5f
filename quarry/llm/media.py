"""Media columns: bytes stored as lossless WebP images, read back as pixel arrays.

A payload is an opaque gray image 192 pixels wide, one byte a pixel; a payload of more rows than
an image can have becomes several files one after the other. The encoder chooses transforms for each
image: a palette, a predictor, or the subtraction of green alone. Reading decodes the stored bytes
with the full decoder and works out features of the pixels.

Defined results: a null or empty text is one row of spaces; equal texts get equal bytes; a null
or broken media value reads as null pixels and features with the reason in `error`; null ids and
repeated rows are carried; texts of any length are stored whole; an empty table gives no rows; extra
columns are carried where named and otherwise ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import webp

WIDTH, MAX_ROWS = 192, 16384


def payload(text: Column) -> Column:
    """The UTF-8 bytes of a text, and spaces up to a positive multiple of 192 bytes."""
    raw = F.coalesce(text, F.lit(""))
    size = F.octet_length(raw)
    want = F.greatest(F.ceil(size / WIDTH) * WIDTH, F.lit(WIDTH)).cast("int")
    return F.concat(raw, F.repeat(F.lit(" "), want - size)).cast("binary")


def to_media(data: bytes) -> bytes:
    gray = np.frombuffer(data, dtype=np.uint8).reshape(-1, WIDTH)
    return b"".join(webp.encode_best(gray[i : i + MAX_ROWS]) for i in range(0, len(gray), MAX_ROWS))


def from_media(data: bytes) -> np.ndarray:
    """The gray pixels of all files in data, row under row."""
    images = [webp.decode_chunk(c) for c in webp.files(data)]
    if len({x.shape[1] for x in images}) > 1:
        raise webp.WebPError("images of several widths")
    return ((np.concatenate(images) >> np.uint32(8)) & np.uint32(255)).astype(np.uint8)


def features(pixels: np.ndarray) -> str:
    """Size, mean and deviation, and a hash of 64 bits: which of 8 × 8 cells are brighter than the mean cell."""
    h, w = pixels.shape
    rows = np.add.reduceat(pixels.astype(np.int64), np.arange(8) * w // 8, axis=1)
    edge = np.arange(9) * h // 8
    sums = np.concatenate([np.zeros((1, 8), dtype=np.int64), np.cumsum(rows, axis=0)])
    lo, hi = edge[:-1], np.maximum(edge[1:], edge[:-1] + 1)
    cells = (sums[np.minimum(hi, h)] - sums[np.minimum(lo, h - 1)]) / (np.minimum(hi, h) - np.minimum(lo, h - 1))[:, None]
    mark = int("".join("1" if x else "0" for x in (cells > cells.mean()).ravel()), 2)
    return f"{w}x{h};{pixels.mean():.4f};{pixels.std():.4f};{mark:016x}"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            out = [to_media(x) for x in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, pa.binary())], names=[*batch.schema.names[:-1], "__media"])


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            raw, width, seen, error = [], [], [], []
            for data in part.column(part.num_columns - 1).to_pylist():
                try:
                    px = from_media(data) if data is not None else None
                    why = None if data is not None else "null"
                except webp.WebPError as e:
                    px, why = None, str(e)
                raw.append(None if px is None else px.tobytes())
                width.append(None if px is None else px.shape[1])
                seen.append(None if px is None else features(px))
                error.append(why)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(raw, pa.binary()), pa.array(width, pa.int32()), pa.array(seen, pa.string()), pa.array(error, pa.string())],
                names=[*batch.schema.names, "__pixels", "__width", "__feature", "__error"],
            )


def _mapped(df: DataFrame, keep: list[str], last: Column, step, more: str) -> DataFrame:
    kinds = ", ".join(f"__c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return df.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(keep)], last).mapInArrow(step, f"{kinds}, {more}")


def store(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns named by keep, and media."""
    out = _mapped(docs, keep, payload(F.col(text_col)).alias("__payload"), _encode, "__media binary")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(keep)], F.col("__media").alias("media"))


def read_back(stored: DataFrame, keep: list[str], media_col: str = "media") -> DataFrame:
    """The columns named by keep, and media, pixels (rows of bytes), width, feature, error."""
    out = _mapped(stored, keep, F.col(media_col).alias("__media"), _decode, "__media binary, __pixels binary, __width int, __feature string, __error string")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"__{c}").alias(c) for c in ("media", "pixels", "width", "feature", "error")])
