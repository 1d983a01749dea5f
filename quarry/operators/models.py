"""Models as parameters, with deterministic stand-ins that need no network: embedders, generators, labellers."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T

Embedder = Callable[[list[str]], np.ndarray]
Generator = Callable[[list[str]], list[str]]


def hashed_words(dims: int = 256) -> Embedder:
    """Unit vectors of signed hashed word counts."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                out[i, h % dims] += 1 if h & 0x40000000 else -1
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)

    return embed


def embed(df: DataFrame, key: str, text: str, load: Callable[[], Embedder] = hashed_words, batch: int = 32) -> DataFrame:
    """(key, vector): load is called once a task, the embedder with batches of texts; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for b in batches:
            for lo in range(0, b.num_rows, batch):
                part = b.slice(lo, batch)
                v = model([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(v.astype(np.float32)), pa.list_(pa.float32()))], names=["key", "vector"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, vector array<float>").withColumnRenamed("key", key)


def fill(template: str, **values: Column) -> Column:
    """A template with {names} replaced by columns; a null is an empty text."""
    out = F.lit(template)
    for name, c in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return out


def first_sentence(prompts: list[str]) -> list[str]:
    """A stand-in for a language model: the first line of the prompt after its last header."""
    return [(p.rsplit("]", 1)[-1].strip().split("\n") or [""])[0][:200] for p in prompts]


def generate(df: DataFrame, key: str, prompt: Column, load: Callable[[], Generator] = lambda: first_sentence) -> DataFrame:
    """(key, answer): answers of a generator to prompts, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model([p or "" for p in b.column(1).to_pylist()]), pa.string())], names=["key", "answer"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), prompt.alias("prompt")).mapInArrow(run, f"key {kind}, answer string").withColumnRenamed("key", key)


def bootstrap_labels(sample: DataFrame, key: str, text: str, template: str, load: Callable[[], Generator] = lambda: first_sentence, limit: int = 800) -> DataFrame:
    """(key, raw_response, label) of a sample by a labeller whose answer names a class."""
    out = generate(sample, key, fill(template, text=F.substring(text, 1, limit)), load)
    return out.select(key, F.col("answer").alias("raw_response"), T.label_of(F.col("answer")).alias("label"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
