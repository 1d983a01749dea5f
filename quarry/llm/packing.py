"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are tokenized where they are read; a document longer than a sequence is cut into full
pieces and a rest, so a piece's checksum is known before packing and only (id, start, length,
checksum) is shuffled. Documents fall into randomised groups of about group_docs by a hash of
content, partition and how often the partition has had that content (so copies spread, and a task
that runs again deals alike), the number of groups follows the number of documents, and each group
is packed on its own. Within a group pieces are placed longest first into the leftmost bin with room,
found in a tree whose nodes hold the larger room of their children.

Tokens: words between spaces and line breaks are tokenized once and cached per worker (bounded),
as the tokenizer never joins across them; a tail of ASCII punctuation after a letter is always a
token of its own and is cached apart.

Defined results: null and empty texts are the end token alone; repeated rows are packed once
each; a null id is carried; texts of any length are tokenized whole; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, text_slices

LENGTH = 4096
#: Documents of a group, on average.
GROUP_DOCS = 2048
#: Distinct words that a worker keeps.
CACHE_WORDS = 300_000
_PUNCT = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


# The steps before the model of the tokenizer that words of Latin letters, and runs of punctuation, may go past.
STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
_BYTES = {b: chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else None for b in range(256)}
for _b in (b for b in range(256) if _BYTES[b] is None):
    _BYTES[_b] = chr(256 + sum(1 for x in range(_b) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174)))


def _steps(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    out = []
    for part, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")):
        out += [x["type"] for x in (spec.get(part) or {}).get(inner, [])]
    return out


def _plain(word: str) -> str | None:
    """A word as the model gets it, if it surely is one piece: Latin letters only, or ASCII punctuation only."""
    if word.isascii():
        return word.lower() if word.isalpha() or word and not word.strip(_PUNCT) else None
    if not word.isalpha() or max(word) >= "\u0250":
        return None
    low = "".join(c.lower() for c in word)
    return "".join(_BYTES[b] for b in low.encode()) if low.isalpha() and max(low) < "\u0250" else None


class WordTokenizer:
    """ids of texts by the tokenizer in a file, word by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.direct = _steps(path) == STEPS
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.size = np.zeros(1 << 16, dtype=np.uint32), 0
        self.begin, self.length = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.add([""], [[]])

    def add(self, words: list[str], ids: list[list[int]]) -> None:
        have, n = len(self.known), sum(map(len, ids))
        while self.size + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while have + len(words) > len(self.begin):
            self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
        lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.flat[self.size : self.size + n] = np.fromiter((i for x in ids for i in x), dtype=np.uint32, count=n)
        self.length[have : have + len(words)] = lens
        self.begin[have : have + len(words)] = self.size + np.cumsum(lens) - lens
        self.size += n
        self.known.update(zip(words, range(have, have + len(words)), strict=True))

    def learn(self, words: list[str]) -> None:
        """Words that lack get their ids: those of what stands before a tail of punctuation, and of the tail."""
        split = []
        for w in words:
            b = w.rstrip(_PUNCT)
            split.append((b, w[len(b) :]) if b and b != w and b.lower()[-1].isalpha() and "<|" not in w else (w, ""))
        new = [x for x in dict.fromkeys(x for pair in split for x in pair) if x not in self.known]
        plain = {x: p for x in new if (p := _plain(x)) is not None} if self.direct else {}
        rest = [x for x in new if x not in plain]
        ids = {x: [t.id for t in self.model.tokenize(p)] for x, p in plain.items()}
        ids |= {x: e.ids for x, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True)}
        self.add(list(ids), list(ids.values()))
        whole = [(w, b, t) for w, (b, t) in zip(words, split, strict=True) if t]
        self.add([w for w, _, _ in whole], [[*self.ids(b), *self.ids(t)] for _, b, t in whole])

    def ids(self, word: str) -> list[int]:
        k = self.known[word]
        return self.flat[self.begin[k] : self.begin[k] + self.length[k]].tolist()

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts, and offsets of texts in them."""
        if len(self.known) > CACHE_WORDS:
            self.clear()
        texts = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off), pa.py_buffer(data))
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens are matched before lower-casing
            texts = pc.ascii_lower(texts)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pc.list_flatten(lists).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        get = self.known.get
        places = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        lack = np.flatnonzero(places < 0).tolist()
        if lack:
            self.learn([words[i] for i in lack])
            places[lack] = [self.known[words[i]] for i in lack]
        places = places[coded.indices.to_numpy()]
        lens = self.length[places]
        ends = np.cumsum(lens)
        ids = self.flat[np.repeat(self.begin[places] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[lists.offsets.to_numpy()]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _pieces(path: str, end_id: int, length: int, groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = tokenizer(path), np.uint32(end_id)
        had: dict[int, int] = {}
        place = TaskContext.get().partitionId()
        words.clear()  # what a former task has left, so that a worker's memory doesn't follow the tasks it has run
        for batch in batches:
            for lo, hi, data, ends in text_slices(batch.column(1), 2 * SLICE_BYTES):
                ids, off = words.encode(data, ends)
                row, start, size, crc, total, dealt = [], [], [], [], [], []
                ends = off.tolist()
                for i in range(hi - lo):
                    doc = np.append(ids[ends[i] : ends[i + 1]], last)
                    key = zlib.crc32(doc.tobytes()) << 32 | len(doc)
                    had[key] = had.get(key, 0) + 1
                    group = zlib.crc32(f"{key} {place} {had[key]}".encode()) % groups
                    for a in range(0, len(doc), length):
                        piece = doc[a : a + length]
                        row.append(lo + i)
                        start.append(a)
                        size.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(doc))
                        dealt.append(group)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int32())), *(pa.array(x, pa.int64()) for x in (start, size, crc, total, dealt))], names=["__id", "start", "length", "ids_crc32", "doc_tokens", "__g"])

    return run


class Rooms:
    """A tournament tree of the room left in each bin."""

    def __init__(self, bins: int, room: int):
        self.n = 1
        while self.n < bins:
            self.n *= 2
        self.top = [room] * (2 * self.n)
        self.room = room

    def place(self, size: int) -> tuple[int, int]:
        """The leftmost bin with room for size, and the offset there."""
        top, k = self.top, 1
        while k < self.n:
            k *= 2
            if top[k] < size:
                k += 1
        offset = self.room - top[k]
        top[k] -= size
        found = k - self.n
        k //= 2
        while k:
            best = max(top[2 * k], top[2 * k + 1])
            if top[k] == best:
                break
            top[k] = best
            k //= 2
        return found, offset


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each piece; ties are placed in the order given."""
    rooms = Rooms(len(sizes) or 1, room)
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        bins[i], offsets[i] = rooms.place(int(sizes[i]))
    return bins, offsets


def _pack(length: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("__id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), length)
        base = group.column("__g")[0].as_py() << 32
        return group.drop_columns(["__g"]).append_column("sequence_id", pa.array(bins + base, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, length: int = LENGTH, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = docs.schema[id_col].dataType.simpleString()
    groups = max(1, docs.count() // group_docs)
    cols = f"__id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(_pieces(tokenizer_path, end_id, length, groups), f"{cols}, __g long")
    return pieces.groupBy("__g").applyInArrow(_pack(length), f"{cols}, sequence_id long, offset long").withColumnRenamed("__id", id_col)
