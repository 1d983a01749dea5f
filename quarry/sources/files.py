"""Readers and writers of files: delimited text, archives, JSON, documents, vector and lexical tables."""

from __future__ import annotations

import atexit
import csv
import io
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; for a local session that names none, one of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="quarry-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/quarry/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def swap_in(df: DataFrame, path: str) -> None:
    """Writes a table beside the one at path, then puts it in its place; a failure leaves the old or the new one (see stored)."""
    spark, base = df.sparkSession, path.rstrip("/")
    stored(spark, base)  # mends what an earlier failure left
    df.write.mode("overwrite").parquet(f"{base}.new")
    now, fs = _file_system(spark, base)
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(f"{base}.{x}") for x in ("old", "new"))
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(new, now)
    fs.delete(old, True)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that swap_in or append_rows keeps at path, or None; after a failure between two renames the old one comes back."""
    base = path.rstrip("/")
    now, fs = _file_system(spark, base)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{base}.old")
    if fs.exists(old):
        if fs.exists(now):
            fs.delete(old, True)
        else:
            fs.rename(old, now)
    return spark.read.parquet(base) if fs.exists(now) else None


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows to a table; a job that fails adds none."""
    df.write.mode("append").parquet(path)


def truncate_and_load(df: DataFrame, path: str, reset: tuple[str, ...] = ("sentiment_label", "sentiment_score")) -> None:
    """Replaces a table; the columns in reset become null."""
    kinds = dict(df.dtypes)
    swap_in(df.select(*[F.lit(None).cast(kinds[c]).alias(c) if c in reset else F.col(c) for c in df.columns]), path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) of any file system that Spark knows has files."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_delimited(spark: SparkSession, paths: list[str] | str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame | None:
    """All columns as strings, header names without blanks; paths that lack are left out, and None if all do."""
    found = [p for p in ([paths] if isinstance(paths, str) else paths) if exists(spark, p)]
    if not found:
        return None
    out = None
    for p in found:
        df = spark.read.option("ignoreMissingFiles", True).csv(p, sep=sep, header=True, inferSchema=False, encoding=encoding)
        df = df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=True)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON arrays or objects, one document a file; broken files are dropped."""
    r = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED")
    return (r.schema(schema) if schema else r).json(path)


def _members(wanted: list[str] | None, suffix: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    want = {w.lower() for w in wanted} if wanted is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                    names = [n for n in z.namelist() if (want is None or n.rpartition("/")[2].lower() in want) and (suffix is None or n.lower().endswith(suffix))]
                    for i, n in enumerate(names):
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([i], pa.int32()), pa.array([z.read(n)], pa.binary())], names=["path", "member", "turn", "content"])
                except (zipfile.BadZipFile, TypeError):
                    continue

    return run


def zip_members(archives: DataFrame, wanted: list[str] | None = None, suffix: str | None = None) -> DataFrame:
    """(path, member, turn, content) of archives (path, content) as the binaryFile source gives them; names match in any case, broken archives give none."""
    return archives.select("path", "content").mapInArrow(_members(wanted, suffix), "path string, member string, turn int, content binary")


def first_document(archives: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """(path, content): the first member with the suffix; null for archives without one."""
    first = zip_members(archives, suffix=suffix).groupBy("path").agg(F.min_by("content", "turn").alias("content"))
    return archives.select("path").join(first, "path", "left")


def delimited_members(members: DataFrame, columns: list[str], sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Rows of delimited members with the columns named, all strings; the header says where they stand. Quoted cells may hold separators and line breaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = csv.reader(io.StringIO((content or b"").decode(encoding, "replace").removeprefix("\ufeff"), newline=""), delimiter=sep)
                header = [x.strip() for x in next(lines, [])]
                at = [header.index(c) if c in header else -1 for c in columns]
                rows = [[r[i] if 0 <= i < len(r) else None for i in at] for r in lines if r]
                cells = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array([member] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in cells)], names=["path", "member", *columns])

    return members.select("path", "member", "content").mapInArrow(run, ", ".join(f"`{c}` string" for c in ("path", "member", *columns)))


def resave_filtered(rows: DataFrame, keep: F.Column, path: str, sep: str = ";") -> None:
    """Rows of archives that are kept, as delimited text."""
    write_delimited(rows.where(keep), path, sep)


def document_tables(files: DataFrame, decoder: Callable[[bytes], list[list[list[str]]]] | None = None, least_rows: int = 2) -> DataFrame:
    """(doc_id, turn, rows) of the tables of document files (path, content) with least_rows rows or more.

    decoder: bytes → tables of rows of cells. Without one, a table is a run of lines with tabs in them.
    """

    def plain(content: bytes) -> list[list[list[str]]]:
        tables: list[list[list[str]]] = [[]]
        for line in content.decode("utf-8", "replace").split("\n"):
            if "\t" in line:
                tables[-1].append(line.split("\t"))
            elif tables[-1]:
                tables.append([])
        return [t for t in tables if t]

    read = decoder or plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.string()))
        for batch in batches:
            found = [(path, i, t) for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if content is not None for i, t in enumerate(read(content)) if len(t) >= least_rows]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], kind)], names=["doc_id", "turn", "rows"])

    return files.select("path", "content").mapInArrow(run, "doc_id string, turn int, rows array<array<string>>")


def document_blocks(files: DataFrame, decoder: Callable[[bytes], list[tuple]] | None = None) -> DataFrame:
    """(doc_id, page, block, text, x0, y0, x1, y1) of document files (path, content) by a decoder.

    decoder: bytes → rows (page, block, text, x0, y0, x1, y1). Without one, documents are read as text pages
    parted by form feeds with a block a line, which keeps the pipeline testable where no document library is.
    """

    def plain(content: bytes) -> list[tuple]:
        pages = content.decode("utf-8", "replace").split("\f")
        return [(p, b, t, 0.0, 130.0 + 12 * b, 500.0, 140.0 + 12 * b) for p, page in enumerate(pages, 1) for b, t in enumerate(page.split("\n"))]

    read = decoder or plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), *(pa.float64(),) * 4)
        for batch in batches:
            rows = [(path, *r) for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if content is not None for r in read(content)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "page", "block", "text", "x0", "y0", "x1", "y1"])

    return files.select("path", "content").mapInArrow(run, "doc_id string, page int, block int, text string, x0 double, y0 double, x1 double, y1 double")


def save_vectors(df: DataFrame, path: str, key: str = "chunk_id", reindex: bool = False) -> None:
    """A vector table; without reindex rows of new keys are added and those of old keys replaced."""
    from quarry.operators.upsert import upsert

    old = None if reindex else stored(df.sparkSession, path)
    swap_in(df if old is None else upsert(old, df, [key]), path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if there is none yet."""
    return stored(spark, path)


def load_lexical(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, lengths, terms) as save_lexical wrote them."""
    return tuple(spark.read.parquet(f"{path}/{x}") for x in ("postings", "lengths", "terms"))


def save_lexical(docs: DataFrame, path: str, doc_id: str, text: str) -> None:
    """Postings, document lengths and term statistics as three tables."""
    from quarry.functions import text as T
    from quarry.operators import retrieval as R

    post = R.postings(docs, doc_id, text)
    post.write.mode("overwrite").parquet(f"{path}/postings")
    docs.select(F.col(doc_id).alias("doc_id"), F.size(T.tokens(F.col(text))).alias("len")).write.mode("overwrite").parquet(f"{path}/lengths")
    R.term_statistics(docs.sparkSession.read.parquet(f"{path}/postings")).write.mode("overwrite").parquet(f"{path}/terms")


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def pending(keys: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys that aren't done: what an idempotent download or run has left."""
    return keys.join(done.select(key), key, "left_anti")
